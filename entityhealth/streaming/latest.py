"""A stream that keeps the last row per entity and day.

Landed files become micro-batches. State with a watermark drops what has been
delivered before; each micro-batch is then merged into a published table: the
days it touches are read, the last row per key is kept, and all of them are
replaced in one step together with the number of the batch. A batch that is
run again after a failure finds its number there and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from entityhealth.operators.scoring import union_by_name
from entityhealth.operators.upkeep import dedupe_keep_last
from entityhealth.session import written
from entityhealth.sources import published


def once(readings: DataFrame, event_time: str, delay: str, identity: Sequence[str]) -> DataFrame:
    """The stream without repeated deliveries.

    `identity` names a delivery, such as entity, day and arrival: by entity and
    day alone a correction on the same day would be dropped. An identity is held
    until the watermark has passed its time by `delay`; a row that comes later
    than that is dropped.
    """
    return readings.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def merge_batch(batch: DataFrame, path: str, keys: Sequence[str], arrival: Sequence[str], by: str, mark: str, number: int) -> None:
    """Merge the rows of one micro-batch into the published table, once.

    Only the touched days are read. Rows that arrived later win, whichever batch
    brought them; a batch with a number that the table already holds is skipped.
    """
    spark = batch.sparkSession
    now = published.snapshot(spark, path, by)
    if number <= int(now.marks.get(mark, -1)):
        return
    new = written(batch, "micro-batch")
    days = [r[0] for r in new.select(F.col(by).cast("string")).distinct().collect()]
    if not days:
        return
    rows = new if now.schema is None else union_by_name(published.read(spark, path, by, days, now), new)
    published.publish(dedupe_keep_last(rows, keys, arrival), path, by, marks={mark: str(number)}, base=now)


def keep_latest(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    arrival: Sequence[str],
    by: str = "date",
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Merge everything that is available now, a micro-batch at a time, then stop.

    `prepare` turns a micro-batch into rows of the table, such as by scoring it.
    The checkpoint is the log of consumed files: the next call reads only those
    that landed since. Batches are numbered per checkpoint.
    """
    mark = f"batch of {checkpoint}"

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(prepare(batch), path, keys, arrival, by, mark, number)

    return readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rows_read(query: StreamingQuery) -> int:
    """Input rows of all micro-batches of a finished query."""
    return sum(p.numInputRows for p in query.recentProgress)
