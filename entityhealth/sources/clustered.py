"""Tables laid out for look-ups of one entity, and answers from file footers.

Readings as they land hold every entity in every file, so one entity's series
reads them all. Range-clustered, an entity lies in few row groups: the
statistics of the others rule it out, and a Bloom filter does so where a row
group spans its value without holding it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group. Smaller ones skip more and cost more footers.
ROW_GROUP_BYTES = 32 << 20


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    lookups: Sequence[str] | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    files: int | None = None,
) -> DataFrame:
    """The rows as Parquet in ranges of `keys`, sorted by them, with Bloom filters on `lookups` (the first key by default).

    An entity followed by its day is a good choice of keys: an entity that holds much
    of the rows is then split over several files by its days. `files` is the
    number of ranges, by default as many as the session's shuffles have. Rows
    with NULL keys come first; repeated rows stay; an empty table is written with its schema.
    """
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.option("parquet.block.size", row_group_bytes)
    for c in lookups if lookups is not None else keys[:1]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def footer_answers(spark: SparkSession) -> Iterator[None]:
    """Inside, smallest and largest values and counts of whole Parquet files are answered by their footers.

    Holds for numbers and dates; for other columns the column is read. Plans
    must be made and run inside.
    """
    listed = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    with _settings(
        spark, {"spark.sql.sources.useV1SourceList": ",".join(listed), "spark.sql.parquet.aggregatePushdown": "true"}
    ):
        yield


def last_day_rows(spark: SparkSession, path: str, day: str = "date") -> DataFrame:
    """The rows of the last day of a table of files, whose `day` is a date column; none for an empty table.

    The last day comes from the footers, so nothing is read to find it; as a
    literal it then prunes row groups. Rows without a day are never of the last one.
    """
    with footer_answers(spark):
        last = spark.read.parquet(path).agg(F.max(day)).first()[0]
    table = spark.read.parquet(path)
    return table.where(F.col(day) == F.lit(last)) if last is not None else table.where(F.lit(False))
