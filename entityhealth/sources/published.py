"""Tables of day folders that change in one step.

A plain landed table is replaced folder by folder, so a crash leaves old and new
days side by side and readers meet half of a change. Here the rows of a change
are written aside first; then one small file, the next snapshot, names the
folder of every day. Readers follow the last whole snapshot. A writer that
fails leaves files that no snapshot names, and nothing else.

Next to its days a snapshot keeps marks: what its writer has to remember about
this very state, such as the last micro-batch it holds or the inputs each day
was made from. Marks and rows become visible together, so a repeated writer can
tell what is done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityhealth.sources.tables import read_or_empty

_ENTRIES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("kind", "key", "value")] + [T.StructField("version", T.LongType())]
)
#: The folder name of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: the folder of every day (`None`: rows without one) below the table's, the schema and the marks."""

    version: int = 0
    folders: Mapping[str | None, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    marks: Mapping[str, str] = field(default_factory=dict)

    def days_unlike(self, made_from: Mapping[str | None, str]) -> list[str | None]:
        """Days whose folder is another than the given one, on either side."""
        return [d for d in {**self.folders, **made_from} if self.folders.get(d) != made_from.get(d)]


def snapshot(spark: SparkSession, path: str, by: str = "date") -> Snapshot:
    """The last whole state of the table; of a plain landed table its days as they are, of nothing an empty one.

    A row per day and mark reaches the driver.
    """
    log, last = _log(spark, path)
    if not last:
        return _landed(spark, path, by)
    rows = log.where(F.col("version") == last).collect()
    held = {kind: {r["key"]: r["value"] for r in rows if r["kind"] == kind} for kind in ("day", "mark", "schema")}
    return Snapshot(last, held["day"], T.StructType.fromJson(json.loads(held["schema"][""])), held["mark"])


def _log(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """What has been published, and the number of the last state."""
    log = read_or_empty(spark, lambda: spark.read.schema(_ENTRIES).parquet(f"{path}/_published"), _ENTRIES)
    return log, log.agg(F.max("version")).first()[0] or 0


def _landed(spark: SparkSession, path: str, by: str) -> Snapshot:
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        # No folder, or one without a day, such as after a first change that failed.
        if not any(c in (e.getCondition() or "") for c in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return Snapshot()
    if by not in table.columns:
        raise ValueError(f"{path} is not landed by {by}")
    days = [r[0] for r in table.select(F.col(by).cast("date").cast("string")).distinct().collect()]
    schema = T.StructType([T.StructField(f.name, T.DateType()) if f.name == by else f for f in table.schema.fields])
    return Snapshot(0, {d: _folder(by, d) for d in days}, schema)


def _folder(by: str, day: str | None) -> str:
    return f"{by}={_NO_DAY if day is None else day}"


def read(
    spark: SparkSession, path: str, by: str = "date", days: Collection[str | None] | None = None, at: Snapshot | None = None
) -> DataFrame:
    """The rows of the table, or of some of its days; only their folders are listed and read."""
    at = at or snapshot(spark, path, by)
    if at.schema is None:
        raise ValueError(f"{path} holds no table")
    folders = [f for d, f in at.folders.items() if days is None or d in days]
    if not folders:
        return spark.createDataFrame([], at.schema)
    parts = []
    for root in (f"{path}/_days", path):
        own = [f"{path}/{f}" for f in folders if f.startswith("_days/") == (root != path)]
        if own:
            # The common root of the folders says which of their levels are columns.
            parts.append(spark.read.schema(at.schema).option("basePath", root).parquet(*own).select(*at.schema.fieldNames()))
    return reduce(DataFrame.unionByName, parts)


def publish(
    rows: DataFrame,
    path: str,
    by: str = "date",
    replaced: Collection[str | None] = (),
    marks: Mapping[str, str] | None = None,
    base: Snapshot | None = None,
) -> Snapshot:
    """Make `rows` the content of their days, in one step, and return the new state.

    Other days stay. Days in `replaced` without new rows go. A table has one writer at a time. `marks` are added to
    those the table has; a mark of `None` goes. `base` is the state that the rows
    were made from; if another writer has published since, nothing changes and an
    error says so. The rows may come from the table itself.
    """
    spark = rows.sparkSession
    base = base or snapshot(spark, path, by)
    if base.schema is not None and set(rows.columns) != set(base.schema.fieldNames()):
        raise ValueError(f"the table has the columns {base.schema.fieldNames()}, the rows {rows.columns}")
    rows = rows.select(*(base.schema.fieldNames() if base.schema is not None else rows.columns))
    aside = f"_days/change={uuid.uuid4().hex}"
    rows.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(f"{path}/{aside}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{aside}")
    days = [r[0] for r in written.select(F.col(by).cast("string")).distinct().collect()]
    folders = {d: f for d, f in base.folders.items() if d not in set(replaced)} | {d: f"{aside}/{_folder(by, d)}" for d in days}
    kept = {k: v for k, v in {**base.marks, **(marks or {})}.items() if v is not None}
    entries = [("day", d, f) for d, f in folders.items()] + [("mark", k, v) for k, v in kept.items()]
    entries.append(("schema", "", (base.schema or rows.schema).json()))
    if _log(spark, path)[1] != base.version:
        raise RuntimeError(f"{path} was published by another writer meanwhile")
    version = base.version + 1
    log = spark.createDataFrame(entries, "kind string, key string, value string").coalesce(1)
    # One file, moved into place when it is complete: it is there whole or not at all.
    log.write.mode("append").parquet(f"{path}/_published/version={version}")
    return Snapshot(version, folders, base.schema or rows.schema, kept)
