"""Tables stored in buckets of their join keys.

Readings, notes and device days are joined by entity and day again and again.
Dealt to buckets once, when they are written, two tables with the same number
of buckets are joined bucket by bucket: neither side is shuffled again. All rows
of a key lie in one bucket, so tables in which a few keys hold much of the rows
are better left as they are and joined by `joins.skew_join`, which splits them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from entityhealth.session import scratch_path

KEYS = ("pet_id", "date")


def write_bucketed(df: DataFrame, path: str, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The rows as Parquet under the path, dealt by a hash of the keys and sorted by them in each file.

    Rows are dealt before they are written, so every bucket is one file, which a
    task reads in key order. Tables to be joined need the same number of buckets;
    it should make buckets of the size that a task handles well.
    """
    dealt = df.repartition(buckets, *keys)
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """A table that another session has written with the same buckets and keys."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    place = re.sub(r"(['\\])", r"\\\1", path)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def bucketed_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"bucketed-{label}")
