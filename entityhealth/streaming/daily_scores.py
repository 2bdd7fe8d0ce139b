"""Incremental scoring with Structured Streaming.

Scoring needs nothing but the row, so the stream keeps no state. Each file is
scored once and appended by day; the file sink's log makes this exactly-once.
`current` gives one row per entity and day, the last to arrive, as the batch
upsert does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from entityhealth.operators import scoring
from entityhealth.operators.upkeep import dedupe_keep_last
from entityhealth.rules import DEFAULT_RULES, RuleSet


def read_landed(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    """A stream of the Parquet files that land under the path."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def score_stream(readings: DataFrame, rules: RuleSet = DEFAULT_RULES, category: str = "species") -> DataFrame:
    return scoring.score(readings, rules, category)


def append_scores(scored: DataFrame, out: str, checkpoint: str, by: str = "date") -> StreamingQuery:
    """Append by day everything that is available now, then stop."""
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy(by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def current(spark: SparkSession, out: str, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One scored row per key, the last to arrive."""
    return dedupe_keep_last(spark.read.parquet(out), keys, arrival)
