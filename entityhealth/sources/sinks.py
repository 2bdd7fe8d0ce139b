"""Writers: report directories, JSON lines, day partitions, single-file export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityhealth.sources.tables import read_report

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_report(df: DataFrame, path: str) -> None:
    """CSV part files with header; a rerun replaces the directory."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_single_file(
    spark: SparkSession, report: str, path: str, schema: T.StructType, multi_line: bool = False
) -> None:
    """One CSV file from a written report directory, its rows in the report's order.

    The report is already computed and only read back. Part files are packed
    into read tasks by size, so the one writing task sorts by part file, place
    in it and row; that sort spills to disk. One file is the caller's choice: it
    is written by one task, however many rows it has.
    """
    table = read_report(spark, report, schema, multi_line)
    place = {"_file": F.col("_metadata.file_name"), "_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
    placed = table.withColumns(place).coalesce(1).sortWithinPartitions(*place)
    placed.drop(*place).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def land(df: DataFrame, path: str, by: str = "date") -> None:
    """Write raw rows by day; only the days that occur in `df` are replaced.

    The rebalance hint lets adaptive execution pack small days into few files
    and split a day that holds a large share of the rows over several tasks.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def append_days(df: DataFrame, path: str, by: str = "date") -> None:
    """Add rows to the landed days and leave what is there."""
    df.hint("rebalance", F.col(by)).write.mode("append").partitionBy(by).parquet(path)
