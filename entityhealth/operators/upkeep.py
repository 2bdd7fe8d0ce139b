"""Daily upkeep: de-duplicate, carry forward, allocate ids, upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.operators.entities import keep_last
from entityhealth.operators.ranks import ordered_index
from entityhealth.operators.scoring import union_by_name


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key, the last to arrive.

    Rows that arrived together are told apart by their other columns, so reruns
    agree.
    """
    rest = [c for c in df.columns if c not in keys and c not in arrival]
    return keep_last(df, keys, [F.col(c).desc() for c in [*arrival, *rest]])


def carry_forward(
    df: DataFrame,
    day: dt.date | Column,
    attributes: Sequence[str],
    entity: str = "pet_id",
    date: str = "date",
) -> DataFrame:
    """A new row on `day` for every entity without one.

    Attributes come from the entity's latest row, everything else is NULL. One
    aggregation answers both which entities lack the day and what they carry.
    """
    day_col = F.lit(day) if isinstance(day, dt.date) else day
    marked = df.select(entity, date, *attributes).withColumn(
        "_today", F.coalesce(F.col(date) == day_col, F.lit(False))
    )
    # A row of the day itself goes first; what is left over has none.
    tie = [F.col(c).desc() for c in attributes]
    last = keep_last(marked, [entity], [F.col("_today").desc(), F.col(date).desc(), *tie])
    return last.where(~F.col("_today")).select(
        *[
            day_col.cast(f.dataType).alias(f.name)
            if f.name == date
            else (F.col(f.name) if f.name in (entity, *attributes) else F.lit(None).cast(f.dataType).alias(f.name))
            for f in df.schema.fields
        ]
    )


def allocate_ids(
    existing: DataFrame, quota: int, target: int, entity: str = "pet_id", prefix: str = "pet", width: int = 3
) -> DataFrame:
    """The lowest unused ids, up to `quota` and never beyond `target` entities.

    Unused numbers are placed by range partitions, so no quota meets in one task.
    """
    spark = existing.sparkSession
    used = existing.select(entity).where(F.col(entity).isNotNull()).distinct()
    wanted = max(0, min(quota, target - used.count()))
    # As many numbers as entities may exist always hold enough unused ones.
    numbers = spark.range(target).select(
        F.col("id").alias("number"), F.concat(F.lit(prefix), _pad(F.col("id"), width)).alias(entity)
    )
    free = ordered_index(numbers.join(used, entity, "left_anti"), [F.col("number")], "_place")
    return free.where(F.col("_place") < wanted).select("number", entity)


def _pad(number: Column, width: int) -> Column:
    """Zero-padded to `width`; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    return union_by_name(existing, new)


def daily_upsert(
    existing: DataFrame,
    incoming: DataFrame,
    day: dt.date | Column,
    attributes: Sequence[str],
    arrival: Sequence[str] = (),
    entity: str = "pet_id",
    date: str = "date",
) -> DataFrame:
    """The table after a daily refresh.

    Every known entity gets a row for `day`, incoming readings win over carried
    rows and over what was there, and one row per entity and day remains.
    Running it again with the same input changes nothing.
    """
    carried = carry_forward(existing, day, attributes, entity, date)
    parts = [t.withColumn("_source", F.lit(i)) for i, t in enumerate((existing, carried, incoming))]
    merged = dedupe_keep_last(union_by_name(*parts), [entity, date], ["_source", *arrival])
    return merged.drop("_source").orderBy(entity, date)
