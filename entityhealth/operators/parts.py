"""Aggregates of single days that add up to those of all days.

A day's parts are small and are made from its rows alone, so that a change of
some days costs those days. Sums are exact, and means with their squared
deviations merge by the parallel formula, which needs no difference of large
numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.functions import dates, numbers

_SUMS = ("exact", "rough", "n", "held")


def trend_parts(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], day: str = "date") -> DataFrame:
    """Sums of each metric and the number of rows, per day and group."""
    sums = [s.alias(f"{c}_{part}") for c in metrics for part, s in numbers.sums(F.col(c)).items()]
    return df.groupBy(day, *keys).agg(*sums, F.count("*").alias("rows"))


def trend_of_parts(parts: DataFrame, keys: Sequence[str | Column], metrics: Mapping[str, str], count: str | None = None) -> DataFrame:
    """Means rounded half-up to 2 places, as of the rows that the parts were made from."""
    totals = [F.sum(f"{c}_{part}").alias(f"{c}_{part}") for c in metrics for part in _SUMS]
    grouped = parts.groupBy(*keys).agg(*totals, F.sum("rows").alias("rows"))
    means = [numbers.half_up_mean(*[F.col(f"{c}_{part}") for part in _SUMS]).alias(out) for c, out in metrics.items()]
    names = grouped.columns[: len(keys)]
    return grouped.select(*names, *means, *([F.col("rows").alias(count)] if count else []))


def monthly_trend_of_parts(
    parts: DataFrame, category: str, metrics: Mapping[str, str], day: str = "date", count: str = "total_records"
) -> DataFrame:
    """The same per category and month, ordered."""
    months = trend_of_parts(parts, [category, F.trunc(day, "month").alias("_month")], metrics, count)
    out = months.withColumn("year_month", dates.year_month(F.col("_month")))
    return out.select(category, "year_month", *metrics.values(), count).orderBy(category, "year_month")


def moment_parts(df: DataFrame, metrics: Sequence[str], entity: str = "pet_id", day: str = "date") -> DataFrame:
    """Count, mean and summed squared deviation of each metric, per day and entity."""
    aggs = []
    for c in metrics:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}_n"), F.avg(v).alias(f"{c}_mean"), (F.var_pop(v) * F.count(v)).alias(f"{c}_m2")]
    return df.groupBy(day, entity).agg(*aggs)


def _merged(parts: Column) -> Column:
    """One (n, mean, m2) of many, in the order given."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        share = b["n"].cast("double") / n.cast("double")
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"].cast("double") * share).alias("m2"),
        )

    return F.aggregate(parts, none, merge)


def entity_stats_of_parts(parts: DataFrame, metrics: Sequence[str], entity: str = "pet_id", day: str = "date") -> DataFrame:
    """Mean and sample deviation of each metric, a row per entity, as `entity_stats` of all rows.

    An entity brings one part a day, which are merged in order of their days, so
    reruns agree to the last digit.
    """
    lists = [
        F.array_sort(
            F.collect_list(F.when(F.col(f"{c}_n") > 0, F.struct(day, *[F.col(f"{c}_{x}").alias(x) for x in ("n", "mean", "m2")])))
        ).alias(c)
        for c in metrics
    ]
    merged = parts.groupBy(entity).agg(*lists).select(entity, *[_merged(F.col(c)).alias(c) for c in metrics])
    stats = []
    for c in metrics:
        n, mean, m2 = (F.col(c)[x] for x in ("n", "mean", "m2"))
        stats += [F.when(n > 0, mean).alias(f"avg_{c}"), F.when(n > 1, F.sqrt(m2 / (n - 1))).alias(f"stddev_{c}")]
    return merged.select(entity, *stats)
