"""Reports by group. Every aggregation is partial before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.functions import dates, numbers


def _struct_rows(df: DataFrame, rows: list[list[Column]]) -> DataFrame:
    """The given structs as rows of a one-row result."""
    return df.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


def _means(metrics: Mapping[str, str]) -> list[Column]:
    return [numbers.mean_half_up(F.col(c)).alias(out) for c, out in metrics.items()]


def trend_by(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """Means rounded half-up to 2 places per group, ordered by group.

    `metrics` maps columns to report names.
    """
    return df.groupBy(*keys).agg(*_means(metrics)).orderBy(*keys)


def trend_by_profile(
    df: DataFrame, profile: DataFrame, on: str, keys: Sequence[str], metrics: Mapping[str, str]
) -> DataFrame:
    """`trend_by` where some keys are the profile's: readings without a profile drop out.

    Readings are summed per own keys and `on` first, so the join shuffles sums
    instead of readings. Sums are exact, so the result is that of the plain join.
    """
    own = [k for k in keys if k in df.columns]
    named = {f"_{i}_{part}": s for i, c in enumerate(metrics) for part, s in numbers.sums(F.col(c)).items()}
    partial = df.groupBy(on, *own).agg(*[s.alias(name) for name, s in named.items()])
    joined = partial.join(profile, on).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in named])
    means = [
        numbers.half_up_mean(*[F.col(f"_{i}_{part}") for part in ("exact", "rough", "n", "held")]).alias(out)
        for i, out in enumerate(metrics.values())
    ]
    return joined.select(*keys, *means).orderBy(*keys)


def trend_by_month(
    df: DataFrame, category: str, day: str, metrics: Mapping[str, str], count: str = "total_records"
) -> DataFrame:
    """The same per category and month, with the number of rows.

    Rows are grouped by the first of the month; only the groups are formatted.
    """
    months = df.groupBy(category, F.trunc(day, "month").alias("_month")).agg(
        *_means(metrics), F.count("*").alias(count)
    )
    out = months.withColumn("year_month", dates.year_month(F.col("_month")))
    return out.select(category, "year_month", *metrics.values(), count).orderBy(category, "year_month")


def describe_metrics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum; typed, a row per metric."""
    aggs = []
    for i, c in enumerate(metrics):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    rows = [
        [
            F.lit(c).alias("metric"),
            F.col(f"n{i}").alias("n"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("stddev"),
            F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"),
        ]
        for i, c in enumerate(metrics)
    ]
    return _struct_rows(df.agg(*aggs), rows)


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of all pairs in one pass."""
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    rows = [
        [F.lit(a).alias("left_metric"), F.lit(b).alias("right_metric"), F.col(f"r{i}").alias("correlation")]
        for i, (a, b) in enumerate(pairs)
    ]
    return _struct_rows(df.agg(*aggs), rows)


def counts_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def top_counts(df: DataFrame, column: str, k: int, out: str = "n") -> DataFrame:
    """The k most frequent values; ties in value order."""
    return counts_by(df, column, out=out).orderBy(F.col(out).desc(), column).limit(k)


def profile_columns(df: DataFrame) -> DataFrame:
    """Type and non-NULL count of every column, in one pass."""
    counted = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        [F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"n{i}").alias("non_null")]
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return _struct_rows(counted, rows)


def weekly_summary(
    df: DataFrame, metrics: Mapping[str, str], entity: str = "pet_id", day: str = "date"
) -> DataFrame:
    """Means per entity and ISO week; the year is the one the week belongs to."""
    return df.groupBy(
        entity, dates.iso_year(F.col(day)).alias("iso_year"), F.weekofyear(day).alias("week_of_year")
    ).agg(*[F.avg(c).alias(out) for c, out in metrics.items()])


def daily_mean(df: DataFrame, metrics: Sequence[str], entity: str = "pet_id", day: str = "date") -> DataFrame:
    """Mean of an entity's readings per day, with a 95 % band.

    The band is mean ± 1.96·s/√n; NULL for a single reading.
    """
    aggs = []
    for c in metrics:
        aggs += [
            F.avg(c).alias(f"{c}_mean"),
            (F.stddev_samp(c) / F.sqrt(F.count(c)) * 1.96).alias(f"_{c}_half"),
        ]
    grouped = df.groupBy(entity, day).agg(F.count("*").alias("readings"), *aggs)
    cols: list[Column] = [F.col(entity), F.col(day), F.col("readings")]
    for c in metrics:
        mean, half = F.col(f"{c}_mean"), F.col(f"_{c}_half")
        cols += [mean, (mean - half).alias(f"{c}_low"), (mean + half).alias(f"{c}_high")]
    return grouped.select(*cols)


def _last_day(df: DataFrame, day: str, aggs: Sequence[Column]) -> DataFrame:
    """Counts of the last day.

    The day comes first, from a pass over the day column alone, so that the
    other columns are read for that day only: partitions of other days are
    pruned, and nothing else is computed for them.
    """
    last = latest_date(df, day).first()[0]
    return df.where(F.col(day).eqNullSafe(F.lit(last))).groupBy(day).agg(*aggs)


def latest_level_distribution(
    df: DataFrame, domain: Sequence[str], column: str = "health_alert_level", day: str = "date", out: str = "n"
) -> DataFrame:
    """Rows of the last day per level, in the order of `domain`, zeros kept."""
    counts = [F.count_if(F.col(column) == level).alias(f"n{i}") for i, level in enumerate(domain)]
    rows = [
        [F.lit(i).alias("position"), F.lit(level).alias(column), F.col(f"n{i}").alias(out)]
        for i, level in enumerate(domain)
    ]
    return _struct_rows(_last_day(df, day, counts), rows)


def latest_flag_counts(df: DataFrame, flags: Mapping[str, str], day: str = "date") -> DataFrame:
    """Rows of the last day with and without each flag.

    `flags` maps columns to labels; an absent column counts nothing.
    """
    aggs, rows = [], []
    for i, (c, label) in enumerate(flags.items()):
        present = F.col(c) if c in df.columns else F.lit(None).cast("boolean")
        aggs += [F.count_if(present).alias(f"yes{i}"), F.count_if(~present).alias(f"no{i}")]
        rows.append([F.lit(label).alias("signal"), F.col(f"yes{i}").alias("noted"), F.col(f"no{i}").alias("not_noted")])
    return _struct_rows(_last_day(df, day, aggs), rows)


def latest_date(df: DataFrame, day: str = "date") -> DataFrame:
    """One row: the last day of the table."""
    return df.agg(F.max(day).alias(day))


def latest_date_rows(df: DataFrame, day: str = "date") -> DataFrame:
    """Rows of the last day in `day`, a date or a time.

    The last value comes from a pass over that column. Of a time, the rows from
    the start of its day on are taken: a lower bound of the raw column, which
    reaches the scan, prunes row groups by their statistics and, where the
    table is landed by day, partitions.
    """
    last = df.agg(F.max(day).cast("string")).first()[0]
    if last is None:
        return df.where(F.lit(False))
    return df.where(F.col(day) >= F.lit(last[:10]).cast(df.schema[day].dataType))
