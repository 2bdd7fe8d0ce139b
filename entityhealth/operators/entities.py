"""Per-entity statistics, anomalies against the own history, latest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.functions import dates, levels, numbers
from entityhealth.operators.cleanse import any_of, display_defaults


def entity_stats(df: DataFrame, metrics: Sequence[str], entity: str = "pet_id") -> DataFrame:
    """Mean and sample deviation of each metric, a row per entity."""
    aggs = []
    for c in metrics:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"stddev_{c}")]
    return df.groupBy(entity).agg(*aggs)


def with_entity_stats(df: DataFrame, metrics: Sequence[str], entity: str = "pet_id") -> DataFrame:
    """Every row with its entity's statistics.

    Grouped and joined back rather than a window over the whole entity: the
    group-by sums before its shuffle and the join splits, so an entity with a
    third of the rows never meets in one task.
    """
    stats = entity_stats(df, metrics, entity).withColumnRenamed(entity, "_entity")
    return df.join(stats, F.col(entity).eqNullSafe(F.col("_entity")), "left").drop("_entity")


def self_baseline_anomalies(
    df: DataFrame, metrics: Sequence[str], entity: str = "pet_id", day: str = "date", limit: float = 2.0
) -> DataFrame:
    """Rows where a metric is far from the entity's own mean, by entity and day.

    A constant series or a single row has no score and no anomaly.
    """
    scored = with_entity_stats(df, metrics, entity)
    scored = scored.withColumns(
        {
            f"{c}_anomaly_score": numbers.zscore(F.col(c), F.col(f"avg_{c}"), F.col(f"stddev_{c}"))
            for c in metrics
        }
    )
    flags = {f"is_{c}_anomaly": numbers.is_outlier(F.col(f"{c}_anomaly_score"), limit) for c in metrics}
    found = any_of(scored.withColumns(flags), flags)
    cols = [entity, day]
    for c in metrics:
        cols += [c, f"avg_{c}", f"stddev_{c}", f"{c}_anomaly_score", f"is_{c}_anomaly"]
    return found.select(*cols).orderBy(entity, day, *metrics)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    `row_number() = 1` becomes a per-task limit before the shuffle, so a key
    with many copies sends one row per task. `order` must be total, or equal
    rows must be interchangeable.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_per_entity(
    df: DataFrame, entity: str = "pet_id", day: str = "date", tie: Sequence[Column] | None = None
) -> DataFrame:
    """Each entity's last row; ties go to the largest remaining columns."""
    rest = tie if tie is not None else [F.col(c).desc() for c in df.columns if c not in (entity, day)]
    return keep_last(df, [entity], [F.col(day).desc(), *rest])


def available_ids(*tables: DataFrame, entity: str = "pet_id") -> DataFrame:
    """Sorted ids of the first table that has any.

    Tables are asked in turn for a single id, which stops at the first one found;
    only the table that has one is read for the distinct ids.
    """
    found = [t.select(entity).where(F.col(entity).isNotNull()) for t in tables]
    first = next((t for t in found[:-1] if not t.isEmpty()), found[-1])
    return first.distinct().orderBy(entity)


def latest_alert_card(
    predictions: DataFrame,
    alerts: DataFrame,
    entity: str = "pet_id",
    day: str = "date",
    no_note: str = "Không có ghi chú bất thường",
    empty_note: str = "Không có ghi chú đặc biệt.",
) -> DataFrame:
    """Per entity: latest prediction and the note of the latest alert, defaults where absent.

    `no_note` is shown for an entity without alerts, `empty_note` for an alert
    without a note.
    """
    p = latest_per_entity(predictions.select(entity, day, "health_alert_level", "prediction"), entity, day)
    p = p.select(
        entity,
        dates.day_text(F.col(day)).alias("latest_date"),
        "health_alert_level",
        F.format_string("%.2f", F.col("prediction")).alias("_pred"),
        F.col("prediction").isNotNull().alias("_has_pred"),
    )
    a = latest_per_entity(
        alerts.select(entity, day, "risk_score", "note_text"),
        entity,
        day,
        [F.col("risk_score").desc(), F.col("note_text").desc_nulls_last()],
    ).select(entity, F.coalesce("note_text", F.lit(empty_note)).alias("note_summary"))
    return p.join(a, entity, "full").select(
        entity,
        levels.or_na(F.col("latest_date")).alias("latest_date"),
        levels.or_na(F.col("health_alert_level")).alias("health_alert_level"),
        F.when(F.col("_has_pred"), F.col("_pred")).otherwise("N/A").alias("ml_prediction"),
        F.coalesce("note_summary", F.lit(no_note)).alias("note_summary"),
    )


def latest_activity_card(
    df: DataFrame,
    metrics: Sequence[str],
    entity: str = "pet_id",
    day: str = "date",
    places: Mapping[str, int] | None = None,
) -> DataFrame:
    """Per entity: the latest readings as text, `N/A` where missing.

    `places` rounds the given columns for display.
    """
    last = latest_per_entity(df.select(entity, day, *metrics), entity, day)
    rounded = last.withColumns({c: F.round(c, n) for c, n in (places or {}).items() if c in metrics})
    return display_defaults(rounded.withColumn(day, dates.day_text(F.col(day))), [day, *metrics])
