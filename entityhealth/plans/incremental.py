"""Reports that are brought up to date instead of made anew.

Landed files are consumed once, the scored table changes by days, and what is
made of it is kept per day: the alerts, and parts that add up to trends and
entity statistics. A run costs the files that landed since the last one and the
days they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityhealth.operators import parts, scoring
from entityhealth.sources import published
from entityhealth.streaming import latest

_MADE_FROM = "made from "


def refresh_by_day(
    spark: SparkSession, table: str, derived: str, build: Callable[[DataFrame], DataFrame], by: str = "date"
) -> list[str | None]:
    """Bring a table that `build` makes of single days up to date; returns the days that were read.

    The derived table marks the folder that each of its days was made from. Days
    whose folder is another by now are read and built again, all others are not
    touched, so a run that was cut off is made up for by the next one.
    """
    now, own = published.snapshot(spark, table, by), published.snapshot(spark, derived, by)
    made_from = {_day(k): f for k, f in own.marks.items() if k.startswith(_MADE_FROM)}
    changed = now.days_unlike(made_from)
    if changed:
        marks = {f"{_MADE_FROM}{d or ''}": now.folders.get(d) for d in changed}
        rows = published.read(spark, table, by, changed, now)
        published.publish(build(rows), derived, by, replaced=changed, marks=marks, base=own)
    return changed


def _day(mark: str) -> str | None:
    return mark.removeprefix(_MADE_FROM) or None


@dataclass(frozen=True)
class Layout:
    """What a reading is called and what the reports are made of."""

    entity: str = "pet_id"
    date: str = "date"
    category: str = "species"
    arrival: tuple[str, ...] = ()
    alert_columns: tuple[str, ...] = ()
    trend_keys: tuple[str, ...] = ("species", "breed")
    trend_means: Mapping[str, str] | None = None
    metrics: tuple[str, ...] = ()


def paths(out: str) -> dict[str, str]:
    return {name: f"{out}/{name}" for name in ("scored", "alerts", "trend_parts", "moment_parts", "progress")}


def refresh_reports(
    readings: DataFrame, out: str, score: Callable[[DataFrame], DataFrame], layout: Layout
) -> dict[str, int | list[str | None]]:
    """Consume the landed files that are new and bring all reports under `out` up to date.

    `readings` is a stream of landed files. One row per entity and day counts, the
    last to arrive. Returns the number of rows read and the days changed.
    """
    at, spark = paths(out), readings.sparkSession
    query = latest.keep_latest(
        readings, at["scored"], at["progress"], [layout.entity, layout.date], layout.arrival, layout.date, score
    )
    query.awaitTermination()
    changed = refresh_by_day(
        spark, at["scored"], at["alerts"], lambda rows: scoring.alerts(rows).select(*layout.alert_columns), layout.date
    )
    refresh_by_day(
        spark,
        at["scored"],
        at["trend_parts"],
        lambda rows: parts.trend_parts(rows, layout.trend_keys, list(layout.trend_means or ()), layout.date),
        layout.date,
    )
    refresh_by_day(
        spark,
        at["scored"],
        at["moment_parts"],
        lambda rows: parts.moment_parts(rows, layout.metrics, layout.entity, layout.date),
        layout.date,
    )
    return {"rows_read": latest.rows_read(query), "days": changed}


def reports(spark: SparkSession, out: str, layout: Layout, tie: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The reports as of the last refresh; trends and statistics read parts only."""
    at = paths(out)
    alerts = published.read(spark, at["alerts"], layout.date)
    trends = published.read(spark, at["trend_parts"], layout.date)
    moments = published.read(spark, at["moment_parts"], layout.date)
    means = dict(layout.trend_means or {})
    return {
        "alerts": alerts.orderBy(*scoring.alert_order(alerts, layout.entity, layout.date, tie)),
        "trends": parts.trend_of_parts(trends, layout.trend_keys, means).orderBy(*layout.trend_keys),
        "monthly_trends": parts.monthly_trend_of_parts(trends, layout.category, means, layout.date),
        "entity_stats": parts.entity_stats_of_parts(moments, layout.metrics, layout.entity, layout.date),
    }
