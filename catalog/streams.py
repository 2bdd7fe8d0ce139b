"""Streams and incremental reports against the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.jobs import land_for_refresh, refresh
from catalog.registry import ORACLES, RULES_E, query, table
from entityhealth.operators import parts, scoring
from entityhealth.plans import incremental
from entityhealth.schemas import struct
from entityhealth.session import scratch_path
from entityhealth.sources import published
from entityhealth.streaming import daily_scores, latest

EVENTS = struct(
    event_id="bigint", ts="timestamp_ntz", user_id="bigint", event_type="string", value="double", props="string"
)

KNOWN = """known AS (
      SELECT event_id, user_id AS entity_id, CAST(ts AS DATE) AS date, event_type AS category, value,
        CASE event_type WHEN 'click' THEN (value - 50) / 40 WHEN 'view' THEN (value - 45) / 35
                        WHEN 'purchase' THEN (value - 50) / 50 ELSE (value - 30) / 30 END AS value_zscore
      FROM events WHERE event_type IN ('click', 'view', 'purchase', 'error')
    ), last AS (
      SELECT event_id, entity_id, date, category, value, value_zscore,
        CAST(CASE WHEN abs(value_zscore) > 2 THEN 2 ELSE 0 END AS INTEGER) AS risk_score
      FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, date ORDER BY event_id DESC) AS rn FROM known)
      WHERE rn = 1)"""
COLUMNS = ("event_id", "entity_id", "date", "category", "value", "value_zscore", "risk_score")


def _readings(events):
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("at"),
        F.col("user_id").alias("entity_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("category"),
        "value",
    )


def _score(batch):
    return scoring.score(batch.drop("at"), RULES_E, "category").select(*COLUMNS)


def instalments(spark, sf):
    """The events as four deliveries: ten days each, a tenth of them one delivery late, and a seventh delivered again at the end."""
    events = table(spark, sf, "events")
    due = F.least(F.lit(2), F.floor(F.datediff("ts", F.lit("2024-01-01")) / 10)) + (F.col("event_id") % 10 == 0).cast("int")
    dealt = events.withColumn("due", due)
    again = dealt.where(F.col("event_id") % 7 == 0).withColumn("due", F.lit(3))
    return [dealt.unionByName(again).where(F.col("due") == i).drop("due") for i in range(4)]


def land_instalment(rows, path: str) -> None:
    """One file, which is one micro-batch of the stream."""
    rows.coalesce(1).write.mode("append").parquet(path)


def landed_stream(spark, path: str):
    """Landed files, one a micro-batch, without repeated deliveries; nothing is late by more than a month."""
    files = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    return latest.once(_readings(files), "at", "40 days", ["entity_id", "date", "event_id"])


@query(
    "stream_daily_scores",
    f"WITH {KNOWN} SELECT * FROM last",
)
def stream_daily_scores(spark, sf):
    """Events scored as a stream and appended by day; the last of each entity and day."""
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-progress")
    events = daily_scores.read_landed(spark, sf, EVENTS, "events.parquet")
    scored = daily_scores.score_stream(_readings(events).drop("at"), RULES_E, "category")
    daily_scores.append_scores(scored, out, checkpoint).awaitTermination()
    last = daily_scores.current(spark, out, ["entity_id", "date"], ["event_id"])
    return last.select(*COLUMNS)


@query("stream_latest_scores", f"WITH {KNOWN} SELECT * FROM last")
def stream_latest_scores(spark, sf):
    """Four deliveries, late and repeated rows among them, each merged into the table of last scores as a micro-batch."""
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "latest", "latest-progress"))
    for rows in instalments(spark, sf):
        land_instalment(rows, landed)
    stream = landed_stream(spark, landed)
    latest.keep_latest(stream, out, checkpoint, ["entity_id", "date"], ["event_id"], prepare=_score).awaitTermination()
    return published.read(spark, out)


# --- incremental reports ----------------------------------------------------------

LAYOUT = incremental.Layout(
    "entity_id",
    "date",
    "category",
    arrival=("event_id",),
    alert_columns=COLUMNS,
    trend_keys=("category",),
    trend_means={"value": "avg_value"},
    metrics=("value", "value_zscore"),
)


def incremental_reports(spark, sf):
    """Reports refreshed after two deliveries, and again after the other two."""
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "incremental")
    given = instalments(spark, sf)
    for some in (given[:2], given[2:]):
        for rows in some:
            land_instalment(rows, landed)
        incremental.refresh_reports(landed_stream(spark, landed), out, _score, LAYOUT)
    return incremental.reports(spark, out, LAYOUT, tie=["event_id"])


def _half_up(column: str, out: str) -> str:
    hundredths = f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) * 100 AS HUGEINT)"
    return f"CAST((2 * {hundredths} + count({column})) // (2 * count({column})) AS DOUBLE) / 100 AS {out}"


@query("incremental_alerts", f"WITH {KNOWN} SELECT * FROM last WHERE risk_score > 0")
def incremental_alerts(spark, sf):
    """Alerts kept by day, of which a refresh makes the changed days anew."""
    return incremental_reports(spark, sf)["alerts"]


@query(
    "incremental_trends",
    f"""WITH {KNOWN} SELECT category, strftime(date, '%Y-%m') AS year_month, {_half_up("value", "avg_value")},
      count(*) AS total_records FROM last GROUP BY category, strftime(date, '%Y-%m')""",
)
def incremental_trends(spark, sf):
    """Monthly trends from sums kept by day."""
    return incremental_reports(spark, sf)["monthly_trends"]


@query(
    "incremental_entity_stats",
    f"""WITH {KNOWN} SELECT entity_id, round(avg(value), 9) AS avg_value, round(stddev_samp(value), 9) AS stddev_value,
      round(avg(value_zscore), 9) AS avg_value_zscore, round(stddev_samp(value_zscore), 9) AS stddev_value_zscore
    FROM last GROUP BY entity_id""",
)
def incremental_entity_stats(spark, sf):
    """Entity statistics from means and squared deviations kept by day."""
    stats = incremental_reports(spark, sf)["entity_stats"]
    return stats.select("entity_id", *[F.round(c, 9).alias(c) for c in stats.columns[1:]])


# --- aggregates of a table that a refresh changes ------------------------------------


def maintained(spark, sf):
    """Parts of a landed table, brought up to date after its daily refresh."""
    path, trends, moments = (scratch_path(spark, n) for n in ("refresh", "trend-parts", "moment-parts"))
    land_for_refresh(spark, sf, path)

    def refresh_parts():
        incremental.refresh_by_day(spark, path, trends, lambda rows: parts.trend_parts(rows, ["category"], ["value"]))
        incremental.refresh_by_day(spark, path, moments, lambda rows: parts.moment_parts(rows, ["value"], "entity_id"))

    refresh_parts()
    refresh(spark, sf, path)
    refresh_parts()
    return published.read(spark, trends), published.read(spark, moments)


@query(
    "maintained_trends",
    f"""WITH refreshed AS ({ORACLES["refresh_job"]})
    SELECT category, strftime(date, '%Y-%m') AS year_month, {_half_up("value", "avg_value")}, count(*) AS total_records
    FROM refreshed GROUP BY category, strftime(date, '%Y-%m')""",
)
def maintained_trends(spark, sf):
    """Monthly trends after a refresh, from the sums of the days that it changed and of those it did not."""
    return parts.monthly_trend_of_parts(maintained(spark, sf)[0], "category", {"value": "avg_value"})


@query(
    "maintained_entity_stats",
    f"""WITH refreshed AS ({ORACLES["refresh_job"]})
    SELECT entity_id, round(avg(value), 9) AS avg_value, round(stddev_samp(value), 9) AS stddev_value
    FROM refreshed GROUP BY entity_id""",
)
def maintained_entity_stats(spark, sf):
    """Entity statistics after a refresh, merged from days."""
    stats = parts.entity_stats_of_parts(maintained(spark, sf)[1], ["value"], "entity_id")
    return stats.select("entity_id", *[F.round(c, 9).alias(c) for c in stats.columns[1:]])
