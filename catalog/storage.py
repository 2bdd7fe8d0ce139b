"""Joins on stored buckets, clustered tables, resampled bands, sketches of days."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import ORACLES, READINGS_E, notes_d, query, readings_e
from entityhealth.operators import aggregates, cleanse, joins, resampling, sketches
from entityhealth.plans import incremental
from entityhealth.session import scratch_path
from entityhealth.sources import bucketed, clustered, published

BUCKETS = 16
ON = ("entity_id", "date")


@query("notes_left_bucketed", ORACLES["notes_left"])
def notes_left_bucketed(spark, sf):
    """Readings with their notes, both stored in buckets of entity and day."""
    readings = bucketed.write_bucketed(readings_e(spark, sf), bucketed.bucketed_path(spark, "readings"), BUCKETS, ON)
    texts = notes_d(spark, sf).withColumn("note_md5", F.md5(F.col("note_text").cast("binary"))).drop("note_text")
    notes = bucketed.write_bucketed(texts, bucketed.bucketed_path(spark, "notes"), BUCKETS, ON)
    return joins.attach_notes(readings, notes, ON, skewed=False)


_DRAWN = " + ".join(f"CAST(drawn >= {bound} AS INTEGER)" for bound in resampling.POISSON)


@query(
    "daily_mean_bootstrap",
    f"""WITH {READINGS_E}, drawn AS (
      SELECT entity_id, date, value, b, i, CAST('0x' || substr(md5(event_id || ':' || b), 1 + 4 * i, 4) AS INTEGER) AS drawn
      FROM readings, range(25) t(b), range(8) u(i)
    ), means AS (
      SELECT entity_id, date, b, i, sum(({_DRAWN}) * value) / nullif(sum({_DRAWN}), 0) AS m FROM drawn GROUP BY ALL
    ), plain AS (SELECT entity_id, date, count(*) AS readings, avg(value) AS value_mean FROM readings GROUP BY ALL)
    SELECT entity_id, date, readings, round(value_mean, 9) AS value_mean, round(quantile_cont(m, 0.025), 9) AS value_low,
      round(quantile_cont(m, 0.975), 9) AS value_high
    FROM plain JOIN means USING (entity_id, date) GROUP BY entity_id, date, readings, value_mean""",
)
def daily_mean_bootstrap(spark, sf):
    """Daily means with a resampled band of 200 replicates."""
    out = resampling.daily_mean_bootstrap(readings_e(spark, sf), "value", ["event_id"], "entity_id")
    return out.withColumns({c: F.round(c, 9) for c in ("value_mean", "value_low", "value_high")})


# --- tables laid out for look-ups ------------------------------------------------


@query("entity_series_clustered", ORACLES["entity_series"])
def entity_series_clustered(spark, sf):
    """The first entity's series from readings that are clustered by entity and day."""
    readings = clustered.write_clustered(readings_e(spark, sf), scratch_path(spark, "by-entity"), ("entity_id", "date"))
    return cleanse.entity_slice(readings, "entity_id", readings.agg(F.min("entity_id")).scalar())


@query("last_day_of_footers", ORACLES["latest_date_rows"])
def last_day_of_footers(spark, sf):
    """The rows of the last day, which the files' footers name."""
    path = scratch_path(spark, "by-day")
    clustered.write_clustered(readings_e(spark, sf), path, ("date", "entity_id"), ("entity_id",))
    return clustered.last_day_rows(spark, path)


# --- quantiles of days -------------------------------------------------------------


@query("quartiles_of_sketches")
def quartiles_of_sketches(spark, sf):
    """Quartiles per category over all days, from sketches kept by day and made anew for a day that was corrected."""
    path, derived = scratch_path(spark, "readings"), scratch_path(spark, "sketches")
    readings = readings_e(spark, sf)

    def refresh():
        incremental.refresh_by_day(spark, path, derived, lambda rows: sketches.quantile_parts(rows, ["category"], "value"))

    published.publish(readings, path)
    refresh()
    corrected = aggregates.latest_date_rows(published.read(spark, path)).withColumn("value", F.col("value") + 1)
    published.publish(corrected, path)
    refresh()
    return sketches.quantiles_of_parts(published.read(spark, derived), ["category"], (0.25, 0.5, 0.75), ("q1", "median", "q3"))
