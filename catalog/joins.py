"""Joins with profiles, notes and device days; rows by latest day and by entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import NOTES_D, READINGS_E, notes_d, query, readings_e, readings_of, table
from entityhealth.operators import aggregates, cleanse, entities, joins


@query(
    "profile_inner",
    """SELECT l_orderkey, l_linenumber, l_suppkey AS entity_id, l_quantity, s_name, s_nationkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
)
def profile_inner(spark, sf):
    fact = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("entity_id"), "l_quantity"
    )
    profile = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity_id"), "s_name", "s_nationkey")
    return joins.attach_profile(fact, profile, "entity_id", "inner")


@query(
    "profile_left_replace",
    f"""WITH {READINGS_E} SELECT event_id, entity_id, date, value, c_mktsegment AS category, c_name AS name
    FROM readings LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON entity_id = c_custkey""",
)
def profile_left_replace(spark, sf):
    """The profile's category replaces the reading's own, also where there is no profile."""
    profile = table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    profile = profile.select(
        F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("category"), F.col("c_name").alias("name")
    )
    return joins.attach_profile(readings_e(spark, sf), profile, "entity_id", "left", replace=["category", "name"])


@query(
    "notes_left",
    f"""WITH {READINGS_E}, {NOTES_D} SELECT event_id, r.entity_id, r.date, category, value, doc_id,
      md5(note_text) AS note_md5 FROM readings r LEFT JOIN notes n ON r.entity_id = n.entity_id AND r.date = n.date""",
)
def notes_left(spark, sf):
    """Readings repeat for each note of their entity and day."""
    notes = notes_d(spark, sf).withColumn("note_md5", F.md5(F.col("note_text").cast("binary"))).drop("note_text")
    return joins.attach_notes(readings_e(spark, sf), notes, ("entity_id", "date"))


@query(
    "notes_left_split",
    f"""WITH {READINGS_E}, {NOTES_D} SELECT event_id, r.entity_id, r.date, doc_id
      FROM readings r LEFT JOIN notes n ON r.entity_id = n.entity_id AND r.date = n.date""",
)
def notes_left_split(spark, sf):
    """The same join with the splitting of hot keys switched on for keys of two rows and more."""
    readings = readings_e(spark, sf).select("event_id", "entity_id", "date")
    notes = notes_d(spark, sf).drop("note_text")
    return joins.skew_join(readings, notes, ("entity_id", "date"), "left", task_rows=2)


@query(
    "latest_date_rows",
    f"WITH {READINGS_E} SELECT * FROM readings WHERE date = (SELECT max(date) FROM readings)",
)
def latest_date_rows(spark, sf):
    return readings_of(aggregates.latest_date_rows(table(spark, sf, "events"), "ts"))


@query(
    "entity_series",
    f"WITH {READINGS_E} SELECT * FROM readings WHERE entity_id = (SELECT min(entity_id) FROM readings)",
)
def entity_series(spark, sf):
    """The time series of the first entity, which is shown by default."""
    readings = readings_e(spark, sf)
    first = readings.agg(F.min("entity_id")).scalar()
    return cleanse.entity_slice(readings, "entity_id", first)


@query(
    "available_ids",
    """WITH ids AS (SELECT c_custkey AS entity_id, 0 AS source FROM customer WHERE c_acctbal < -1000000
      UNION SELECT user_id, 1 FROM events UNION SELECT o_custkey, 2 FROM orders)
    SELECT entity_id FROM ids WHERE source = (SELECT min(source) FROM ids)""",
)
def available_ids(spark, sf):
    """Ids of the first of three tables that has rows; the first has none."""
    none = table(spark, sf, "customer").where(F.col("c_acctbal") < -1000000)
    return entities.available_ids(
        none.select(F.col("c_custkey").alias("entity_id")),
        table(spark, sf, "events").select(F.col("user_id").alias("entity_id")),
        table(spark, sf, "orders").select(F.col("o_custkey").alias("entity_id")),
        entity="entity_id",
    )


@query(
    "missing_on_date",
    f"""WITH {READINGS_E} SELECT DISTINCT entity_id FROM readings WHERE entity_id NOT IN (
      SELECT entity_id FROM readings WHERE date = (SELECT max(date) FROM readings))""",
)
def missing_on_date(spark, sf):
    readings = readings_e(spark, sf)
    last = aggregates.latest_date(readings).scalar()
    return joins.missing_on(readings, last, "entity_id")
