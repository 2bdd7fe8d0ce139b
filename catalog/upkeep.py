"""Daily upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import READINGS_E, query, readings_e, table
from entityhealth.operators import aggregates, upkeep

LINE_ORDER = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


@query(
    "dedupe_keep_last",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
          FROM lineitem) WHERE rn = 1""",
)
def dedupe_keep_last(spark, sf):
    """One row per order line, the last shipped."""
    lines = table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return upkeep.dedupe_keep_last(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


CARRIED = f"""{READINGS_E}, day AS (SELECT max(date) AS d FROM readings), last AS (
    SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY date DESC, category DESC) AS rn FROM readings
  ), carried AS (
    SELECT CAST(NULL AS BIGINT) AS event_id, entity_id, d AS date, category, CAST(NULL AS DOUBLE) AS value
    FROM last, day WHERE rn = 1 AND date <> d)"""


@query("carry_forward", f"WITH {CARRIED} SELECT * FROM carried")
def carry_forward(spark, sf):
    """A row on the last day for entities without one, with the category they had last."""
    readings = readings_e(spark, sf)
    last = aggregates.latest_date(readings).scalar()
    return upkeep.carry_forward(readings, last, ["category"], "entity_id")


@query(
    "allocate_ids",
    """WITH used AS (SELECT DISTINCT 'pet' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(3, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS pet_id
      FROM customer WHERE c_mktsegment <> 'FURNITURE'), n AS (SELECT count(*) AS used FROM used),
    numbers AS (SELECT i AS number, 'pet' || lpad(CAST(i AS VARCHAR), CAST(greatest(3, length(CAST(i AS VARCHAR))) AS INTEGER), '0') AS pet_id
      FROM range((SELECT count(*) FROM customer)) t(i))
    SELECT number, pet_id FROM (SELECT *, row_number() OVER (ORDER BY number) AS rn FROM numbers ANTI JOIN used USING (pet_id))
    WHERE rn <= (SELECT least(200, (SELECT count(*) FROM customer) - used) FROM n)""",
)
def allocate_ids(spark, sf):
    """Up to 200 of the lowest ids that customers outside one segment leave free."""
    customers = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    pet = F.concat(F.lit("pet"), F.when(F.length(key) >= 3, key).otherwise(F.lpad(key, 3, "0")))
    used = customers.where(F.col("c_mktsegment") != "FURNITURE").select(pet.alias("pet_id"))
    return upkeep.allocate_ids(used, quota=200, target=customers.count())


@query(
    "daily_upsert",
    f"""WITH {CARRIED}, incoming AS (
      SELECT event_id, user_id AS entity_id, d AS date, event_type AS category, value * 2 AS value
      FROM events, day WHERE event_type = 'signup'
    ), merged AS (
      SELECT *, 0 AS source FROM readings UNION ALL SELECT *, 1 FROM carried UNION ALL SELECT *, 2 FROM incoming
    )
    SELECT event_id, entity_id, date, category, value FROM (
      SELECT *, row_number() OVER (PARTITION BY entity_id, date
        ORDER BY source DESC, event_id DESC NULLS LAST, category DESC, value DESC NULLS LAST) AS rn FROM merged)
    WHERE rn = 1""",
)
def daily_upsert(spark, sf):
    """Carried rows, then incoming readings of the last day, into the existing table."""
    readings = readings_e(spark, sf)
    last = aggregates.latest_date(readings).scalar()
    incoming = readings.where(F.col("category") == "signup").withColumns(
        {"date": last, "value": F.col("value") * 2}
    )
    return upkeep.daily_upsert(readings, incoming, last, ["category"], ["event_id"], "entity_id")
