"""Descriptive statistics and the entity's own baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import READINGS_E, query, readings_e, readings_l, table
from entityhealth.operators import aggregates, entities


def _describe(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS metric, count({column}) AS n, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS stddev, min({column}) AS min, max({column}) AS max FROM lineitem"""


@query(
    "describe_metrics",
    " UNION ALL ".join(
        _describe(n, c)
        for n, c in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"))
    ),
)
def describe_metrics(spark, sf):
    out = aggregates.describe_metrics(readings_l(spark, sf), ["quantity", "price", "discount"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


PAIRS = (("quantity", "discount"), ("price", "discount"), ("quantity", "price"), ("price", "line"))
SQL_NAMES = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "line": "l_linenumber"}


@query(
    "correlations",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS left_metric, '{b}' AS right_metric,
        round(corr({SQL_NAMES[a]}, {SQL_NAMES[b]}), 6) AS correlation FROM lineitem"""
        for a, b in PAIRS
    ),
)
def correlations(spark, sf):
    return aggregates.correlations(readings_l(spark, sf), PAIRS).withColumn(
        "correlation", F.round("correlation", 6)
    )


@query(
    "entity_stats",
    f"""WITH {READINGS_E} SELECT entity_id, round(avg(value), 6) AS avg_value,
      round(stddev_samp(value), 6) AS stddev_value FROM readings GROUP BY entity_id""",
)
def entity_stats(spark, sf):
    out = entities.entity_stats(readings_e(spark, sf), ["value"], "entity_id")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_value", "stddev_value")})


@query(
    "entity_stats_window",
    f"""WITH {READINGS_E} SELECT event_id, entity_id, date, value,
      round(avg(value) OVER (PARTITION BY entity_id), 6) AS avg_value,
      round(stddev_samp(value) OVER (PARTITION BY entity_id), 6) AS stddev_value FROM readings""",
)
def entity_stats_window(spark, sf):
    """Every reading next to its entity's mean and deviation."""
    out = entities.with_entity_stats(readings_e(spark, sf).drop("category"), ["value"], "entity_id")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_value", "stddev_value")})


@query(
    "self_baseline_anomalies",
    r"""WITH readings AS (
      SELECT user_id AS entity_id, CAST(ts AS DATE) AS date, value AS price,
        CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) AS quantity FROM events
    ), stats AS (
      SELECT entity_id, avg(price) AS ap, stddev_samp(price) AS sp, avg(quantity) AS aq, stddev_samp(quantity) AS sq
      FROM readings GROUP BY entity_id
    ), scored AS (
      SELECT *, (price - ap) / nullif(sp, 0) AS zp, (quantity - aq) / nullif(sq, 0) AS zq FROM readings JOIN stats USING (entity_id)
    )
    SELECT entity_id, date, price, round(ap, 6) AS avg_price, round(sp, 6) AS stddev_price,
      round(zp, 6) AS price_anomaly_score, coalesce(abs(zp) > 2, false) AS is_price_anomaly,
      quantity, round(aq, 6) AS avg_quantity, round(sq, 6) AS stddev_quantity,
      round(zq, 6) AS quantity_anomaly_score, coalesce(abs(zq) > 2, false) AS is_quantity_anomaly
    FROM scored WHERE coalesce(abs(zp) > 2, false) OR coalesce(abs(zq) > 2, false)""",
)
def self_baseline_anomalies(spark, sf):
    """Readings far from their entity's own mean."""
    readings = table(spark, sf, "events").select(
        F.col("user_id").alias("entity_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("quantity"),
    )
    out = entities.self_baseline_anomalies(readings, ["price", "quantity"], "entity_id")
    computed = [c for c in out.columns if c.startswith(("avg_", "stddev_")) or c.endswith("_score")]
    return out.withColumns({c: F.round(c, 6) for c in computed})


@query(
    "latest_per_entity",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""",
)
def latest_per_entity(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderstatus", "o_totalprice"
    )
    return entities.latest_per_entity(orders, "o_custkey", "date", [F.col("o_orderkey").desc()])
