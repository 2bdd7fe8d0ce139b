"""Trends, counts and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import READINGS_E, READINGS_L, query, readings_e, readings_l, readings_of, table
from entityhealth.operators import aggregates, cleanse, ranks

MEANS = {"quantity": "avg_quantity", "price": "avg_price", "discount": "avg_discount"}


def _half_up(column: str, out: str) -> str:
    """A mean of 2-decimal values, half-up to 2 places, in integers."""
    hundredths = f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) * 100 AS HUGEINT)"
    return f"CAST((2 * {hundredths} + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS {out}"


MEANS_SQL = ", ".join(_half_up(c, out) for c, out in MEANS.items())


@query(
    "breed_trend",
    f"""WITH {READINGS_L} SELECT category, p_brand AS breed, {MEANS_SQL}
    FROM readings JOIN part ON part_id = p_partkey GROUP BY category, p_brand""",
)
def breed_trend(spark, sf):
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("breed"))
    return aggregates.trend_by_profile(readings_l(spark, sf), brands, "part_id", ["category", "breed"], MEANS)


@query(
    "monthly_trend",
    f"""WITH {READINGS_L} SELECT category, strftime(date, '%Y-%m') AS year_month, {MEANS_SQL},
      count(*) AS total_records FROM readings GROUP BY ALL""",
)
def monthly_trend(spark, sf):
    return aggregates.trend_by_month(readings_l(spark, sf), "category", "date", MEANS)


@query(
    "species_counts",
    f"""WITH {READINGS_L} SELECT category, count(*) AS n FROM readings GROUP BY category
    UNION ALL SELECT 'all', count(*) FROM readings""",
)
def species_counts(spark, sf):
    readings = readings_l(spark, sf)
    counts = aggregates.counts_by(readings, "category")
    whole = readings.agg(F.count("*").alias("n")).select(F.lit("all").alias("category"), "n")
    return counts.unionByName(whole)


@query("top_counts", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 5")
def top_counts(spark, sf):
    return aggregates.top_counts(table(spark, sf, "lineitem"), "l_suppkey", 5)


@query(
    "profile_columns",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS non_null FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', count(nullif(o_orderstatus, 'P')) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def profile_columns(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return aggregates.profile_columns(orders)


@query(
    "weekly_summary",
    f"""WITH {READINGS_E} SELECT entity_id, CAST(isoyear(date) AS INTEGER) AS iso_year,
      CAST(week(date) AS INTEGER) AS week_of_year, round(avg(value), 6) AS avg_value FROM readings GROUP BY ALL""",
)
def weekly_summary(spark, sf):
    weeks = aggregates.weekly_summary(readings_e(spark, sf), {"value": "avg_value"}, "entity_id")
    return weeks.withColumn("avg_value", F.round("avg_value", 6))


@query(
    "daily_mean",
    f"""WITH {READINGS_E} SELECT entity_id, date, count(*) AS readings, round(avg(value), 6) AS value_mean,
      round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS value_low,
      round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS value_high
    FROM readings GROUP BY entity_id, date""",
)
def daily_mean(spark, sf):
    days = aggregates.daily_mean(readings_e(spark, sf), ["value"], "entity_id")
    return days.withColumns({c: F.round(c, 6) for c in ("value_mean", "value_low", "value_high")})


BOX_SQL = """quartiles AS (
  SELECT category, metric, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL)
SELECT l.category, l.metric, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, n,
  min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM long l JOIN quartiles q ON l.category = q.category AND l.metric = q.metric
GROUP BY l.category, l.metric, q1, median, q3, n"""


def _rounded(box):
    return box.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(
    "box_stats",
    f"""WITH {READINGS_E}, latest AS (SELECT * FROM readings WHERE date = (SELECT max(date) FROM readings)),
    long AS (SELECT category, 'value' AS metric, value FROM latest
             UNION ALL SELECT category, 'half', value / 2 FROM latest), {BOX_SQL}""",
)
def box_stats(spark, sf):
    """Box plots of the last day's readings per category and metric."""
    latest = readings_of(aggregates.latest_date_rows(table(spark, sf, "events"), "ts"))
    latest = latest.withColumn("half", F.col("value") / 2)
    return _rounded(ranks.box_stats(cleanse.melt_metrics(latest, ["category"], ["value", "half"]), ["category", "metric"]))


@query(
    "box_stats_history",
    """WITH long AS (SELECT l_returnflag AS category, 'quantity' AS metric, l_quantity AS value FROM lineitem
      UNION ALL SELECT l_returnflag, 'price', l_extendedprice FROM lineitem
      UNION ALL SELECT l_returnflag, 'discount', l_discount FROM lineitem), """
    + BOX_SQL,
)
def box_stats_history(spark, sf):
    """The same over all days."""
    long = cleanse.melt_metrics(readings_l(spark, sf), ["category"], ["quantity", "price", "discount"])
    return _rounded(ranks.box_stats(long, ["category", "metric"]))
