"""Registration of queries next to their SQL, and the stand-in tables they read.

Readings come from `lineitem` (several metrics) or `events` (one metric, day
grain), profiles from `supplier`, `customer` and `part`, notes from
`documents`. Each stand-in exists twice, as DataFrame and as SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityhealth.operators import joins, scoring
from entityhealth.rules import ILLNESS, STRESS, Baseline, CategoryRules, Metric, RuleSet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- readings from lineitem -------------------------------------------------

RULES_L = RuleSet(
    metrics=(Metric("quantity", "quantity"), Metric("price", "price"), Metric("discount", "discount")),
    signals=(STRESS, ILLNESS),
    categories=(
        CategoryRules(
            "A",
            {"quantity": Baseline(25, 10), "price": Baseline(40000, 15000), "discount": Baseline(0.05, 0.02)},
            {"quantity": 1, "price": 2, "discount": 1},
            red=4,
            orange=3,
        ),
        CategoryRules(
            "R",
            {"quantity": Baseline(20, 12), "discount": Baseline(0.04, 0.03)},
            {"quantity": 2, "discount": 3},
        ),
    ),
)


def readings_l(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("entity_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
    )


READINGS_L = """readings AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_suppkey AS entity_id,
         CAST(l_shipdate AS DATE) AS date, l_returnflag AS category,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount
  FROM lineitem)"""

SCORED_L = (
    READINGS_L
    + """, z AS (
  SELECT *,
    CASE category WHEN 'A' THEN (quantity - 25) / 10 WHEN 'R' THEN (quantity - 20) / 12 END AS quantity_zscore,
    CASE category WHEN 'A' THEN (price - 40000) / 15000 END AS price_zscore,
    CASE category WHEN 'A' THEN (discount - 0.05) / 0.02 WHEN 'R' THEN (discount - 0.04) / 0.03 END AS discount_zscore
  FROM readings WHERE category IN ('A', 'R')
), flagged AS (
  SELECT *,
    coalesce(abs(quantity_zscore) > 2, false) AS is_quantity_anomaly,
    coalesce(abs(price_zscore) > 2, false) AS is_price_anomaly,
    coalesce(abs(discount_zscore) > 2, false) AS is_discount_anomaly
  FROM z
), pointed AS (
  SELECT *,
    CAST(CASE category
      WHEN 'A' THEN CAST(is_quantity_anomaly AS INTEGER) + 2 * CAST(is_price_anomaly AS INTEGER)
                    + CAST(is_discount_anomaly AS INTEGER)
      ELSE 2 * CAST(is_quantity_anomaly AS INTEGER) + 3 * CAST(is_discount_anomaly AS INTEGER) END
    AS INTEGER) AS risk_score
  FROM flagged
), scored AS (
  SELECT *, CASE
      WHEN risk_score >= CASE category WHEN 'A' THEN 4 ELSE 5 END THEN 'Đỏ (Nguy cơ cao)'
      WHEN risk_score >= 3 THEN 'Cam (Cảnh báo)'
      WHEN risk_score >= 1 THEN 'Vàng (Theo dõi)'
      ELSE 'Xanh (Bình thường)' END AS health_alert_level
  FROM pointed)"""
)


def scored_l(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(readings_l(spark, sf), RULES_L, category="category")


# --- readings from events, notes from documents ------------------------------

RULES_E = RuleSet(
    metrics=(Metric("value", "value"),),
    signals=(STRESS, ILLNESS),
    categories=tuple(
        CategoryRules(
            name,
            {"value": Baseline(mean, std)},
            {"value": 2, "stress": 2, "illness": 3},
            {"stress": stress, "illness": illness},
        )
        for name, mean, std, stress, illness in (
            ("click", 50, 40, ("License", "was "), ("all rights",)),
            ("view", 45, 35, ("license",), ("ALL RIGHTS", "was ")),
            ("purchase", 50, 50, ("was ",), ("license", "all rights")),
            ("error", 30, 30, (), ("license",)),
        )
    ),
)


def readings_e(spark: SparkSession, sf: str) -> DataFrame:
    return readings_of(table(spark, sf, "events"))


def readings_of(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("category"),
        "value",
    )


READINGS_E = """readings AS (
  SELECT event_id, user_id AS entity_id, CAST(ts AS DATE) AS date, event_type AS category, value FROM events)"""


def notes_d(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        (F.col("doc_id") % 150).alias("entity_id"),
        F.expr("date_add(DATE'2024-01-01', cast((doc_id div 150) % 30 AS int))").alias("date"),
        "doc_id",
        F.col("text").alias("note_text"),
    )


NOTES_D = """notes AS (
  SELECT doc_id % 150 AS entity_id, CAST(DATE '2024-01-01' + CAST((doc_id // 150) % 30 AS INTEGER) AS DATE) AS date,
         doc_id, text AS note_text FROM documents)"""

SCORED_E = f"""{READINGS_E}, {NOTES_D}, noted AS (
  SELECT r.*, n.doc_id, n.note_text, lower(n.note_text) AS low
  FROM readings r LEFT JOIN notes n ON r.entity_id = n.entity_id AND r.date = n.date
), flagged AS (
  SELECT event_id, entity_id, date, category, value, doc_id, note_text,
    CASE category WHEN 'click' THEN (value - 50) / 40 WHEN 'view' THEN (value - 45) / 35
                  WHEN 'purchase' THEN (value - 50) / 50 ELSE (value - 30) / 30 END AS value_zscore,
    coalesce(CASE category WHEN 'click' THEN contains(low, 'license') OR contains(low, 'was ')
                  WHEN 'view' THEN contains(low, 'license')
                  WHEN 'purchase' THEN contains(low, 'was ') ELSE false END, false) AS note_is_stressful,
    coalesce(CASE category WHEN 'click' THEN contains(low, 'all rights')
                  WHEN 'view' THEN contains(low, 'all rights') OR contains(low, 'was ')
                  WHEN 'purchase' THEN contains(low, 'license') OR contains(low, 'all rights')
                  ELSE contains(low, 'license') END, false) AS note_is_illness_related
  FROM noted WHERE category IN ('click', 'view', 'purchase', 'error')
), pointed AS (
  SELECT *, abs(value_zscore) > 2 AS is_value_anomaly,
    CAST(2 * CAST(abs(value_zscore) > 2 AS INTEGER) + 2 * CAST(note_is_stressful AS INTEGER)
         + 3 * CAST(note_is_illness_related AS INTEGER) AS INTEGER) AS risk_score
  FROM flagged
), scored AS (
  SELECT *, CASE WHEN risk_score >= 5 THEN 'Đỏ (Nguy cơ cao)' WHEN risk_score >= 3 THEN 'Cam (Cảnh báo)'
                 WHEN risk_score >= 1 THEN 'Vàng (Theo dõi)' ELSE 'Xanh (Bình thường)' END AS health_alert_level
  FROM pointed)"""


def scored_e(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their notes, scored. Notes are searched before the join."""
    notes = scoring.annotate_notes(notes_d(spark, sf), RULES_E)
    noted = joins.attach_notes(readings_e(spark, sf), notes, ("entity_id", "date"))
    return scoring.score(noted, RULES_E, category="category")


# --- device log lines from events ---------------------------------------------


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    who = F.concat(F.lit("Pet Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit(" "))
    kind = F.col("event_type")
    level = F.when(kind.isin("error", "signup"), "WARN").otherwise("INFO")
    message = (
        F.when(kind == "purchase", F.concat(who, F.lit("Food Dispensed: "), F.floor("value").cast("string"), F.lit("g")))
        .when(kind == "error", F.concat(who, F.lit("Feeder Jammed")))
        .when(kind == "signup", F.lit("Unusual behavior detected: barking for long."))
        .when(kind == "click", F.concat(who, F.lit("Unusual behavior detected: no meal")))
        .otherwise(F.concat(who, F.lit("started eating.")))
    )
    return table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("["), level, F.lit("] "), stamp, F.lit(" - "), message).alias("value")
    )


LOG_LINES = """lines AS (
  SELECT event_id, '[' || CASE WHEN event_type IN ('error', 'signup') THEN 'WARN' ELSE 'INFO' END || '] '
    || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - '
    || CASE event_type
         WHEN 'purchase' THEN 'Pet Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' Food Dispensed: '
                              || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 'g'
         WHEN 'error' THEN 'Pet Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' Feeder Jammed'
         WHEN 'signup' THEN 'Unusual behavior detected: barking for long.'
         WHEN 'click' THEN 'Pet Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' Unusual behavior detected: no meal'
         ELSE 'Pet Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' started eating.' END AS value
  FROM events)"""


def _parsed_sql(pattern: str) -> str:
    return f"""parsed AS (
  SELECT event_id, try_strptime(stamp, '%Y-%m-%d %H:%M:%S') AS log_timestamp, log_level, pet_name_from_log,
    log_message, TRY_CAST(regexp_extract(log_message, 'Food Dispensed: (\\d+)g', 1) AS INTEGER) AS food_dispensed_g,
    contains(log_message, 'Feeder Jammed') AS feeder_jammed_event,
    contains(log_message, 'Unusual behavior detected') AS unusual_behavior_detected
  FROM (SELECT event_id, regexp_extract(value, '{pattern}', 1) AS log_level,
               regexp_extract(value, '{pattern}', 2) AS stamp, regexp_extract(value, '{pattern}', 3) AS pet_name_from_log,
               regexp_extract(value, '{pattern}', 4) AS log_message FROM lines))"""


PARSED = LOG_LINES + ", " + _parsed_sql(
    r"\[(INFO|WARN)\] (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - Pet (.*?) (.*)"
)
PARSED_NAME_OPTIONAL = LOG_LINES + ", " + _parsed_sql(
    r"\[(INFO|WARN)\] (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (?:Pet (.*?) )?(.*)"
)
DAILY = """daily AS (
  SELECT strftime(log_timestamp, '%Y-%m-%d') AS log_date, pet_name_from_log,
    CAST(sum(food_dispensed_g) AS BIGINT) AS daily_food_dispensed_g,
    CAST(count_if(feeder_jammed_event) AS BIGINT) AS daily_feeder_jams,
    CAST(count_if(unusual_behavior_detected) AS BIGINT) AS daily_unusual_behaviors
  FROM parsed GROUP BY ALL)"""
