"""What users call on whole tables: the wide table, its exploration, and the tables behind the dashboard."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.jobs import READINGS
from catalog.registry import DAILY, PARSED, log_lines, query, table
from entityhealth.operators import scoring
from entityhealth.plans import jobs
from entityhealth.schemas import NOTE
from entityhealth.session import written

#: Names that the log uses, as a program lists them; others are unmapped.
NAMES = {f"Customer#{i:09d}": f"pet{i:09d}" for i in range(100)}


def _pet(number):
    return F.concat(F.lit("pet"), F.lpad(number.cast("string"), 9, "0"))


def _activity(spark, sf):
    return table(spark, sf, "events").select(
        _pet(F.col("user_id")).alias("pet_id"),
        F.col("ts").cast("date").alias("date"),
        F.when(F.col("event_id") % 11 != 0, F.floor(F.col("value") * 4)).otherwise(0).cast("double").alias("food_amount"),
        (F.floor("value") / 4).alias("sleep_hours"),
        (F.col("event_id") % 17).cast("int").alias("meow_count"),
        (F.floor("value") / 10).alias("weight_kg"),
    )


def _profiles(spark, sf):
    return table(spark, sf, "customer").select(
        _pet(F.col("c_custkey")).alias("pet_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 1, "cat").otherwise("dog").alias("species"),
        F.col("c_mktsegment").alias("breed"),
        (F.lit(2010) + F.col("c_custkey") % 12).cast("int").alias("birth_year"),
    )


def _notes(spark, sf):
    return table(spark, sf, "documents").select(
        _pet(F.col("doc_id") % 150).alias("pet_id"),
        F.expr("date_add(DATE'2024-01-01', cast((doc_id div 150) % 30 AS int))").alias("date"),
        F.col("text").alias("note_text"),
    )


def wide(spark, sf):
    """Readings, profiles, device log and notes in one table, written once for all that explores it."""
    counted = F.size(F.filter(vector_to_array("text_features"), lambda x: x > 0))
    n_features = {"n_features": F.when(F.col("text_features").isNotNull(), counted)}
    out = jobs.integrate(
        _activity(spark, sf), _profiles(spark, sf), log_lines(spark, sf).select("value"), _notes(spark, sf), NAMES, of_features=n_features
    )
    return written(out, "wide")


WIDE = f"""{PARSED}, {DAILY}, mapped AS (
  SELECT 'pet' || pet_name_from_log[10:] AS pet_id, CAST(log_date AS DATE) AS date, daily_food_dispensed_g, daily_feeder_jams,
    daily_unusual_behaviors FROM daily
  WHERE regexp_full_match(pet_name_from_log, 'Customer#\\d{{9}}') AND CAST(pet_name_from_log[10:] AS BIGINT) < 100
), own AS (
  SELECT 'pet' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS pet_id, CAST(ts AS DATE) AS date,
    CAST(CASE WHEN event_id % 11 <> 0 THEN floor(value * 4) ELSE 0 END AS DOUBLE) AS food_amount, floor(value) / 4 AS sleep_hours,
    CAST(event_id % 17 AS INTEGER) AS meow_count, floor(value) / 10 AS weight_kg FROM events
), pets AS (
  SELECT 'pet' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS pet_id, c_name AS name,
    CASE WHEN c_custkey % 3 = 1 THEN 'cat' ELSE 'dog' END AS species, c_mktsegment AS breed, 2010 + c_custkey % 12 AS birth_year FROM customer
), said AS (
  SELECT 'pet' || lpad(CAST(doc_id % 150 AS VARCHAR), 9, '0') AS pet_id,
    CAST(DATE '2024-01-01' + CAST((doc_id // 150) % 30 AS INTEGER) AS DATE) AS date FROM documents WHERE text IS NOT NULL
), wide AS (
  SELECT o.*, name, species, breed, CAST(year(o.date) - birth_year AS INTEGER) AS pet_age_at_log, daily_food_dispensed_g, daily_feeder_jams,
    daily_unusual_behaviors, s.pet_id IS NOT NULL AS has_note
  FROM own o JOIN pets p ON o.pet_id = p.pet_id LEFT JOIN mapped m ON o.pet_id = m.pet_id AND o.date = m.date
  LEFT JOIN said s ON o.pet_id = s.pet_id AND o.date = s.date)"""
SHOWN = """pet_id, date, food_amount, sleep_hours, meow_count, weight_kg, name, species, breed, pet_age_at_log, daily_food_dispensed_g,
  daily_feeder_jams, daily_unusual_behaviors, has_note"""


@query("integrate_job", f"WITH {WIDE} SELECT {SHOWN} FROM wide")
def integrate_job(spark, sf):
    """The wide table; of the note vectors, whether there is one."""
    return wide(spark, sf).withColumn("has_note", F.col("n_features").isNotNull()).select(*[c.strip() for c in SHOWN.split(",")])


def _explored(spark, sf):
    return jobs.explore(wide(spark, sf))


@query(
    "explore_describe",
    f"WITH {WIDE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM wide"
        for c in ("food_amount", "sleep_hours", "weight_kg")
    ),
)
def explore_describe(spark, sf):
    """Statistics of the wide table's metrics."""
    return _explored(spark, sf)["describe"].withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "explore_anomalies",
    f"""WITH {WIDE}, stats AS (
      SELECT pet_id, avg(food_amount) AS mf, stddev_samp(food_amount) AS sf, avg(sleep_hours) AS ms, stddev_samp(sleep_hours) AS ss FROM wide GROUP BY pet_id
    ), z AS (
      SELECT pet_id, date, food_amount, sleep_hours, (food_amount - mf) / nullif(sf, 0) AS zf, (sleep_hours - ms) / nullif(ss, 0) AS zs FROM wide JOIN stats USING (pet_id))
    SELECT pet_id, date, food_amount, round(zf, 6) AS food_score, coalesce(abs(zf) > 2, false) AS food_odd, sleep_hours, round(zs, 6) AS sleep_score,
      coalesce(abs(zs) > 2, false) AS sleep_odd FROM z WHERE coalesce(abs(zf) > 2, false) OR coalesce(abs(zs) > 2, false)""",
)
def explore_anomalies(spark, sf):
    """Readings far from the entity's own mean."""
    found = _explored(spark, sf)["anomalies"]
    return found.select(
        "pet_id",
        "date",
        "food_amount",
        F.round("food_amount_anomaly_score", 6).alias("food_score"),
        F.col("is_food_amount_anomaly").alias("food_odd"),
        "sleep_hours",
        F.round("sleep_hours_anomaly_score", 6).alias("sleep_score"),
        F.col("is_sleep_hours_anomaly").alias("sleep_odd"),
    )


@query("explore_loud", f"WITH {WIDE} SELECT pet_id, date, meow_count, daily_feeder_jams FROM wide WHERE meow_count > 10")
def explore_loud(spark, sf):
    """Readings over the fixed threshold."""
    return _explored(spark, sf)["loud"].select("pet_id", "date", "meow_count", "daily_feeder_jams")


@query("explore_jams", f"WITH {WIDE} SELECT pet_id, date, daily_feeder_jams FROM wide WHERE daily_feeder_jams > 0")
def explore_jams(spark, sf):
    """Readings on days when the entity's device jammed."""
    return _explored(spark, sf)["jams"].select("pet_id", "date", "daily_feeder_jams")


# --- dashboard ---------------------------------------------------------------------


def dashboard(spark, sf):
    """The dashboard's tables from scored readings; the prediction is a code that SQL can tell."""
    activity = _activity(spark, sf).withColumns({c: F.lit(None).cast("string") for c in ("name", "species", "breed")})
    readings = jobs.with_profiles(activity, _profiles(spark, sf))
    scored = written(jobs.score_readings(readings, spark.createDataFrame([], NOTE)), "scored")
    predictions = scored.withColumn("prediction", F.least(F.lit(3), F.col("meow_count") % 5).cast("double"))
    return jobs.dashboard_tables(scoring.alerts(scored), predictions, scored)


ALERTS = f"""{READINGS}, levelled AS (
  SELECT *, CASE WHEN risk_score >= 5 THEN 'Đỏ (Nguy cơ cao)' WHEN risk_score >= 3 THEN 'Cam (Cảnh báo)'
      WHEN risk_score >= 1 THEN 'Vàng (Theo dõi)' ELSE 'Xanh (Bình thường)' END AS health_alert_level,
    CAST(least(3, meow_count % 5) AS DOUBLE) AS prediction FROM scored
), alerts AS (SELECT * FROM levelled WHERE risk_score > 0)"""


@query(
    "dashboard_levels",
    f"""WITH {ALERTS}, levels AS (
      SELECT * FROM (VALUES (0, 'Đỏ (Nguy cơ cao)'), (1, 'Cam (Cảnh báo)'), (2, 'Vàng (Theo dõi)'), (3, 'Xanh (Bình thường)')) t(position, health_alert_level))
    SELECT position, l.health_alert_level, count(a.pet_id) AS n FROM levels l LEFT JOIN alerts a
      ON a.health_alert_level = l.health_alert_level AND a.date = (SELECT max(date) FROM alerts) GROUP BY position, l.health_alert_level""",
)
def dashboard_levels(spark, sf):
    return dashboard(spark, sf)["level_distribution"]


@query("dashboard_ids", f"WITH {ALERTS} SELECT DISTINCT pet_id FROM levelled")
def dashboard_ids(spark, sf):
    return dashboard(spark, sf)["available_ids"]


@query(
    "dashboard_alert_trend",
    f"""WITH {ALERTS} SELECT pet_id, date, CAST(CASE health_alert_level WHEN 'Đỏ (Nguy cơ cao)' THEN 3 WHEN 'Cam (Cảnh báo)' THEN 2
      WHEN 'Vàng (Theo dõi)' THEN 1 ELSE 0 END AS DOUBLE) AS rule_level, prediction AS model_level FROM levelled""",
)
def dashboard_alert_trend(spark, sf):
    """Rule level and prediction of every reading."""
    return dashboard(spark, sf)["alert_trend"]


@query(
    "dashboard_activity_trend",
    f"""WITH {ALERTS} SELECT pet_id, date, count(*) AS readings, {", ".join(
        f"round(avg({c}), 6) AS {c}_mean, round(avg({c}) - 1.96 * stddev_samp({c}) / sqrt(count(*)), 6) AS {c}_low,"
        f" round(avg({c}) + 1.96 * stddev_samp({c}) / sqrt(count(*)), 6) AS {c}_high"
        for c in ("food_amount", "sleep_hours", "weight_kg")
    )} FROM levelled GROUP BY pet_id, date""",
)
def dashboard_activity_trend(spark, sf):
    """Daily means with their bands."""
    trend = dashboard(spark, sf)["activity_trend"]
    return trend.withColumns({c: F.round(c, 6) for c in trend.columns if c.endswith(("_mean", "_low", "_high"))})


@query(
    "dashboard_alert_card",
    f"""WITH {ALERTS}, p AS (
      SELECT * FROM levelled QUALIFY row_number() OVER (PARTITION BY pet_id ORDER BY date DESC, health_alert_level DESC, prediction DESC) = 1
    ) SELECT pet_id, strftime(date, '%Y-%m-%d') AS latest_date, health_alert_level, printf('%.2f', prediction) AS ml_prediction,
      CASE WHEN pet_id IN (SELECT pet_id FROM alerts) THEN 'Không có ghi chú đặc biệt.' ELSE 'Không có ghi chú bất thường' END AS note_summary FROM p""",
)
def dashboard_alert_card(spark, sf):
    """Per entity its latest prediction and what its latest alert says."""
    return dashboard(spark, sf)["alert_card"]
