"""Rule scoring, alerts and display columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import RULES_L, SCORED_E, SCORED_L, query, scored_e, scored_l, table
from entityhealth.functions import levels, text
from entityhealth.operators import aggregates, entities, joins, scoring
from entityhealth.rules import LEVELS, rule_table
from entityhealth.session import written

ALERT_COLUMNS = [
    "entity_id", "name", "category", "breed", "date", "risk_score", "health_alert_level", "value",
    "is_value_anomaly", "note_text", "note_is_stressful", "note_is_illness_related", "event_id", "doc_id",
]


def alert_rows(spark, sf):
    profile = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("breed")
    )
    return joins.attach_profile(scored_e(spark, sf), profile, "entity_id", "left")


@query(
    "rule_scores",
    f"""WITH {SCORED_L} SELECT order_id, line, entity_id, date, category, quantity, price, discount,
      quantity_zscore, price_zscore, discount_zscore, is_quantity_anomaly, is_price_anomaly, is_discount_anomaly,
      risk_score, health_alert_level FROM scored""",
)
def rule_scores(spark, sf):
    """Z-scores, flags, points and level of every reading in one projection."""
    return scored_l(spark, sf).drop("part_id", "note_is_stressful", "note_is_illness_related")


@query(
    "rule_scores_with_notes",
    f"""WITH {SCORED_E} SELECT event_id, entity_id, date, category, value, value_zscore, is_value_anomaly,
      note_is_stressful, note_is_illness_related, risk_score, health_alert_level FROM scored""",
)
def rule_scores_with_notes(spark, sf):
    return scored_e(spark, sf).drop("note_text", "doc_id")


@query(
    "rule_scores_missing",
    """SELECT l_orderkey AS order_id, l_linenumber AS line,
      (l_quantity - 25) / 10 AS quantity_zscore,
      (nullif(l_discount, 0.05) - 0.05) / 0.02 AS discount_zscore,
      CAST(CAST(abs((l_quantity - 25) / 10) > 2 AS INTEGER)
        + CAST(coalesce(abs((nullif(l_discount, 0.05) - 0.05) / 0.02) > 2, false) AS INTEGER)
        + 2 * CAST(abs((l_extendedprice - 40000) / 15000) > 2 AS INTEGER) AS INTEGER) AS risk_score
    FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT l_orderkey, l_linenumber, (l_quantity - 20) / 12, (nullif(l_discount, 0.05) - 0.04) / 0.03,
      CAST(2 * CAST(abs((l_quantity - 20) / 12) > 2 AS INTEGER)
        + 3 * CAST(coalesce(abs((nullif(l_discount, 0.05) - 0.04) / 0.03) > 2, false) AS INTEGER) AS INTEGER)
    FROM lineitem WHERE l_returnflag = 'R'""",
)
def rule_scores_missing(spark, sf):
    """A missing reading scores nothing when asked to be ignored."""
    readings = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.05)).alias("discount"),
    )
    scored = scoring.score(readings, RULES_L, category="category", missing="ignore")
    return scored.select("order_id", "line", "quantity_zscore", "discount_zscore", "risk_score")


@query(
    "rule_points_by_category",
    """WITH rules(category, rule, mean, std, points) AS (VALUES
        ('A', 'quantity', 25.0, 10.0, 1), ('A', 'price', 40000.0, 15000.0, 2), ('A', 'discount', 0.05, 0.02, 1),
        ('A', 'stress', NULL, NULL, 0), ('A', 'illness', NULL, NULL, 0),
        ('R', 'quantity', 20.0, 12.0, 2), ('R', 'price', NULL, NULL, 0), ('R', 'discount', 0.04, 0.03, 3),
        ('R', 'stress', NULL, NULL, 0), ('R', 'illness', NULL, NULL, 0))
    SELECT category, rule, CAST(mean AS DOUBLE) AS mean, CAST(std AS DOUBLE) AS std, CAST(points AS INTEGER) AS points, n AS readings
    FROM rules JOIN (SELECT l_returnflag AS category, count(*) AS n FROM lineitem GROUP BY 1) USING (category)""",
)
def rule_points_by_category(spark, sf):
    """The rule set as an inline typed table, next to the readings it applies to."""
    counts = aggregates.counts_by(
        table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("category")), "category", out="readings"
    )
    rules = rule_table(spark, RULES_L).drop("keywords")
    return counts.join(F.broadcast(rules), "category").select(*rules.columns, "readings")


@query(
    "keyword_flags",
    """SELECT doc_id, contains(lower(text), 'license') OR contains(lower(text), 'all rights') AS has_license,
      contains(lower(text), 'was ') AS has_past FROM documents""",
)
def keyword_flags(spark, sf):
    """Any-of substring tests on whole texts, in any case."""
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.keyword_flag(body, ["License", "ALL RIGHTS"]).alias("has_license"),
        text.keyword_flag(body, ["was "]).alias("has_past"),
    )


@query(
    "alert_report",
    f"""WITH {SCORED_E} SELECT s.entity_id, c_name AS name, category, c_mktsegment AS breed, date, risk_score,
      health_alert_level, value, is_value_anomaly, note_text, note_is_stressful, note_is_illness_related,
      event_id, doc_id
    FROM scored s LEFT JOIN customer ON s.entity_id = c_custkey WHERE risk_score > 0""",
)
def alert_report(spark, sf):
    return scoring.alert_report(alert_rows(spark, sf), ALERT_COLUMNS, "entity_id")


@query(
    "alert_top5",
    f"""WITH {SCORED_E} SELECT date, risk_score, entity_id, event_id, doc_id, health_alert_level FROM scored
    WHERE risk_score > 0 ORDER BY date DESC, risk_score DESC, entity_id, event_id, doc_id LIMIT 5""",
)
def alert_top5(spark, sf):
    """The five newest and most severe alerts."""
    columns = ["date", "risk_score", "entity_id", "event_id", "doc_id", "health_alert_level"]
    return scoring.alert_report(scored_e(spark, sf), columns, "entity_id", tie=["event_id", "doc_id"]).limit(5)


@query(
    "species_union",
    f"""WITH {SCORED_L} SELECT order_id, line, category, risk_score, health_alert_level FROM scored""",
)
def species_union(spark, sf):
    """Two separately scored categories as one bag."""
    columns = ["order_id", "line", "category", "risk_score", "health_alert_level"]
    scored = scored_l(spark, sf).select(*columns)
    return scoring.union_by_name(*[scored.where(F.col("category") == c) for c in ("A", "R")])


@query(
    "level_distribution",
    f"""WITH {SCORED_E}, alerts AS (SELECT * FROM scored WHERE risk_score > 0),
    latest AS (SELECT * FROM alerts WHERE date = (SELECT max(date) FROM alerts)),
    domain(position, health_alert_level) AS (VALUES (0, 'Đỏ (Nguy cơ cao)'), (1, 'Cam (Cảnh báo)'),
      (2, 'Vàng (Theo dõi)'), (3, 'Xanh (Bình thường)'))
    SELECT CAST(position AS INTEGER) AS position, d.health_alert_level, count(l.event_id) AS n,
      CASE position WHEN 0 THEN '#DC3545' WHEN 1 THEN '#FD7E14' WHEN 2 THEN '#FFC107' ELSE '#28A745' END AS colour
    FROM domain d LEFT JOIN latest l USING (health_alert_level) GROUP BY ALL""",
)
def level_distribution(spark, sf):
    """Alerts of the last day per level, zeros kept, in order of severity."""
    alerts = written(scoring.alerts(scored_e(spark, sf)).select("date", "health_alert_level"), "alerts")
    counts = aggregates.latest_level_distribution(alerts, LEVELS)
    return counts.withColumn("colour", levels.level_colour(F.col("health_alert_level")))


@query(
    "count_by_domain",
    f"""WITH {SCORED_L}, domain(position, health_alert_level) AS (VALUES (0, 'Đỏ (Nguy cơ cao)'), (1, 'Cam (Cảnh báo)'),
      (2, 'Vàng (Theo dõi)'), (3, 'Xanh (Bình thường)'), (4, 'unknown'))
    SELECT CAST(position AS INTEGER) AS position, d.health_alert_level, count(s.order_id) AS n
    FROM domain d LEFT JOIN scored s USING (health_alert_level) GROUP BY ALL""",
)
def count_by_domain(spark, sf):
    """Scored readings per value of a given list, zeros kept."""
    return joins.count_by_domain(scored_l(spark, sf), "health_alert_level", [*LEVELS, "unknown"])


@query(
    "flag_counts",
    f"""WITH {SCORED_E}, alerts AS (SELECT * FROM scored WHERE risk_score > 0),
    latest AS (SELECT * FROM alerts WHERE date = (SELECT max(date) FROM alerts))
    SELECT 'Stress' AS signal, CAST(count_if(note_is_stressful) AS BIGINT) AS noted,
      CAST(count_if(NOT note_is_stressful) AS BIGINT) AS not_noted FROM latest
    UNION ALL SELECT 'Bệnh tật', CAST(count_if(note_is_illness_related) AS BIGINT),
      CAST(count_if(NOT note_is_illness_related) AS BIGINT) FROM latest""",
)
def flag_counts(spark, sf):
    """Alerts of the last day with and without each note signal."""
    alerts = scoring.alerts(scored_e(spark, sf)).select("date", "note_is_stressful", "note_is_illness_related")
    alerts = written(alerts, "alerts")
    return aggregates.latest_flag_counts(
        alerts, {"note_is_stressful": "Stress", "note_is_illness_related": "Bệnh tật"}
    )


LEVEL_TEXT = """CASE event_type WHEN 'click' THEN 'Đỏ (Nguy cơ cao)' WHEN 'view' THEN 'Cam (Cảnh báo)'
  WHEN 'purchase' THEN 'Vàng (Theo dõi)' WHEN 'error' THEN 'Xanh (Bình thường)' ELSE event_type END"""


def _level_texts(spark, sf):
    events = table(spark, sf, "events")
    names = dict(zip(("click", "view", "purchase", "error"), LEVELS))
    return events.select("event_id", "event_type", F.col("event_type").alias("level")).replace(names, subset=["level"])


@query(
    "level_code",
    """SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END
      AS DOUBLE) AS label, CAST(CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 WHEN 'purchase' THEN 1
      WHEN 'error' THEN 0 ELSE -1 END AS DOUBLE) AS shown FROM events""",
)
def level_code(spark, sf):
    level = F.col("level")
    return _level_texts(spark, sf).select(
        "event_id", levels.level_code(level).alias("label"), levels.level_code(level, -1.0).alias("shown")
    )


@query(
    "level_class",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'text-red' WHEN 'view' THEN 'text-orange'
      WHEN 'purchase' THEN 'text-yellow' WHEN 'error' THEN 'text-green' END AS css_class,
      CASE event_type WHEN 'click' THEN '#DC3545' WHEN 'view' THEN '#FD7E14' WHEN 'purchase' THEN '#FFC107'
      WHEN 'error' THEN '#28A745' END AS colour FROM events""",
)
def level_class(spark, sf):
    level = F.col("level")
    return _level_texts(spark, sf).select(
        "event_id", levels.level_class(level).alias("css_class"), levels.level_colour(level).alias("colour")
    )


@query(
    "prediction_band",
    """SELECT event_id, CASE WHEN p >= 2.5 THEN 'text-red' WHEN p >= 1.5 THEN 'text-orange'
      WHEN p >= 0.5 THEN 'text-yellow' WHEN p IS NOT NULL THEN 'text-green' END AS band,
      CASE WHEN p IS NULL THEN 'N/A' ELSE 'ok' END AS shown
    FROM (SELECT event_id, CASE WHEN event_type <> 'signup' THEN value / 50 END AS p FROM events)""",
)
def prediction_band(spark, sf):
    """Display class of a predicted code; a missing one stays without and is shown as N/A."""
    p = F.when(F.col("event_type") != "signup", F.col("value") / 50)
    events = table(spark, sf, "events").select("event_id", p.alias("p"))
    return events.select(
        "event_id",
        levels.prediction_band(F.col("p")).alias("band"),
        levels.or_na(F.when(F.col("p").isNotNull(), F.lit("ok"))).alias("shown"),
    )


@query(
    "latest_alert_card",
    f"""WITH {SCORED_E}, predictions AS (
      SELECT entity_id, date, health_alert_level, least(3.0, floor(value / 50)) AS prediction FROM scored
    ), p AS (
      SELECT *, row_number() OVER (PARTITION BY entity_id
        ORDER BY date DESC, health_alert_level DESC, prediction DESC) AS rn FROM predictions
    ), a AS (
      SELECT *, row_number() OVER (PARTITION BY entity_id
        ORDER BY date DESC, risk_score DESC, note_text DESC NULLS LAST) AS rn FROM scored WHERE risk_score > 0
    ), lastp AS (SELECT * FROM p WHERE rn = 1), lasta AS (SELECT * FROM a WHERE rn = 1)
    SELECT coalesce(lastp.entity_id, lasta.entity_id) AS entity_id,
      coalesce(strftime(lastp.date, '%Y-%m-%d'), 'N/A') AS latest_date,
      coalesce(lastp.health_alert_level, 'N/A') AS health_alert_level,
      coalesce(printf('%.2f', prediction), 'N/A') AS ml_prediction,
      CASE WHEN lasta.entity_id IS NULL THEN 'Không có ghi chú bất thường'
           ELSE coalesce(note_text, 'Không có ghi chú đặc biệt.') END AS note_summary
    FROM lastp FULL JOIN lasta ON lastp.entity_id = lasta.entity_id""",
)
def latest_alert_card(spark, sf):
    """Per entity: its latest prediction and the note of its latest alert."""
    scored = scored_e(spark, sf)
    predictions = scored.withColumn("prediction", F.least(F.lit(3.0), F.floor(F.col("value") / 50)))
    return entities.latest_alert_card(predictions, scoring.alerts(scored), "entity_id")


@query(
    "latest_activity_card",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderpriority DESC NULLS LAST) AS rn
      FROM (SELECT o_custkey, o_orderdate, o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders))
    SELECT o_custkey AS entity_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
      CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(o_orderpriority, 'N/A') AS o_orderpriority FROM r WHERE rn = 1""",
)
def latest_activity_card(spark, sf):
    """Per entity: the latest readings as text, N/A where missing."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        F.to_date("o_orderdate").alias("date"),
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return entities.latest_activity_card(orders, ["o_orderkey", "o_orderpriority"], "entity_id")
