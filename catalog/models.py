"""Features, split, forest and comparison of rule and model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.registry import READINGS_L, SCORED_L, query, readings_l, scored_l, table
from entityhealth.operators import joins, model
from entityhealth.session import written

SPEC = model.FeatureSpec(
    ("quantity", "price", "discount"),
    ("is_quantity_anomaly", "is_price_anomaly", "is_discount_anomaly", "note_is_stressful", "note_is_illness_related"),
    ("category", "breed"),
)


def _scored_with_breed(spark, sf):
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("breed"))
    return joins.attach_profile(scored_l(spark, sf), brands, "part_id")


@query(
    "category_index",
    """SELECT c_mktsegment, n, row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS c_mktsegment_index
    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""",
)
def category_index(spark, sf):
    """Categories numbered by falling frequency."""
    return model.category_index(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "category_index_wide",
    """SELECT l_shipdate, n, row_number() OVER (ORDER BY n DESC, l_shipdate) - 1 AS l_shipdate_index
    FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def category_index_wide(spark, sf):
    """The same for thousands of values, over several range partitions."""
    days = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    return model.category_index(days, "l_shipdate")


@query(
    "feature_table",
    f"""WITH {SCORED_L}, rows AS (SELECT scored.*, p_brand AS breed FROM scored JOIN part ON part_id = p_partkey),
    ci AS (SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS i FROM rows GROUP BY category),
    bi AS (SELECT breed, row_number() OVER (ORDER BY count(*) DESC, breed) - 1 AS i FROM rows GROUP BY breed)
    SELECT order_id, line, date, quantity, price, discount,
      CAST(is_quantity_anomaly AS DOUBLE) AS is_quantity_anomaly, CAST(is_price_anomaly AS DOUBLE) AS is_price_anomaly,
      CAST(is_discount_anomaly AS DOUBLE) AS is_discount_anomaly, CAST(0 AS DOUBLE) AS note_is_stressful,
      CAST(0 AS DOUBLE) AS note_is_illness_related, CAST(ci.i AS DOUBLE) AS category_index,
      CAST(bi.i AS DOUBLE) AS breed_index,
      CAST(CASE health_alert_level WHEN 'Đỏ (Nguy cơ cao)' THEN 3 WHEN 'Cam (Cảnh báo)' THEN 2
        WHEN 'Vàng (Theo dõi)' THEN 1 ELSE 0 END AS DOUBLE) AS label
    FROM rows JOIN ci USING (category) JOIN bi USING (breed)""",
)
def feature_table(spark, sf):
    """The entries of the vectors that the forest sees, with the label."""
    vectors = model.assemble(model.feature_table(_scored_with_breed(spark, sf), SPEC), SPEC)
    entries = vector_to_array("features")
    return vectors.select(
        "order_id", "line", "date", *[entries[i].alias(c) for i, c in enumerate(SPEC.inputs)], "label"
    )


@query(
    "hash_split",
    f"""WITH {READINGS_L} SELECT order_id, line, date, CASE WHEN
      CAST('0x' || substr(md5('42:' || order_id || ':' || line), 1, 8) AS BIGINT) % 10000 < 8000
      THEN 'train' ELSE 'test' END AS part FROM readings""",
)
def hash_split(spark, sf):
    """Every reading in exactly one of two parts, by its key."""
    rows = readings_l(spark, sf).select("order_id", "line", "date")
    train, test = model.hash_split(rows, ("order_id", "line"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


RAW = model.FeatureSpec(SPEC.metrics, (), SPEC.categories)


def _fit_rows(spark, sf):
    """Scored readings with their brand, written once: counting, indexing, sampling and prediction all read them."""
    return written(_scored_with_breed(spark, sf), "scored")


@query("alert_predictions")
def alert_predictions(spark, sf):
    """What a forest trained on all of 80 % of the readings says about the others, and whether it beats always saying one level.

    A forest has no SQL; tests check its rows, labels and accuracy.
    """
    predictions = model.fit_predict(_fit_rows(spark, sf), ("order_id", "line"), SPEC)[1]
    shown = predictions.select("order_id", "line", "entity_id", "date", "health_alert_level", "prediction", "label")
    shown = written(shown, "predictions")
    return shown.withColumn("beats_majority", F.lit(model.beats_majority(shown)))


@query("confusion_counts")
def confusion_counts(spark, sf):
    """The confusion matrix of a forest that sees the measures only, not the flags the level is computed from."""
    return model.confusion_counts(model.fit_predict(_fit_rows(spark, sf), ("order_id", "line"), RAW, trees=20)[1])


@query(
    "rule_vs_model",
    f"""WITH {SCORED_L} SELECT entity_id, date,
      CAST(CASE WHEN category = 'R' AND risk_score = 0 THEN -1 WHEN health_alert_level = 'Đỏ (Nguy cơ cao)' THEN 3
        WHEN health_alert_level = 'Cam (Cảnh báo)' THEN 2 WHEN health_alert_level = 'Vàng (Theo dõi)' THEN 1 ELSE 0 END
      AS DOUBLE) AS rule_level, CAST(floor(abs(quantity_zscore)) AS DOUBLE) AS model_level
    FROM scored WHERE quantity < 49""",
)
def rule_vs_model(spark, sf):
    """Rule level and a predicted code side by side, per entity in time order.

    The codes here follow from a z-score, so that SQL can tell them; unknown
    levels and unreadable codes are mixed in.
    """
    scored = scored_l(spark, sf)
    code = F.floor(F.abs("quantity_zscore")).cast("string")
    predictions = scored.withColumns(
        {
            "health_alert_level": F.when(
                (F.col("category") != "R") | (F.col("risk_score") > 0), F.col("health_alert_level")
            ),
            "prediction": F.when(F.col("quantity") < 49, code).otherwise("prediction"),
        }
    )
    return model.rule_vs_model(predictions, "entity_id")
