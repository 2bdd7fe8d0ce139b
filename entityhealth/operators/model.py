"""Learning the alert level: features, split, forest, comparison with the rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.functions.levels import level_code
from entityhealth.operators.aggregates import counts_by
from entityhealth.operators.ranks import ordered_index
from entityhealth.session import written


@dataclass(frozen=True)
class FeatureSpec:
    """Columns of the model: measures, yes/no flags, categories to index."""

    metrics: tuple[str, ...]
    flags: tuple[str, ...]
    categories: tuple[str, ...]

    @property
    def inputs(self) -> list[str]:
        return [*self.metrics, *self.flags, *[f"{c}_index" for c in self.categories]]


# The order of the 12 features, and the 10 of the shorter form.
METRICS = ("food_amount", "sleep_hours", "weight_kg", "meow_count")
FULL = FeatureSpec(
    METRICS,
    (
        "is_food_anomaly",
        "is_sleep_anomaly",
        "is_weight_anomaly",
        "is_meow_anomaly",
        "note_is_stressful",
        "note_is_illness_related",
    ),
    ("species", "breed"),
)
SHORT = FeatureSpec(
    METRICS,
    ("is_food_anomaly", "is_sleep_anomaly", "is_weight_anomaly", "note_is_illness_related"),
    ("species", "breed"),
)
# Without the flags the label does not follow from the inputs by arithmetic.
RAW = FeatureSpec(METRICS, (), ("species", "breed"))


def category_indexes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, value, n, index)`: values of all columns in one pass, numbered by falling count.

    Ties are in text order. An index counts from 0 within its column.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    values = texts.unpivot([], list(columns), "column", "value")
    counts = counts_by(values.where(F.col("value").isNotNull()), "column", "value")
    ranked = ordered_index(counts, [F.col("column"), F.col("n").desc(), F.col("value")], "_place")
    first = ranked.groupBy("column").agg(F.min("_place").alias("_first"))
    return ranked.join(F.broadcast(first), "column").select(
        "column", "value", "n", (F.col("_place") - F.col("_first")).alias("index")
    )


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Category, count and index of one column."""
    return category_indexes(df, [column]).select(
        F.col("value").alias(column), "n", F.col("index").alias(f"{column}_index")
    )


def with_category_indexes(df: DataFrame, columns: Sequence[str], indexes: DataFrame | None = None) -> DataFrame:
    """Every row with its categories' indexes as double; unseen and NULL get the next free one.

    `indexes` is what `category_indexes` made of other rows, of `df` itself if
    not given. It is written once and joined once per category; Spark picks the
    join by the size of what is written, so there may be any number of categories.
    """
    indexes = written(category_indexes(df, columns), "categories") if indexes is None else indexes
    free = {r["column"]: r["n"] for r in indexes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    for c in columns:
        name = f"{c}_index"
        table = indexes.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias(name))
        joined = df.join(table, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
        df = joined.withColumn(name, F.coalesce(F.col(name), F.lit(free.get(c, 0))).cast("double"))
    return df


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", level_code(F.col("health_alert_level"), 0.0))


def feature_table(df: DataFrame, spec: FeatureSpec = FULL, indexes: DataFrame | None = None) -> DataFrame:
    """The inputs of the model as doubles, next to the label. Training and prediction read the same columns."""
    indexed = with_category_indexes(df, spec.categories, indexes) if spec.categories else df
    known = with_label(indexed.fillna(0, subset=list(spec.metrics)))
    numbers = {c: F.col(c).cast("double") for c in (*spec.metrics, *spec.flags)}
    return known.withColumns(numbers)


def assemble(features: DataFrame, spec: FeatureSpec = FULL) -> DataFrame:
    """The inputs as one vector, in the order of the specification."""
    return VectorAssembler(inputCols=spec.inputs, outputCol="features").transform(features)


def _place(keys: Sequence[str], seed: int) -> Column:
    """A number below 10,000 that follows from the key alone."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000


def hash_split(
    df: DataFrame, keys: Sequence[str], share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the key.

    The same row always falls into the same part, whatever the plan or the
    number of partitions; rows of one key stay together.
    """
    bound = round(share * 10_000)
    return df.where(_place(keys, seed) < bound), df.where(_place(keys, seed) >= bound)


@dataclass(frozen=True)
class AlertModel:
    """A forest, and the category indexes that its inputs are made with."""

    spec: FeatureSpec
    indexes: DataFrame | None
    forest: RandomForestClassificationModel

    def transform(self, scored: DataFrame) -> DataFrame:
        return self.forest.transform(assemble(feature_table(scored, self.spec, self.indexes), self.spec))


def train_alert_model(
    train: DataFrame,
    spec: FeatureSpec = FULL,
    keys: Sequence[str] = ("pet_id", "date"),
    trees: int = 100,
    depth: int = 5,
    seed: int = 42,
    fit_rows: int | None = None,
) -> AlertModel:
    """Random forest over the assembled features of all rows.

    With `fit_rows`, about that many are drawn by a hash of their key, so the
    sample does not depend on the run. Categories are indexed over all training
    rows. The assembled rows are written once; the forest reads them from there,
    so scores and joins run once.
    """
    indexes = written(category_indexes(train, spec.categories), "categories") if spec.categories else None
    share = 10_000 if fit_rows is None else min(10_000, -(-fit_rows * 10_000 // max(1, train.count())))
    sample = train if share >= 10_000 else train.where(_place(keys, seed + 1) < share)
    rows = assemble(feature_table(sample, spec, indexes), spec).select("features", "label")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    # A copy has no training summary; that holds the session, which cannot go to tasks once something was observed in it.
    return AlertModel(spec, indexes, forest.fit(written(rows, "sample")).copy())


def fit_predict(
    scored: DataFrame,
    keys: Sequence[str] = ("pet_id", "date"),
    spec: FeatureSpec = FULL,
    trees: int = 100,
    seed: int = 42,
    fit_rows: int | None = None,
) -> tuple[AlertModel, DataFrame]:
    """Train on 80 % of the keys, predict the rest."""
    train, test = hash_split(scored, keys, 0.8, seed)
    model = train_alert_model(train, spec, keys, trees, seed=seed, fit_rows=fit_rows)
    return model, model.transform(test)


def beats_majority(predictions: DataFrame, labels: int = 4) -> bool:
    """Whether more predictions are right than if all rows got the most frequent label. No rows: no."""
    hits = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    shares = [F.avg((F.col("label") == code).cast("double")) for code in range(labels)]
    right = predictions.agg(hits, F.greatest(*shares)).first()
    return bool(right[0] and right[0] > right[1])


def evaluate(predictions: DataFrame, metric: str = "accuracy") -> float:
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName=metric
    ).evaluate(predictions)


def rule_vs_model(predictions: DataFrame, entity: str = "pet_id", day: str = "date") -> DataFrame:
    """Rule level and prediction as numbers, per entity in time order.

    An unknown level counts as -1; rows without a readable prediction are dropped.
    """
    both = predictions.select(
        entity,
        day,
        level_code(F.col("health_alert_level"), -1.0).alias("rule_level"),
        F.col("prediction").try_cast("double").alias("model_level"),
    )
    return both.where(F.col("model_level").isNotNull()).orderBy(entity, day, "rule_level", "model_level")


def confusion_counts(predictions: DataFrame) -> DataFrame:
    return counts_by(predictions, "label", "prediction").orderBy("label", "prediction")
