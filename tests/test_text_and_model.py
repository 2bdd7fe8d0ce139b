import math
import random
import re
from collections import Counter

import catalog
import pytest
from pyspark.ml.feature import HashingTF, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from entityhealth.operators import model, scoring, textfeatures


@pytest.fixture(scope="module")
def notes(spark):
    data = [(0, "Mèo và chó  rất vui"), (1, "chó ngủ"), (2, None), (3, "Mèo mèo MÈO")]
    return spark.createDataFrame(data, "id int, note_text string")


def test_tokens_and_stop_words(notes):
    words = textfeatures.remove_stop_words(textfeatures.tokens(notes)).orderBy("id").collect()
    assert [r.id for r in words] == [0, 1, 3]
    assert words[0].words == ["mèo", "và", "chó", "", "rất", "vui"]
    assert words[0].filtered_words == ["mèo", "chó", "", "vui"]


def test_words_agree_with_the_library_tokenizer(spark):
    texts = ["a b", " a  b ", "a\tb\n\nc\r\n", "", " ", "\n\t", "Á\u00a0B c", "x" * 50, "a\x0bb\x0cc"]
    df = spark.createDataFrame([(t,) for t in texts], "note_text string")
    theirs = StopWordsRemover(inputCol="words", outputCol="f", stopWords=["A", "c"], locale="en_US").transform(
        Tokenizer(inputCol="note_text", outputCol="words").transform(df)
    )
    mine = textfeatures.remove_stop_words(textfeatures.tokens(df), ["A", "c"])
    got = [(r.words, r.filtered_words) for r in mine.collect()]
    assert got == [(r.words, r.f) for r in theirs.collect()]


def test_document_frequencies(notes):
    got = {r.term: (r.doc_count, r.idf) for r in textfeatures.document_frequencies(notes).collect()}
    assert got["mèo"] == (2, pytest.approx(math.log(4 / 3)))
    assert got["ngủ"] == (1, pytest.approx(math.log(2)))
    assert "và" not in got


def test_hashed_weights_follow_the_formula(notes):
    out = textfeatures.tfidf(notes).select("id", "filtered_words", vector_to_array("text_features").alias("v"))
    got = {r.id: r for r in out.collect()}
    assert len(got[3].v) == 1000
    assert sum(got[3].v) == pytest.approx(3 * math.log(4 / 3))


def test_hashed_entries_equal_counting_by_hand(spark, notes):
    """Every bucket, count and weight, words of one bucket added up; also of the registered query."""

    def by_hand(texts, stop_words, buckets):
        place = HashingTF(numFeatures=buckets).indexOf
        counts = {i: Counter(place(w) for w in re.split(r"\s", t.lower()) if w not in stop_words) for i, t in texts.items() if t is not None}
        held = Counter(b for c in counts.values() for b in c)
        return {(i, b): (n, math.log((len(counts) + 1) / (held[b] + 1))) for i, c in counts.items() for b, n in c.items()}

    def check(df, want):
        got = {(r[0], r.bucket): (r["count"], r.weight) for r in df.collect()}
        assert set(got) == set(want)
        assert all(got[k] == (n, pytest.approx(n * idf)) for k, (n, idf) in want.items())

    texts = {r.id: r.note_text for r in notes.collect()}
    check(textfeatures.hashed_entries(notes, ["id"], buckets=3), by_hand(texts, textfeatures.STOP_WORDS, 3))
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = by_hand(docs, set(catalog.text.STOP_WORDS), 1000)
    check(catalog.QUERIES["tfidf_hashed"](spark, sf), want)


def test_registered_forests_predict_every_row_of_the_other_part(spark):
    sf = "/root/testdata/sf0.001"
    rows = catalog.models._scored_with_breed(spark, sf)
    _, test = model.hash_split(rows, ("order_id", "line"))
    labels = {r.label: r["count"] for r in model.with_label(test).groupBy("label").count().collect()}
    predicted = catalog.QUERIES["alert_predictions"](spark, sf)
    assert predicted.count() == sum(labels.values()) == predicted.select("order_id", "line").join(test.select("order_id", "line").distinct(), ["order_id", "line"]).count()
    hits = predicted.where("prediction = label").count()
    assert hits > max(labels.values()) and hits > 0.9 * predicted.count()
    matrix = catalog.QUERIES["confusion_counts"](spark, sf).collect()
    by_label = Counter()
    for r in matrix:
        by_label[r.label] += r.n
    assert by_label == labels and sum(r.n for r in matrix if r.label == r.prediction) > max(labels.values())


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(11)
    data = [
        (
            f"pet{i % 40:03d}",
            i,
            rnd.choice(["dog", "cat"]),
            rnd.choice(["b1", "b2", None]),
            round(rnd.uniform(150, 300)),
            round(rnd.uniform(10, 18), 1),
            round(rnd.uniform(2.5, 7), 1),
            rnd.randrange(11),
            rnd.choice([None, "nôn", "lo lắng", "vui"]),
        )
        for i in range(3000)
    ]
    schema = (
        "pet_id string, date int, species string, breed string, food_amount double, sleep_hours double, "
        "weight_kg double, meow_count int, note_text string"
    )
    rows = spark.createDataFrame([(*r[:4], float(r[4]), *r[5:]) for r in data], schema)
    return scoring.score(rows)


def test_split_does_not_depend_on_partitions(scored, rows):
    a, b = model.hash_split(scored.repartition(3), ["pet_id", "date"])
    c, d = model.hash_split(scored.repartition(11), ["pet_id", "date"])
    assert rows(a, "pet_id", "date") == rows(c, "pet_id", "date")
    assert a.count() + b.count() == 3000 and 0.75 < a.count() / 3000 < 0.85
    assert not set(rows(b, "pet_id", "date")) & set(rows(a, "pet_id", "date")) and d.count() == b.count()


def test_forest_learns_the_levels(scored):
    fitted, predictions = model.fit_predict(scored, trees=20)
    assert model.evaluate(predictions) > 0.85
    majority = predictions.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    _, raw = model.fit_predict(scored, spec=model.RAW, trees=20)
    assert fitted.forest.getNumTrees == 20
    assert model.evaluate(raw) > majority
    assert len(predictions.first().features) == 12 and len(model.SHORT.inputs) == 10
    assert sum(r.n for r in model.confusion_counts(predictions).collect()) == predictions.count()
    both = model.rule_vs_model(predictions).collect()
    assert len(both) == predictions.count() and {r.rule_level for r in both} <= {0.0, 1.0, 2.0, 3.0}


def test_a_forest_learns_from_every_training_row(spark, monkeypatch):
    """Before, from some 200,000 at most."""
    learnt = []

    class Stop(Exception):
        pass

    def kept(df, label):
        if label == "sample":
            learnt.append(df.count())
            raise Stop
        return df

    monkeypatch.setattr(model, "written", kept)
    rows = spark.range(300_000).selectExpr("id", "id % 7 AS v", "cast(id % 3 AS string) AS c", "'x' AS health_alert_level")
    with pytest.raises(Stop):
        model.fit_predict(rows, ["id"], model.FeatureSpec(("v",), (), ("c",)))
    assert learnt == [model.hash_split(rows, ["id"])[0].count()]


def test_predictions_say_whether_they_beat_the_majority(spark):
    rows = [(0.0, 0.0)] * 6 + [(1.0, 1.0)] * 3
    assert model.beats_majority(spark.createDataFrame(rows + [(0.0, 1.0)], "prediction double, label double"))
    assert not model.beats_majority(spark.createDataFrame([(0.0, r[1]) for r in rows], "prediction double, label double"))
    assert not model.beats_majority(spark.createDataFrame([], "prediction double, label double"))
    predicted = catalog.QUERIES["alert_predictions"](spark, "/root/testdata/sf0.001")
    assert {r.beats_majority for r in predicted.select("beats_majority", "prediction").collect()} == {True}


def test_same_seed_same_model(scored, rows):
    one, two = (model.fit_predict(scored, trees=5)[1] for _ in range(2))
    assert rows(one, "pet_id", "date", "prediction") == rows(two, "pet_id", "date", "prediction")


def test_any_number_of_categories(scored):
    wide = scored.withColumn("breed", F.concat(F.lit("b"), F.col("date").cast("string")))
    assert wide.select("breed").distinct().count() > 1500
    assert model.evaluate(model.fit_predict(wide, trees=5)[1]) > 0.5


def test_training_rows_are_bounded_and_features_are_those_of_the_table(scored, monkeypatch):
    sizes = []
    kept = model.written
    monkeypatch.setattr(model, "written", lambda df, label: [kept(df, label), sizes.append(label)][0])
    fitted, predictions = model.fit_predict(scored, trees=5, fit_rows=500)
    assert sizes == ["categories", "sample"]
    drawn = model.hash_split(scored, ["pet_id", "date"])[0].where(model._place(["pet_id", "date"], 43) < 2100).count()
    assert 350 < drawn < 700
    rows = predictions.select("features", *model.FULL.inputs).collect()
    assert all(list(r.features.toArray()) == [r[c] for c in model.FULL.inputs] for r in rows)
    # Categories that only the other rows have get the next free index.
    unseen = fitted.transform(scored.limit(3).withColumn("breed", F.lit("new"))).select("breed_index").distinct().collect()
    assert [r.breed_index for r in unseen] == [2.0]


def test_category_index_agrees_with_the_indexer(scored):
    mine = {r.breed: r.breed_index for r in model.category_index(scored, "breed").collect()}
    labels = StringIndexer(inputCol="breed", outputCol="i", handleInvalid="keep").fit(scored).labels
    assert mine == {v: i for i, v in enumerate(labels)}
    table = model.feature_table(scored, model.FULL)
    missing = table.where("breed IS NULL").select("breed_index").distinct().collect()
    assert [r.breed_index for r in missing] == [2.0]
    assert table.count() == 3000 and dict(table.dtypes)["is_food_anomaly"] == "double"
