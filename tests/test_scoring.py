import datetime as dt

import pytest
from pyspark.sql import functions as F

from entityhealth import schemas
from entityhealth.functions import levels
from entityhealth.functions.text import keyword_flag
from entityhealth.operators import scoring
from entityhealth.rules import DEFAULT_RULES, GREEN, LEVELS, ORANGE, RED, YELLOW, Baseline, RuleSet, rule_table

# Species, food, sleep, weight, meow -> food, sleep, weight, meow flags, illness note, score, level.
GOLDEN = [
    ("dog", 152.0, 15.2, 5.0, 9, 0, 0, 0, 0, 0, 0, GREEN),
    ("dog", 193.0, 12.2, 2.7, 3, 0, 0, 1, 0, 0, 2, YELLOW),
    ("dog", 225.0, 13.9, 6.5, 6, 0, 0, 0, 0, 0, 0, GREEN),
    ("dog", 299.0, 12.5, 4.0, 2, 0, 0, 1, 0, 0, 2, YELLOW),
    ("dog", 166.0, 16.4, 3.9, 1, 0, 1, 1, 0, 0, 3, ORANGE),
    ("dog", 195.0, 16.6, 3.4, 5, 0, 1, 1, 0, 0, 3, ORANGE),
    ("dog", 289.0, 12.3, 5.8, 3, 0, 0, 0, 0, 0, 0, GREEN),
    ("dog", 219.0, 13.1, 3.2, 6, 0, 0, 1, 0, 0, 2, YELLOW),
    ("dog", 256.0, 14.4, 5.7, 10, 0, 0, 0, 0, 0, 0, GREEN),
    ("dog", 249.0, 15.0, 2.9, 0, 0, 0, 1, 0, 0, 2, YELLOW),
    ("cat", 248.0, 16.4, 5.2, 3, 1, 0, 0, 0, 0, 1, YELLOW),
    ("cat", 256.0, 14.3, 2.6, 9, 1, 0, 0, 0, 0, 1, YELLOW),
    ("cat", 260.0, 12.1, 3.2, 9, 1, 0, 0, 0, 0, 1, YELLOW),
    ("cat", 211.0, 12.7, 2.7, 4, 0, 0, 0, 0, 0, 0, GREEN),
    ("cat", 209.0, 12.3, 2.7, 10, 0, 0, 0, 0, 0, 0, GREEN),
    ("cat", 287.0, 12.6, 6.1, 7, 1, 0, 1, 0, 0, 3, ORANGE),
    ("cat", 262.0, 15.4, 6.0, 4, 1, 0, 0, 0, 1, 4, ORANGE),
    ("cat", 157.0, 14.0, 3.5, 4, 0, 0, 0, 0, 0, 0, GREEN),
    ("cat", 272.0, 16.2, 3.4, 8, 1, 0, 0, 0, 0, 1, YELLOW),
    ("cat", 217.0, 17.5, 2.6, 10, 0, 0, 0, 0, 0, 0, GREEN),
    ("dog", 251.0, 17.5, 3.1, 1, 0, 1, 1, 0, 0, 3, ORANGE),
    ("cat", 289.0, 14.4, 6.5, 9, 1, 0, 1, 0, 0, 3, ORANGE),
    ("dog", 253.0, 17.6, 4.6, 5, 0, 1, 1, 0, 0, 3, ORANGE),
    ("cat", 295.0, 16.5, 6.4, 0, 1, 0, 1, 0, 0, 3, ORANGE),
    ("dog", 252.0, 12.8, 4.4, 10, 0, 0, 1, 0, 0, 2, YELLOW),
    ("dog", 269.0, 12.5, 2.9, 4, 0, 0, 1, 0, 1, 5, RED),
]


def readings(spark, data):
    schema = "i int, species string, food_amount double, sleep_hours double, weight_kg double, meow_count int, note_text string"
    return spark.createDataFrame(data, schema)


def test_golden_rows(spark):
    data = [(i, *g[:5], "Có vẻ bị Ho Khan." if g[9] else None) for i, g in enumerate(GOLDEN)]
    scored = scoring.score(readings(spark, data)).orderBy("i").collect()
    for g, r in zip(GOLDEN, scored, strict=True):
        flags = (r.is_food_anomaly, r.is_sleep_anomaly, r.is_weight_anomaly, r.is_meow_anomaly, r.note_is_illness_related)
        assert tuple(map(int, flags)) == g[5:10], (g, r)
        assert (r.risk_score, r.health_alert_level) == g[10:], (g, r)
        assert r.note_is_stressful is False


def test_missing_readings_and_categories(spark):
    data = [
        (0, "dog", None, 12.0, 15.0, None, None),
        (1, "bird", 0.0, 0.0, 0.0, 0, None),
        (2, None, 0.0, 0.0, 0.0, 0, None),
        (3, "cat", 180.0, 15.0, 4.0, None, "LO LẮNG cả ngày"),
    ]
    zero = {r.i: r for r in scoring.score(readings(spark, data)).collect()}
    assert set(zero) == {0, 3}
    assert zero[0].food_zscore == -5.0 and zero[0].is_food_anomaly and zero[0].food_amount == 0
    assert zero[0].meow_zscore is None and zero[0].is_meow_anomaly is False
    assert zero[3].note_is_stressful and zero[3].risk_score == 2
    ignored = {r.i: r for r in scoring.score(readings(spark, data), missing="ignore").collect()}
    assert ignored[0].food_amount is None and ignored[0].risk_score == 0
    with pytest.raises(ValueError):
        scoring.score(readings(spark, data), missing="drop")


def test_score_is_the_weighted_sum_of_the_flags(spark):
    words = ["nôn", "gầm gừ", "rụng lông", "chán ăn", "vui vẻ"]
    grid = spark.range(2000).select(
        F.col("id").cast("int").alias("i"),
        F.when(F.col("id") % 2 == 0, "dog").otherwise("cat").alias("species"),
        (F.pmod(F.col("id") * 37, F.lit(400))).cast("double").alias("food_amount"),
        (F.pmod(F.col("id") * 13, F.lit(25))).cast("double").alias("sleep_hours"),
        (F.pmod(F.col("id") * 7, F.lit(30))).cast("double").alias("weight_kg"),
        F.pmod(F.col("id") * 3, F.lit(20)).cast("int").alias("meow_count"),
        F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") % 5 + 1).cast("int")).alias("note_text"),
    )
    points = {c.category: c.points for c in DEFAULT_RULES.categories}
    names = [(m.flag, m.name) for m in DEFAULT_RULES.metrics] + [(s.flag, s.name) for s in DEFAULT_RULES.signals]
    order = {GREEN: 0, YELLOW: 1, ORANGE: 2, RED: 3}
    by_score = {}
    for r in scoring.score(grid).collect():
        assert r.risk_score == sum(points[r.species][n] for f, n in names if r[f])
        by_score.setdefault(r.risk_score, set()).add(order[r.health_alert_level])
    assert all(len(v) == 1 for v in by_score.values())
    ranked = [by_score[s].pop() for s in sorted(by_score)]
    assert ranked == sorted(ranked) and ranked[-1] == 3


def test_notes_searched_before_or_after_the_join_agree(spark, rows):
    texts = ["Bé NÔN ra lông", "nấm da nặng", "run rẩy vì sợ sấm", "vui vẻ", None, "đau chân", "biếng ăn, lo lắng"]
    data = [(i, s, 200.0, 13.0, 5.0, 4, t) for i, (s, t) in enumerate((s, t) for s in ("dog", "cat") for t in texts)]
    direct = scoring.score(readings(spark, data))
    early = scoring.score(scoring.annotate_notes(readings(spark, data)))
    assert sorted(early.columns) == sorted(direct.columns)
    assert rows(early, *direct.columns) == rows(direct)
    got = {(r.species, r.note_text): (r.note_is_stressful, r.note_is_illness_related) for r in direct.collect()}
    assert got["dog", "Bé NÔN ra lông"] == (False, True)
    assert got["dog", "nấm da nặng"] == (False, False) and got["cat", "nấm da nặng"] == (False, True)
    assert got["cat", "run rẩy vì sợ sấm"] == (False, False) and got["dog", "run rẩy vì sợ sấm"] == (True, False)
    assert got["cat", None] == (False, False)


def test_keyword_flag_without_words_or_text(spark):
    df = spark.createDataFrame([("ĂN Ngon",), (None,)], "t string")
    out = df.select(keyword_flag(F.col("t"), ["ăn"]).alias("a"), keyword_flag(F.col("t"), []).alias("b")).collect()
    assert [tuple(r) for r in out] == [(True, False), (False, False)]


def test_scoring_is_one_projection(spark, plan, capsys, tmp_path):
    data = [(0, "dog", 1.0, 1.0, 1.0, 1, "x")]
    readings(spark, data).write.parquet(f"{tmp_path}/r")
    text = plan(scoring.score(spark.read.parquet(f"{tmp_path}/r")), capsys)
    assert text.count("Scan parquet") == 2  # tree line and details of one scan
    for word in ("Join", "Exchange", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text
    assert "In(species, [cat,dog])" in text


def test_alert_report_contract(spark):
    base = readings(spark, [(i, *g[:5], None) for i, g in enumerate(GOLDEN)]).select(
        "*",
        F.concat(F.lit("pet"), F.lpad(F.col("i").cast("string"), 3, "0")).alias("pet_id"),
        F.lit("n").alias("name"),
        F.lit("b").alias("breed"),
        F.date_add(F.lit(dt.date(2025, 7, 1)), (F.col("i") % 4).cast("int")).alias("date"),
    )
    report = scoring.alert_report(scoring.score(base), schemas.ALERT.fieldNames())
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in schemas.ALERT]
    got = [(-r.date.toordinal(), -r.risk_score, r.pet_id) for r in report.collect()]
    assert got == sorted(got) and all(s < 0 for _, s, _ in got)


def test_level_columns(spark):
    df = spark.createDataFrame([(x,) for x in (*LEVELS, "?", None)], "l string")
    out = df.select(
        levels.level_code(F.col("l")).alias("a"),
        levels.level_code(F.col("l"), -1).alias("b"),
        levels.level_class(F.col("l")).alias("c"),
    ).collect()
    assert [r.a for r in out] == [3, 2, 1, 0, 0, 0]
    assert [r.b for r in out] == [3, 2, 1, 0, -1, -1]
    assert [r.c for r in out] == ["text-red", "text-orange", "text-yellow", "text-green", None, None]
    bands = spark.createDataFrame([(x,) for x in (2.5, 1.5, 0.5, 0.4, None)], "p double")
    got = [r[0] for r in bands.select(levels.prediction_band(F.col("p"))).collect()]
    assert got == ["text-red", "text-orange", "text-yellow", "text-green", None]


def test_rule_sets_are_checked(spark):
    with pytest.raises(ValueError):
        Baseline(1, 0)
    with pytest.raises(ValueError):
        RuleSet((), (), ())
    table = rule_table(spark)
    assert table.count() == 12
    assert table.where("category = 'dog' AND rule = 'meow'").first().mean is None
    assert len(table.where("category = 'cat' AND rule = 'illness'").first().keywords) == 9
