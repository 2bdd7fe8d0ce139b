import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityhealth.operators import aggregates, entities, ranks

D = dt.date


def test_box_stats_against_numpy(spark):
    rnd = random.Random(3)
    # One value is a third of all rows; one group has a single value.
    data = [("a", 5.0)] * 2000 + [("a", rnd.expovariate(0.1)) for _ in range(4000)]
    data += [("b", float(rnd.randrange(50))) for _ in range(500)] + [("c", 1.5), ("d", None), (None, 2.0)]
    df = spark.createDataFrame(data, "g string, value double").repartition(6)
    got = {r.g: r for r in ranks.box_stats(df, ["g"]).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, r in got.items():
        x = np.array([v for k, v in data if k == g])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, q2, q3))
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert (r.n, r.outliers) == (len(x), len(x) - len(inside))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60), st.floats(0, 1))
def test_quantiles_property(spark, values, p):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, value double")
    got = ranks.quantiles(df, ["g"], "value", [p], ["q"]).first()
    assert got.q == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_of_large_groups_keep_few_values(spark, monkeypatch):
    """Ties, a long tail and a hot group; only values near the ranks are written."""
    rnd = np.random.default_rng(6)
    parts = {"even": np.arange(50_000.0), "ties": rnd.integers(0, 7, 20_000).astype(float), "tail": np.exp(rnd.normal(0, 4, 9_000)), "few": np.array([3.0, 1.0])}
    frame = pd.DataFrame({"g": np.concatenate([[g] * len(v) for g, v in parts.items()]), "value": np.concatenate(list(parts.values()))})
    df = spark.createDataFrame(frame.sample(frac=1, random_state=1)).repartition(6)
    written = {}
    kept = ranks.written
    monkeypatch.setattr(ranks, "written", lambda t, label: written.setdefault(label, kept(t, label)))
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = {r.g: r for r in ranks.quantiles(df, ["g"], "value", probs, list("abcde")).collect()}
    for g, values in parts.items():
        assert [got[g][c] for c in "abcde"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
        assert got[g].total == len(values)
    assert written["brackets"].count() < 0.1 * len(frame)


def test_ordered_index(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randrange(100)) for i in range(5000)]
    df = spark.createDataFrame(data, "i int, n int").repartition(7)
    got = ranks.ordered_index(df, [F.col("n").desc(), F.col("i")]).collect()
    want = {i: place for place, (i, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])))}
    assert {r.i: r["index"] for r in got} == want


@pytest.mark.parametrize(
    "values,mean",
    [
        ((0.0049996, 0.0050003), 0.0),
        ((1e12, 0.01, 0.02), 333333333333.34),
        ((0.0000001, 0.0099999), 0.01),
        ((-0.015,), -0.02),
        ((-0.01, 0.0), -0.01),
        ((0.005,), 0.01),
        ((float("nan"), 2.0, None), 2.0),
        ((None, float("nan")), None),
        ((1e30, 3e30), 2e30),
        ((float("inf"), 1.0), float("inf")),
        ((1e17, 1e17), 1e17),
    ],
)
def test_means_of_any_size(spark, values, mean):
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    assert aggregates.trend_by(df, ["k"], {"v": "m"}).first().m == mean


def test_trend_through_a_profile_equals_the_join(spark):
    rnd = random.Random(8)
    data = [(rnd.randrange(20), rnd.choice("xy"), rnd.choice((None, float("nan"), rnd.random(), rnd.random() * 1e9))) for _ in range(900)]
    df = spark.createDataFrame(data, "part int, category string, v double")
    brands = spark.createDataFrame([(i, f"b{i % 3}") for i in range(15)], "part int, brand string")
    got = aggregates.trend_by_profile(df, brands, "part", ["category", "brand"], {"v": "m"})
    want = aggregates.trend_by(df.join(brands, "part"), ["category", "brand"], {"v": "m"})
    assert got.columns == want.columns and got.collect() == want.collect()


def test_last_day_reports_read_that_day_only(spark, tmp_path, plan, capsys):
    days = [(i, D(2025, 1, 1 + i % 5), "x") for i in range(50)]
    spark.createDataFrame(days, "i int, date date, l string").write.partitionBy("date").parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = aggregates.latest_level_distribution(df, ["x"], "l")
    assert out.first().n == 10 and "PartitionFilters: [(date" in plan(out, capsys).replace("isnotnull(date#", "(date")
    times = spark.createDataFrame([(i, dt.datetime(2025, 1, 1 + i, 23 * (i % 2), 5)) for i in range(9)], "i int, ts timestamp_ntz")
    times.write.parquet(f"{tmp_path}/ts")
    late = aggregates.latest_date_rows(spark.read.parquet(f"{tmp_path}/ts"), "ts")
    assert [r.i for r in late.collect()] == [8] and "GreaterThanOrEqual(ts,2025-01-09" in plan(late, capsys)


def test_means_of_whole_numbers(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("g", 2)], "k string, v int")
    assert aggregates.trend_by(df, ["k"], {"v": "m"}).first().m == 1.67


def test_trends_are_exact_and_half_up(spark):
    data = [("dog", "b", D(2025, 1, 3), 0.01), ("dog", "b", D(2025, 1, 31), 0.02)] + [
        ("cat", "b", D(2025, 2, 1), v) for v in (0.1, 0.2, 0.3, 0.1)
    ]
    df = spark.createDataFrame(data, "species string, breed string, date date, v double")
    assert [tuple(r) for r in aggregates.trend_by(df, ["species", "breed"], {"v": "m"}).collect()] == [
        ("cat", "b", 0.18),
        ("dog", "b", 0.02),
    ]
    assert [tuple(r) for r in aggregates.trend_by_month(df, "species", "date", {"v": "m"}).collect()] == [
        ("cat", "2025-02", 0.18, 4),
        ("dog", "2025-01", 0.02, 2),
    ]


def test_statistics_against_pandas(spark):
    rnd = random.Random(1)
    data = [(f"p{i % 7}", D(2025, 1, 1 + i % 28), rnd.gauss(10, 3), rnd.gauss(5, 1)) for i in range(400)]
    df = spark.createDataFrame(data, "pet_id string, date date, a double, b double")
    pdf = pd.DataFrame(data, columns=["pet_id", "date", "a", "b"])
    d = {r.metric: r for r in aggregates.describe_metrics(df, ["a", "b"]).collect()}
    assert (d["a"].n, d["a"].mean, d["a"].stddev) == pytest.approx((400, pdf.a.mean(), pdf.a.std()))
    assert aggregates.correlations(df, [("a", "b")]).first().correlation == pytest.approx(pdf.a.corr(pdf.b))
    stats = {r.pet_id: r for r in entities.entity_stats(df, ["a"]).collect()}
    for k, g in pdf.groupby("pet_id"):
        assert (stats[k].avg_a, stats[k].stddev_a) == pytest.approx((g.a.mean(), g.a.std()))
    found = entities.self_baseline_anomalies(df, ["a", "b"], limit=1.5).collect()
    z = pdf.groupby("pet_id")[["a", "b"]].transform(lambda s: (s - s.mean()) / s.std()).abs() > 1.5
    assert len(found) == int(z.any(axis=1).sum())


def test_constant_and_single_series_have_no_anomaly(spark):
    data = [("a", D(2025, 1, i), 5.0) for i in range(1, 5)] + [("b", D(2025, 1, 1), 99.0), (None, D(2025, 1, 1), 3.0)]
    df = spark.createDataFrame(data, "pet_id string, date date, v double")
    assert entities.self_baseline_anomalies(df, ["v"]).count() == 0
    kept = {(r.pet_id, r.avg_v) for r in entities.with_entity_stats(df, ["v"]).collect()}
    assert kept == {("a", 5.0), ("b", 99.0), (None, 3.0)}


def test_daily_mean_band(spark):
    df = spark.createDataFrame(
        [("a", D(2025, 1, 1), 1.0), ("a", D(2025, 1, 1), 3.0), ("a", D(2025, 1, 2), 4.0)],
        "pet_id string, date date, v double",
    )
    first, second = aggregates.daily_mean(df, ["v"]).orderBy("date").collect()
    assert first.v_mean == 2.0 and first.v_high - first.v_mean == pytest.approx(1.96)
    assert (second.v_mean, second.v_low, second.readings) == (4.0, None, 1)


def test_weeks_of_two_years_do_not_mix(spark, rows):
    df = spark.createDataFrame(
        [("a", D(2024, 12, 30), 1.0), ("a", D(2025, 1, 1), 3.0), ("a", D(2024, 1, 1), 7.0)],
        "pet_id string, date date, v double",
    )
    assert rows(aggregates.weekly_summary(df, {"v": "m"})) == [("a", 2024, 1, 7.0), ("a", 2025, 1, 2.0)]


def test_latest_rows_and_last_day_counts(spark, rows):
    day, before = D(2025, 1, 2), D(2025, 1, 1)
    df = spark.createDataFrame(
        [("a", day, 1, True, "x"), ("a", day, 2, False, "y"), ("b", before, 9, True, "x")],
        "pet_id string, date date, v int, f boolean, l string",
    )
    assert rows(entities.latest_per_entity(df).select("pet_id", "v")) == [("a", 2), ("b", 9)]
    assert aggregates.latest_date_rows(df).count() == 2
    assert rows(aggregates.latest_flag_counts(df, {"f": "F", "absent": "A"})) == [("A", 0, 0), ("F", 1, 1)]
    levels = aggregates.latest_level_distribution(df, ["y", "x", "z"], "l").collect()
    assert [tuple(r) for r in levels] == [(0, "y", 1), (1, "x", 1), (2, "z", 0)]


def test_cards(spark):
    day, before = D(2025, 1, 2), D(2025, 1, 1)
    predictions = spark.createDataFrame(
        [("a", before, "L1", 1.0), ("a", day, "L2", None), ("b", day, "L3", 2.0)],
        "pet_id string, date date, health_alert_level string, prediction double",
    )
    alerts = spark.createDataFrame(
        [("a", before, 3, "old"), ("a", day, 2, None), ("c", day, 5, "note")],
        "pet_id string, date date, risk_score int, note_text string",
    )
    got = {r.pet_id: tuple(r)[1:] for r in entities.latest_alert_card(predictions, alerts).collect()}
    assert got == {
        "a": ("2025-01-02", "L2", "N/A", "Không có ghi chú đặc biệt."),
        "b": ("2025-01-02", "L3", "2.00", "Không có ghi chú bất thường"),
        "c": ("N/A", "N/A", "N/A", "note"),
    }
    ids = entities.available_ids(predictions.where("false"), alerts, predictions)
    assert [r.pet_id for r in ids.collect()] == ["a", "c"]


def test_column_profile(spark, rows):
    df = spark.createDataFrame([("a", None), (None, 2)], "k string, v int")
    assert rows(aggregates.profile_columns(df)) == [("k", "string", 1), ("v", "int", 1)]
