import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityhealth.operators import aggregates, joins, resampling
from entityhealth.sources import bucketed

SCHEMA = "pet_id string, date date, v int"


def day(n):
    return dt.date(2025, 1, n)


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame([(f"p{i % 7}", day(i % 5 + 1), i) for i in range(80)] + [(None, day(1), 90), ("p1", None, 91)], SCHEMA)


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame([("p1", day(2), "a"), ("p1", day(2), "b"), ("p3", day(4), "c"), (None, day(1), "d")], "pet_id string, date date, note_text string")


def test_stored_buckets_are_joined_without_a_shuffle(spark, readings, notes, rows, plan, capsys, tmp_path):
    left = bucketed.write_bucketed(readings, f"{tmp_path}/l", 4)
    right = bucketed.write_bucketed(notes, f"{tmp_path}/r'q", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = joins.attach_notes(left, right, skewed=False)
        assert "Exchange" not in plan(stored, capsys) and "Exchange" in plan(joins.attach_notes(readings, notes, skewed=False), capsys)
        want = rows(joins.attach_notes(readings, notes, skewed=False), "pet_id", "date", "v", "note_text")
        assert rows(stored, "pet_id", "date", "v", "note_text") == want
        # As another session finds them.
        again = [bucketed.read_bucketed(spark, p, df.schema, 4) for p, df in ((f"{tmp_path}/l", readings), (f"{tmp_path}/r'q", notes))]
        joined = joins.attach_notes(*again, skewed=False)
        assert "Exchange" not in plan(joined, capsys) and rows(joined, "pet_id", "date", "v", "note_text") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def drawn(key, replicate):
    digits = hashlib.md5(f"{key}:{replicate // 8}".encode()).hexdigest()
    return sum(int(digits[4 * (replicate % 8) :][:4], 16) >= b for b in resampling.POISSON)


def test_band_equals_drawing_by_hand(spark, readings):
    df = readings.withColumn("v", F.when(F.col("v") % 9 != 0, F.col("v")))
    got = {(r.pet_id, r.date): r for r in resampling.daily_mean_bootstrap(df, "v", ["pet_id", "date", "v"], replicates=40).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault((r.pet_id, r.date), []).append(r)
    assert set(got) == set(groups)
    for at, members in groups.items():
        values = [(":".join(str(x) for x in (r.pet_id, r.date, r.v) if x is not None), r.v) for r in members]
        means = []
        for b in range(40):
            n = [(drawn(key, b), v) for key, v in values if v is not None]
            if sum(c for c, _ in n):
                means.append(sum(c * v for c, v in n) / sum(c for c, _ in n))
        known = [v for _, v in values if v is not None]
        assert got[at].readings == len(members)
        assert got[at].v_mean == (pytest.approx(np.mean(known)) if known else None)
        for name, level in (("v_low", 0.025), ("v_high", 0.975)):
            assert got[at][name] == (pytest.approx(np.quantile(means, level)) if means else None)


def test_a_day_of_any_size_has_the_same_band(spark, readings, rows, monkeypatch):
    """In slices, and dealt over tasks; keys and values may be NULL or repeat."""
    df = readings.withColumn("v", F.when(F.col("v") % 9 != 0, F.col("v"))).withColumn("key", F.when(F.col("v") % 5 != 0, F.col("v")))
    df = df.unionByName(df.where("v % 4 = 0"))
    names = ["pet_id", "date", "readings"]
    rounded = [F.round(f"v_{c}", 9) for c in ("mean", "low", "high")]
    want = rows(resampling.daily_mean_bootstrap(df, "v", ["key"]).select(*names, *rounded))
    monkeypatch.setattr(resampling, "SLICE", 2)
    assert rows(resampling.daily_mean_bootstrap(df.coalesce(1), "v", ["key"]).select(*names, *rounded)) == want
    assert rows(resampling.daily_mean_bootstrap(df, "v", ["key"], task_rows=2).select(*names, *rounded)) == want


def test_replicates_are_not_shuffled(spark, readings, plan, capsys):
    """Before, a reading was a row of the shuffle in each block of replicates, and a day one for each replicate."""
    text = plan(resampling.daily_mean_bootstrap(readings, "v", ["v"]), capsys)
    tree = text.split("(1)")[0]
    assert tree.count("Exchange") == 1 and "Generate" not in tree and "Aggregate" not in tree


def test_band_is_close_to_the_analytic_one(spark):
    rnd = np.random.default_rng(1)
    df = spark.createDataFrame([(i, "a", day(1), float(x)) for i, x in enumerate(rnd.normal(50, 10, 900))], "id int, pet_id string, date date, v double")
    r, plain = resampling.daily_mean_bootstrap(df, "v", ["id"], replicates=400).first(), aggregates.daily_mean(df, ["v"]).first()
    assert r.v_mean == pytest.approx(plain.v_mean)
    assert r.v_high - r.v_low == pytest.approx(plain.v_high - plain.v_low, rel=0.15)


def test_poisson_numbers():
    p, total, bounds = np.exp(-1), 0.0, []
    for k in range(7):
        total += p
        bounds.append(round(65536 * total))
        p /= k + 1
    assert tuple(bounds) == resampling.POISSON
