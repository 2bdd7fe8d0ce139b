import datetime as dt

import pytest
from pyspark.sql import functions as F

from entityhealth.operators import upkeep
from entityhealth.plans import jobs
from entityhealth.sources import published, sinks

D = dt.date
TODAY = D(2025, 1, 3)
SCHEMA = "pet_id string, date date, v double, name string"


def table(spark):
    return spark.createDataFrame(
        [("a", D(2025, 1, 1), 1.0, "A1"), ("a", D(2025, 1, 2), 2.0, "A2"), ("b", TODAY, 3.0, "B"), ("b", TODAY, 3.0, "B")],
        SCHEMA,
    )


def test_carry_forward(spark, rows):
    assert rows(upkeep.carry_forward(table(spark), TODAY, ["name"])) == [("a", TODAY, None, "A2")]


def test_upsert_twice_is_once(spark, rows):
    incoming = spark.createDataFrame([("b", TODAY, 9.0, "B"), ("c", TODAY, 5.0, "C")], SCHEMA)
    once = upkeep.daily_upsert(table(spark), incoming, TODAY, ["name"])
    assert [tuple(r) for r in once.collect()] == [
        ("a", D(2025, 1, 1), 1.0, "A1"),
        ("a", D(2025, 1, 2), 2.0, "A2"),
        ("a", TODAY, None, "A2"),
        ("b", TODAY, 9.0, "B"),
        ("c", TODAY, 5.0, "C"),
    ]
    assert rows(upkeep.daily_upsert(once, incoming, TODAY, ["name"])) == rows(once)


def test_keep_last_goes_by_arrival(spark, rows, plan, capsys):
    df = spark.createDataFrame([("a", i, i % 3) for i in range(30)], "k string, at int, v int")
    kept = upkeep.dedupe_keep_last(df, ["k"], ["at"])
    assert rows(kept) == [("a", 29, 2)] == rows(upkeep.dedupe_keep_last(kept, ["k"], ["at"]))
    # A hot key is cut to one row per task before the shuffle.
    text = plan(kept, capsys)
    assert "WindowGroupLimit" in text.split("Exchange")[1]


def test_ids(spark):
    used = spark.createDataFrame([(f"pet{i:03d}",) for i in (0, 1, 3, 4, 7)] + [(None,)], "pet_id string")

    def got(quota, target):
        return [r.pet_id for r in upkeep.allocate_ids(used, quota, target).orderBy("number").collect()]

    assert got(2, 50) == ["pet002", "pet005"]
    assert got(10, 8) == ["pet002", "pet005", "pet006"]
    assert got(2, 5) == got(2, 3) == []
    wide = spark.range(1000).select(F.format_string("pet%03d", "id").alias("pet_id"))
    assert [r.pet_id for r in upkeep.allocate_ids(wide, 1, 2000).collect()] == ["pet1000"]


def test_refresh_rewrites_only_changed_days(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    sinks.land(table(spark), path)
    old = {f.name for d in ("01", "02") for f in (tmp_path / "t" / f"date=2025-01-{d}").glob("*.parquet")}
    incoming = spark.createDataFrame([("b", TODAY, 9.0, "B"), ("c", TODAY, 5.0, "C")], SCHEMA)
    want = rows(upkeep.daily_upsert(table(spark), incoming, TODAY, ["name"]))
    for _ in range(2):
        jobs.daily_refresh(spark, path, incoming, TODAY, ["name"])
        assert rows(published.read(spark, path), "pet_id", "date", "v", "name") == want
    assert {f.name for d in ("01", "02") for f in (tmp_path / "t" / f"date=2025-01-{d}").glob("*.parquet")} == old


def test_refresh_keeps_rows_without_a_day_and_columns_it_does_not_get(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = [("a", None, 1.0, "A", 7), ("b", None, 2.0, "B", 8), ("a", D(2025, 1, 1), 3.0, "A", 9), ("c", TODAY, 4.0, "C", 10)]
    sinks.land(spark.createDataFrame(old, SCHEMA + ", extra int"), path)
    incoming = spark.createDataFrame([("b", None, 9.0), ("d", TODAY, 5.0)], "pet_id string, date date, v double")
    jobs.daily_refresh(spark, path, incoming, TODAY, ["name"])
    got = {(r.pet_id, r.date): (r.v, r.name, r.extra) for r in published.read(spark, path).collect()}
    assert got == {
        ("a", None): (1.0, "A", 7),
        ("b", None): (9.0, None, None),
        ("a", D(2025, 1, 1)): (3.0, "A", 9),
        ("a", TODAY): (None, "A", None),
        ("b", TODAY): (None, "B", None),
        ("c", TODAY): (4.0, "C", 10),
        ("d", TODAY): (5.0, None, None),
    }
    with pytest.raises(ValueError):
        jobs.daily_refresh(spark, path, incoming.withColumn("other", F.lit(1)), TODAY, ["name"])


def test_refresh_that_fails_changes_nothing(spark, rows, tmp_path, monkeypatch):
    """Changed days are written, then the run dies before they are published; the next run does the whole refresh."""
    path = f"{tmp_path}/t"
    sinks.land(table(spark), path)
    incoming = spark.createDataFrame([("b", TODAY, 9.0, "B"), ("c", D(2025, 1, 1), 5.0, "C")], SCHEMA)
    before = rows(published.read(spark, path))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(published, "_log", lambda spark, path, log=published._log, calls=[]: log(spark, path) if not calls.append(1) and len(calls) == 1 else dies())
        with pytest.raises(OSError):
            jobs.daily_refresh(spark, path, incoming, TODAY, ["name"])
    assert list((tmp_path / "t" / "_days").iterdir()) and rows(published.read(spark, path)) == before
    jobs.daily_refresh(spark, path, incoming, TODAY, ["name"])
    want = upkeep.daily_upsert(spark.createDataFrame(table(spark).collect(), SCHEMA), incoming, TODAY, ["name"])
    assert rows(published.read(spark, path), "pet_id", "date", "v", "name") == rows(want)


def test_append_fills_missing_columns(spark):
    new = spark.createDataFrame([("z", TODAY)], "pet_id string, date date")
    out = upkeep.append(table(spark), new)
    assert out.columns == table(spark).columns and out.where("pet_id = 'z'").first().v is None
