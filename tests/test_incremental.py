import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog import streams
from entityhealth.operators import aggregates, entities, parts, scoring, upkeep
from entityhealth.plans import incremental
from entityhealth.sources import published
from entityhealth.streaming import latest

SF = "/root/testdata/sf0.001"
D = dt.date
SCHEMA = "k string, date date, v double"


def day(n):
    return D(2025, 1, n)


# --- published tables -----------------------------------------------------------


def test_days_change_in_one_step(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    first = published.publish(spark.createDataFrame([("a", day(1), 1.0), ("b", day(2), 2.0), ("c", None, 3.0)], SCHEMA), path, marks={"x": "1"})
    assert set(first.folders) == {"2025-01-01", "2025-01-02", None}
    # The new rows come from the table itself; the rows without a day go.
    doubled = published.read(spark, path, days=["2025-01-02"]).withColumn("v", F.col("v") * 2)
    second = published.publish(doubled, path, replaced=[None], marks={"x": None, "y": "2"})
    assert rows(published.read(spark, path)) == [("a", day(1), 1.0), ("b", day(2), 4.0)]
    assert rows(published.read(spark, path, at=first)) == [("a", day(1), 1.0), ("b", day(2), 2.0), ("c", None, 3.0)]
    assert second == published.snapshot(spark, path) and second.marks == {"y": "2"}
    assert second.days_unlike(first.folders) == ["2025-01-02", None]
    assert rows(published.read(spark, path, days=[])) == []
    with pytest.raises(ValueError):
        published.publish(spark.createDataFrame([("a", day(1))], "k string, date date"), path)
    with pytest.raises(RuntimeError):
        published.publish(doubled, path, base=first)
    assert published.snapshot(spark, path) == second


def test_nothing_published(spark, tmp_path):
    assert published.snapshot(spark, f"{tmp_path}/none") == published.Snapshot()
    with pytest.raises(ValueError):
        published.read(spark, f"{tmp_path}/none")
    none = spark.createDataFrame([], SCHEMA)
    published.publish(none, f"{tmp_path}/t")
    assert published.read(spark, f"{tmp_path}/t").collect() == []


# --- the stream of last rows ------------------------------------------------------


def last_rows(spark, instalments):
    rows = instalments[0]
    for more in instalments[1:]:
        rows = rows.unionByName(more)
    once = streams._readings(rows).dropDuplicates(["event_id"])
    return upkeep.dedupe_keep_last(streams._score(once), ["entity_id", "date"], ["event_id"])


def run(spark, landed, out, progress):
    query = latest.keep_latest(streams.landed_stream(spark, landed), out, progress, ["entity_id", "date"], ["event_id"], prepare=streams._score)
    query.awaitTermination()
    return query


def test_stream_goes_on_where_it_stopped(spark, rows, tmp_path):
    landed, out, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "progress"))
    given = streams.instalments(spark, SF)
    counts = [r.count() for r in given]
    assert min(counts) > 0
    for some in ((0, 1), (2, 3), ()):
        for i in some:
            streams.land_instalment(given[i], landed)
        query = run(spark, landed, out, progress)
        assert latest.rows_read(query) == sum(counts[i] for i in some)
        if some:
            assert rows(published.read(spark, out), *streams.COLUMNS) == rows(last_rows(spark, given[: some[-1] + 1]), *streams.COLUMNS)


def test_batch_that_runs_again_changes_nothing(spark, rows, tmp_path):
    out = f"{tmp_path}/out"
    batch = spark.createDataFrame([("a", day(1), 1.0, 1), ("a", day(1), 2.0, 2), ("b", day(2), 3.0, 1)], SCHEMA + ", at int")
    older = spark.createDataFrame([("a", day(1), 9.0, 0), ("b", day(2), 4.0, 5)], SCHEMA + ", at int")
    for number, given in ((0, batch), (0, older), (1, older), (1, batch), (0, batch)):
        latest.merge_batch(given, out, ["k", "date"], ["at"], "date", "m", number)
    assert rows(published.read(spark, out), "k", "v") == [("a", 2.0), ("b", 4.0)]
    assert published.snapshot(spark, out).version == 2
    latest.merge_batch(older, out, ["k", "date"], ["at"], "date", "another stream", 0)
    assert published.snapshot(spark, out).marks == {"m": "1", "another stream": "0"}


def test_stream_that_fails_between_writing_and_publishing(spark, rows, tmp_path, monkeypatch):
    landed, out, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "progress"))
    given = streams.instalments(spark, SF)[:2]
    for part in given:
        streams.land_instalment(part, landed)

    def fails(rows, path, *more, publish=published.publish, calls=[], **marks):
        calls.append(1)
        if len(calls) == 2:
            rows.write.parquet(f"{path}/_days/change=lost")
            raise OSError("lost")
        return publish(rows, path, *more, **marks)

    with monkeypatch.context() as m:
        m.setattr(published, "publish", fails)
        with pytest.raises(Exception, match="lost"):
            run(spark, landed, out, progress)
    assert published.snapshot(spark, out).version == 1
    run(spark, landed, out, progress)
    assert rows(published.read(spark, out), *streams.COLUMNS) == rows(last_rows(spark, given), *streams.COLUMNS)


def test_repeated_and_too_late_rows_are_dropped(spark, rows, tmp_path):
    landed, out, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "progress"))
    schema = "k string, at timestamp, n int"

    def batch(*given):
        spark.createDataFrame([(k, dt.datetime(2025, 1, d), n) for k, d, n in given], schema).coalesce(1).write.mode("append").parquet(landed)

    batch(("a", 1, 1), ("b", 20, 1))
    batch(("a", 1, 1), ("a", 15, 2), ("b", 20, 1))  # two repeated, one late
    batch(("c", 21, 1))
    batch(("d", 2, 1), ("c", 22, 2))  # one beyond the watermark
    stream = latest.once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed), "at", "10 days", ["k", "at", "n"])
    seen = []
    stream.writeStream.foreachBatch(lambda df, _: seen.extend(rows(df, "k", "n"))).option("checkpointLocation", progress).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert sorted(seen) == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2)]


# --- aggregates by day ------------------------------------------------------------


def test_parts_add_up(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", day(i % 9 + 1), None if i % 5 == 0 else 1e6 + i / 7, float(i % 3)) for i in range(60)] + [("b", "y", day(1), None, 1.0), ("c", "y", None, 2.5, None)],
        "pet_id string, species string, date date, u double, w double",
    )
    moments = parts.moment_parts(df, ["u", "w"])
    assert moments.count() == 9 + 2
    got = parts.entity_stats_of_parts(moments, ["u", "w"]).collect()
    want = {r.pet_id: r for r in entities.entity_stats(df, ["u", "w"]).collect()}
    assert {r.pet_id for r in got} == set(want)
    for r in got:
        for c in ("avg_u", "stddev_u", "avg_w", "stddev_w"):
            assert (r[c] is None) == (want[r.pet_id][c] is None) and (r[c] is None or r[c] == pytest.approx(want[r.pet_id][c], rel=1e-9))
    trends = parts.trend_parts(df, ["species"], ["u", "w"])
    means = {"u": "avg_u", "w": "avg_w"}
    assert rows(parts.trend_of_parts(trends, ["species"], means)) == rows(aggregates.trend_by(df, ["species"], means))
    assert rows(parts.monthly_trend_of_parts(trends, "species", means)) == rows(aggregates.trend_by_month(df, "species", "date", means))


def test_only_changed_days_are_read(spark, rows, tmp_path):
    table, derived = f"{tmp_path}/t", f"{tmp_path}/sums"
    seen = []

    def build(df):
        seen.append(sorted(r.date for r in df.select("date").distinct().collect()))
        return df.groupBy("date").agg(F.sum("v").alias("total"))

    def refreshed():
        return incremental.refresh_by_day(spark, table, derived, build), rows(published.read(spark, derived), "date", "total")

    published.publish(spark.createDataFrame([("a", day(i), float(i)) for i in range(1, 6)], SCHEMA), table)
    assert refreshed()[1] == [(day(i), float(i)) for i in range(1, 6)]
    assert refreshed()[0] == [] and len(seen) == 1
    published.publish(spark.createDataFrame([("b", day(2), 7.0), ("b", day(9), 1.0)], SCHEMA), table, replaced=["2025-01-04"])
    changed, got = refreshed()
    assert sorted(changed) == ["2025-01-02", "2025-01-04", "2025-01-09"] and seen[-1] == [day(2), day(9)]
    assert got == [(day(1), 1.0), (day(2), 7.0), (day(3), 3.0), (day(5), 5.0), (day(9), 1.0)]


def test_second_run_reads_what_landed_since_and_equals_a_full_run(spark, rows, tmp_path):
    given = streams.instalments(spark, SF)
    whole, step = f"{tmp_path}/whole", f"{tmp_path}/step"
    for part in given:
        streams.land_instalment(part, f"{whole}-in")
    for part in given[:3]:
        streams.land_instalment(part, f"{step}-in")

    def refresh(name):
        return incremental.refresh_reports(streams.landed_stream(spark, f"{name}-in"), name, streams._score, streams.LAYOUT)

    refresh(whole)
    assert refresh(step)["rows_read"] == sum(p.count() for p in given[:3])
    streams.land_instalment(given[3], f"{step}-in")
    again = refresh(step)
    assert again["rows_read"] == given[3].count() and 0 < len(again["days"]) < 30 + 1
    assert refresh(step) == {"rows_read": 0, "days": []}
    full, stepped = (incremental.reports(spark, n, streams.LAYOUT, ["event_id"]) for n in (whole, step))
    for name in ("alerts", "trends", "monthly_trends"):
        assert rows(full[name]) == rows(stepped[name]) != []
    scored = published.read(spark, incremental.paths(step)["scored"])
    assert rows(stepped["alerts"], *streams.COLUMNS) == rows(scoring.alerts(scored), *streams.COLUMNS)
    want = {r.entity_id: r for r in entities.entity_stats(scored, ["value"], "entity_id").collect()}
    for r in stepped["entity_stats"].collect():
        assert r.avg_value == pytest.approx(want[r.entity_id].avg_value) and (r.stddev_value or 0) == pytest.approx(want[r.entity_id].stddev_value or 0)
