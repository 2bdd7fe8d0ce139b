import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from entityhealth.operators import cleanse, sketches
from entityhealth.plans import incremental
from entityhealth.sources import clustered, published

DAY = dt.date(2025, 1, 1)
SCHEMA = "entity_id bigint, date date, value double"


def rank_error(values, got, prob):
    """How far the ranks of a value are from the wanted one, as a share of all."""
    low, high = sum(v < got for v in values) / len(values), sum(v <= got for v in values) / len(values)
    return max(0.0, low - prob, prob - high)


@pytest.fixture(scope="module")
def readings(spark):
    rnd = random.Random(8)
    rows = [(i * 7919 % 500, DAY + dt.timedelta(days=i % 20), rnd.lognormvariate(0, 2)) for i in range(60_000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def test_merged_sketches_keep_the_rank_error(readings):
    df = readings.withColumn("kind", F.when(F.col("entity_id") < 350, "many").when(F.col("entity_id") < 351, "few"))
    parts = sketches.quantile_parts(df, ["kind"], "value")
    probs, names = (0.01, 0.25, 0.5, 0.75, 0.99), ("p1", "q1", "median", "q3", "p99")
    for days in (20, 7, 1):
        some = F.col("date") < F.lit(DAY + dt.timedelta(days=days))
        out = {r.kind: r for r in sketches.quantiles_of_parts(parts.where(some), ["kind"], probs, names).collect()}
        held = {}
        for r in df.where(some).collect():
            held.setdefault(r.kind, []).append(r.value)
        assert out.keys() == held.keys()
        for kind, values in held.items():
            got = out[kind]
            assert (got.n, got.least, got.most) == (len(values), min(values), max(values))
            for p, n in zip(probs, names):
                assert got[n] in values and rank_error(values, got[n], p) < sketches.RANK_ERROR


def test_sketches_of_odd_values(spark):
    nan = float("nan")
    data = [("a", DAY, 1.0), ("a", DAY, None), ("a", DAY, nan), ("a", None, 3.0), ("b", DAY, None), (None, DAY, 5.0), (None, DAY, 5.0)]
    df = spark.createDataFrame(data, "k string, date date, value double")
    parts = sketches.quantile_parts(df, ["k"], "value")
    assert sorted((str(r.k), str(r.date), r.n) for r in parts.collect()) == [("None", str(DAY), 2), ("a", str(DAY), 1), ("a", "None", 1)]
    out = sketches.quantiles_of_parts(parts, ["k"], [0.0, 1.0], ["low", "high"]).collect()
    assert sorted((str(r.k), r.n, r.low, r.high) for r in out) == [("None", 2, 5.0, 5.0), ("a", 2, 1.0, 3.0)]
    assert sketches.quantiles_of_parts(parts.limit(0), ["k"], [0.5], ["m"]).collect() == []


def test_sketches_follow_the_days_that_change(spark, readings, tmp_path):
    table, derived = f"{tmp_path}/t", f"{tmp_path}/d"
    build = lambda rows: sketches.quantile_parts(rows, [], "value")
    published.publish(readings, table)
    assert len(incremental.refresh_by_day(spark, table, derived, build)) == 20
    changed = readings.where(F.col("date") == F.lit(DAY)).withColumn("value", F.col("value") + 1e6)
    published.publish(changed, table)
    assert incremental.refresh_by_day(spark, table, derived, build) == [str(DAY)]
    out = sketches.quantiles_of_parts(published.read(spark, derived), [], [0.5, 0.96], ["median", "p96"]).first()
    values = [r.value for r in published.read(spark, table).collect()]
    assert out.n == len(values) and out.most == max(values) > 1e6
    assert rank_error(values, out.median, 0.5) < sketches.RANK_ERROR and out.p96 > 1e6


def read_rows(df):
    """The result, and how many rows its only scan has given."""
    result = df.collect()
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    return result, metrics.apply("numOutputRows").value()


def test_a_series_reads_the_row_groups_that_can_hold_it(spark, readings, rows, tmp_path):
    table = clustered.write_clustered(readings, f"{tmp_path}/c", ["entity_id", "date"], row_group_bytes=4096, files=4)
    assert rows(table) == rows(readings)
    of_one = table.where("entity_id = 123")
    result, read = read_rows(of_one)
    assert sorted(result) == sorted(readings.where("entity_id = 123").collect()) and len(result) == 120
    assert read < 2_000
    assert [r.date for r in cleanse.entity_slice(table, "entity_id", 123).collect()] == sorted(r.date for r in result)


def test_a_bloom_filter_rules_out_what_statistics_do_not(spark, tmp_path):
    df = spark.range(40_000).select((F.col("id") * 1_000_003 % 999_983 * 2).alias("entity_id"), (F.col("id") % 10).alias("k"))
    odd = F.col("entity_id") == 12_345
    plain = clustered.write_clustered(df, f"{tmp_path}/p", ["k"], lookups=[], files=2)
    found = clustered.write_clustered(df, f"{tmp_path}/b", ["k"], lookups=["entity_id"], files=2)
    assert read_rows(plain.where(odd))[1] > 0 and read_rows(found.where(odd)) == ([], 0)


def test_clustered_odd_tables(spark, rows, tmp_path):
    df = spark.createDataFrame([(None, DAY, 1.0), (1, None, 2.0), (1, None, 2.0)], SCHEMA)
    assert rows(clustered.write_clustered(df, f"{tmp_path}/n", ["entity_id", "date"])) == rows(df)
    none = clustered.write_clustered(df.limit(0), f"{tmp_path}/e", ["entity_id", "date"])
    assert none.collect() == [] and none.schema == df.schema
    assert clustered.last_day_rows(spark, f"{tmp_path}/e").collect() == []


def test_the_last_day_comes_from_footers(spark, readings, rows, plan, capsys, tmp_path):
    path = f"{tmp_path}/c"
    clustered.write_clustered(readings, path, ["date"], files=4)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with clustered.footer_answers(spark):
        asked = plan(spark.read.parquet(path).agg(F.max("date")), capsys)
    assert "PushedAggregation: [MAX(date)]" in asked
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    last = DAY + dt.timedelta(days=19)
    assert rows(clustered.last_day_rows(spark, path)) == rows(readings.where(F.col("date") == F.lit(last)))
