import datetime as dt
import random

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from entityhealth.operators import joins

D = dt.date


def sides(spark):
    """Keys 1 and 2 hot on the left, 2 and 3 on the right, 4 and 5 on one side only, some without a key."""
    rnd = random.Random(7)
    left = [1] * 300 + [2] * 60 + [4] * 5 + [None] * 200 + [rnd.randrange(10, 60) for _ in range(100)]
    right = [2] * 50 + [3] * 300 + [5] * 4 + [None] * 40 + [1] + [rnd.randrange(10, 60) for _ in range(60)]
    # Half of the left rows are copies of each other.
    l = spark.createDataFrame([(k, "d", i % 2 * i) for i, k in enumerate(left)], "k int, g string, a int")
    r = spark.createDataFrame([(k, "d", i) for i, k in enumerate(right)], "k int, g string, b int")
    return l.repartition(5), r.repartition(3)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("swap", [False, True])
@pytest.mark.parametrize("task_rows", [20, 45, 1, 10**9])
def test_skew_join_equals_the_plain_join(spark, rows, how, swap, task_rows):
    left, right = sides(spark)
    if swap:
        left, right = right, left
    got = joins.skew_join(left, right, ["k", "g"], how, task_rows)
    want = left.join(right, ["k", "g"], how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_skew_join_splits_hot_keys(spark):
    left, right = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        parts, absent = joins._hot_keys(left, ["k", "g"], 20)
        assert sorted(parts.values()) == [3, 15] and absent == 10
        joined = joins.skew_join(left, right, ["k", "g"], "left", 20)
        parts = joined.where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        plain = joins.skew_join(left, right, ["k", "g"], "left")
        assert plain.where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_hot_keys_are_all_split(spark):
    """Ninety keys of the same share and one just above the limit; each is cut by its own size."""
    keys = [k for k in range(90) for _ in range(110)] + [90] * 101 + [k for k in range(100, 300)] + [400] * 99
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, a int").repartition(4)
    parts, absent = joins._hot_keys(left, ["k"], 100)
    assert len(parts) == 91 and set(parts.values()) == {2} and absent == 1
    assert set(joins._hot_keys(left, ["k"], 20)[0].values()) == {6, 5}
    right = left.select("k", "a").withColumnRenamed("a", "b").where("k >= 89")
    got, want = joins.skew_join(left, right, ["k"], "left", 100), left.join(right, ["k"], "left")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_skew_join_with_vectors_and_maps(spark):
    left = spark.createDataFrame([(1, {"a": 1})] * 5 + [(2, None)], "k int, m map<string,int>")
    right = spark.createDataFrame([(1, Vectors.sparse(4, [1], [2.0]))] * 3 + [(3, None)], StructType(
        [StructField("k", IntegerType()), StructField("v", VectorUDT())]
    ))
    got = joins.skew_join(left, right, ["k"], "left", 2)
    assert got.count() == 16 and got.where("k = 2").first().v is None


def test_skew_join_wants_equal_key_types(spark):
    left = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        joins.skew_join(left, spark.createDataFrame([(1,)], "k bigint"), ["k"])


def test_profile_replaces_own_columns(spark, rows):
    fact = spark.createDataFrame([("a", "own", 1), ("b", "own", 2)], "pet_id string, species string, v int")
    profile = spark.createDataFrame([("a", "dog")], "pet_id string, species string")
    assert rows(joins.attach_profile(fact, profile, how="left", replace=["species"])) == [
        ("a", 1, "dog"),
        ("b", 2, None),
    ]
    assert rows(joins.attach_profile(fact.drop("species"), profile)) == [("a", 1, "dog")]


def test_notes_repeat_readings(spark, rows):
    day = D(2025, 1, 1)
    activity = spark.createDataFrame([("a", day, 1), ("b", day, 2)], "pet_id string, date date, v int")
    notes = spark.createDataFrame([("a", day, "x"), ("a", day, "y")], "pet_id string, date date, note_text string")
    want = [("a", day, 1, "x"), ("a", day, 1, "y"), ("b", day, 2, None)]
    assert rows(joins.attach_notes(activity, notes)) == want
    assert rows(joins.attach_notes(activity, notes, skewed=False)) == want


def test_device_days(spark, rows):
    day = D(2025, 1, 1)
    activity = spark.createDataFrame([("a", day), ("b", day)], "pet_id string, date date")
    daily = spark.createDataFrame(
        [("2025-01-01", "Miu", 35, "a"), (None, "Miu", 1, "b")],
        "log_date string, pet_name_from_log string, daily_food_dispensed_g int, pet_id string",
    )
    out = joins.attach_device(activity, daily)
    assert out.columns == ["pet_id", "date", "daily_food_dispensed_g"]
    assert rows(out) == [("a", day, 35), ("b", day, None)]


def test_missing_on_and_domain(spark, rows):
    days = [("a", D(2025, 1, 1)), ("a", D(2025, 1, 2)), ("b", D(2025, 1, 1)), ("c", None)]
    df = spark.createDataFrame(days, "pet_id string, date date")
    assert rows(joins.missing_on(df, F.lit(D(2025, 1, 2)))) == [("b",), ("c",)]
    counts = joins.count_by_domain(df, "pet_id", ["z", "a", "b"])
    assert [tuple(r) for r in counts.collect()] == [(0, "z", 0), (1, "a", 2), (2, "b", 1)]
