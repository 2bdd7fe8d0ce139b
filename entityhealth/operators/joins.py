"""Joins of readings with profiles, notes, device days and statistics.

No join here carries a broadcast hint for data that grows. Spark broadcasts a
side when its measured size is under `spark.sql.autoBroadcastJoinThreshold` and
shuffles otherwise; adaptive execution splits a hot probe key. Where both sides
may repeat a key (`attach_notes`), `skew_join` splits hot keys on both sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot with more rows than one task should hold; it is split into parts of this size.
TASK_ROWS = 1_000_000
# Keys that the sketch reports and counters it keeps. A key with over 1/TRACKED of the rows is never missed.
REPORTED = 10_000
TRACKED = 200_000


def attach_profile(
    fact: DataFrame,
    profile: DataFrame,
    on: str = "pet_id",
    how: str = "inner",
    replace: Iterable[str] = (),
) -> DataFrame:
    """Profile columns next to the readings.

    Columns in `replace` are taken from the profile, also where it has none.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    return fact.drop(*replace).join(profile, on, how)


def _hot_keys(df: DataFrame, on: Sequence[str], task_rows: int) -> tuple[dict[int, int], int]:
    """Hashes of the keys with more than `task_rows` rows and their parts, and the parts of rows without a key.

    One pass over the key columns with a sketch of bounded size; the driver gets
    a single row with at most REPORTED items. An estimate is enough: splitting a
    key that is not hot, or into other parts, changes no result.
    """
    absent = F.lit(False)
    for c in on:
        absent = absent | F.col(c).isNull()
    keys = df.select(F.when(~absent, F.xxhash64(*on)).alias("k"))
    row = keys.agg(
        F.count("*").alias("n"),
        F.count("k").alias("present"),
        F.expr(f"approx_top_k(k, {REPORTED}, {TRACKED})").alias("top"),
    ).first()
    found = {t["item"]: t["count"] for t in row["top"] or [] if t["item"] is not None}
    parts = {k: -(-n // task_rows) for k, n in found.items() if n > task_rows}
    return parts, max(1, -(-(row["n"] - row["present"]) // task_rows))


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Equi-join that stays balanced when keys hold many rows of either side.

    Without hot keys it is the plain join. Otherwise the rows of a hot key are
    spread over parts of about `task_rows` on the side where it is hot and the
    other side repeats its rows of that key once per part; the table of hot keys
    has 2 * REPORTED rows at most. A left row repeated for a key hot on the
    right keeps its matches from every part; parts without a match are dropped,
    and as the key does occur on the right, some part has one. Left rows without
    a key match nothing and are spread as well.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    on = list(on)
    for c in on:
        if left.schema[c].dataType != right.schema[c].dataType:
            raise ValueError(f"key {c} has two types: cast one side, equal keys must hash alike")
    hot_left, absent_parts = _hot_keys(left, on, task_rows)
    hot_right, _ = _hot_keys(right, on, task_rows)
    if not hot_left and not hot_right and (absent_parts == 1 or how == "inner"):
        return left.join(right, on, how)
    hot = [(k, hot_left.get(k, 1), hot_right.get(k, 1)) for k in {**hot_left, **hot_right}]
    table = F.broadcast(left.sparkSession.createDataFrame(hot, "_key bigint, _left int, _right int"))

    def spread(df: DataFrame, own: str, other: str, own_part: str, other_part: str, absent: int) -> DataFrame:
        # Copies of a row lie in different input partitions; maps cannot be hashed.
        hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
        no_key = F.coalesce(*[F.when(F.col(c).isNull(), True) for c in on], F.lit(False))
        row = F.xxhash64(*hashed, F.spark_partition_id())
        marked = df.withColumns({"_row": row, "_key": F.when(~no_key, F.xxhash64(*on)), "_absent": no_key})
        parts = F.when(F.col("_absent"), absent).otherwise(F.coalesce(own, F.lit(1)))
        everywhere = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return (
            marked.join(table, "_key", "left")
            .withColumn(own_part, F.pmod("_row", parts).cast("int"))
            .withColumn(other_part, everywhere)
            .drop("_row", "_key", "_absent", own)
            .withColumnRenamed(other, "_repeats")
        )

    l = spread(left, "_left", "_right", "_lp", "_rp", absent_parts)
    r = spread(right, "_right", "_left", "_rp", "_lp", 1).drop("_repeats").withColumn("_match", F.lit(True))
    joined = l.join(r, on + ["_lp", "_rp"], how)
    joined = joined.where(F.col("_match").isNotNull() | (F.coalesce("_repeats", F.lit(1)) == 1))
    return joined.drop("_lp", "_rp", "_match", "_repeats")


def attach_notes(
    activity: DataFrame, notes: DataFrame, on: Sequence[str] = ("pet_id", "date"), skewed: bool = True
) -> DataFrame:
    """Notes of the same entity and day; a reading repeats for each of its notes.

    Both tables grow and both may repeat a key. `skewed=False` skips the search
    for hot keys where the caller knows there are none.
    """
    if skewed:
        return skew_join(activity, notes, on, "left")
    return activity.join(notes, list(on), "left")


def attach_device(
    activity: DataFrame, daily: DataFrame, on: Sequence[str] = ("pet_id", "date"), day: str = "log_date"
) -> DataFrame:
    """Device sums of the same entity and day; their own name and day columns go."""
    own = [c for c in ("pet_name_from_log",) if c in daily.columns]
    right = daily.drop(*own).withColumnRenamed(day, on[1])
    right = right.withColumn(on[1], F.col(on[1]).try_cast("date"))
    return activity.join(right, list(on), "left")


def attach_text(
    activity: DataFrame, features: DataFrame, on: Sequence[str] = ("pet_id", "date"), skewed: bool = True
) -> DataFrame:
    """Text features of the notes of the same entity and day."""
    return attach_notes(activity, features, on, skewed)


def lookup_by_name(events: DataFrame, profile: DataFrame, log_name: str, name: str, entity: str) -> DataFrame:
    """Entity id through the profile's name; unknown names get NULL."""
    names = profile.select(F.col(name).alias(log_name), F.col(entity))
    return events.join(names, log_name, "left")


def missing_on(df: DataFrame, day: Column, entity: str = "pet_id", date: str = "date") -> DataFrame:
    """Entities that have no row on the given day.

    A flag per entity in one aggregation, instead of a join with itself.
    """
    seen = df.groupBy(entity).agg(F.max(F.coalesce(F.col(date) == day, F.lit(False))).alias("seen"))
    return seen.where(~F.col("seen")).select(entity)


def count_by_domain(df: DataFrame, column: str, domain: Sequence[str], out: str = "n") -> DataFrame:
    """Counts for a fixed list of values in the list's order, zeros kept."""
    spark = df.sparkSession
    table = spark.createDataFrame([(i, v) for i, v in enumerate(domain)], f"position int, {column} string")
    counts = df.where(F.col(column).isin(list(domain))).groupBy(column).agg(F.count("*").alias(out))
    # Counts have a row per domain value at most.
    return (
        table.join(F.broadcast(counts), column, "left")
        .select("position", column, F.coalesce(out, F.lit(0)).alias(out))
        .orderBy("position")
    )
