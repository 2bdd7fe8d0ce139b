"""Exact ranks and quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.session import fixed, written

# Even ranks that bracket a quantile, and the accuracy of the sketch that finds them.
GRID = 200
ACCURACY = 10_000


def ordered_index(df: DataFrame, order: Sequence[Column], out: str = "index") -> DataFrame:
    """Position of every row in a total order, from 0.

    Range partitions are sorted and numbered on their own, then shifted by the
    sizes of the partitions before them. The checkpoint fixes the partitions,
    whose bounds come from a sample, so both uses see the same ones.
    """
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = fixed(sorted_parts.withColumns({"_part": F.spark_partition_id(), "_pos": place}))
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per shuffle partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        numbered.join(F.broadcast(starts), "_part")
        .withColumn(out, (F.col("_start") + F.col("_pos")).cast("bigint"))
        .drop("_part", "_pos", "_start")
    )


def _marks(present: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group the number of values and GRID + 1 values at even ranks, from a mergeable sketch."""
    even = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    marks = F.percentile_approx(value, even, F.lit(ACCURACY)).alias("marks")
    return written(present.groupBy(*keys).agg(F.count("*").alias("total"), marks), "marks")


def _bracketed(present: DataFrame, keys: Sequence[str], value: str, brackets: DataFrame) -> DataFrame:
    """Counts of the values inside each bracket, and of all values below it under NULL.

    Values above are dropped and those below become one count per task, so of a
    group only the few values near the wanted ranks are shuffled and written.
    Buckets are range partitions of like size; NULL comes before the values.
    """
    near = present.join(brackets, list(keys)).select(*keys, F.col(value).alias("_value"), F.inline("brackets"))
    seen = near.where(F.col("_value") <= F.col("upper")).select(
        *keys, "prob", F.when(F.col("_value") >= F.col("lower"), F.col("_value")).alias("_value")
    )
    counts = seen.groupBy(*keys, "prob", "_value").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange(*keys, "prob", "_value")
    return written(ranged.withColumn("bucket", F.spark_partition_id()), "brackets")


def _at_ranks(counts: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """The value at every target rank. Only the buckets that hold one are sorted, each on its own."""
    keys = list(keys)
    totals = counts.groupBy(*keys, "bucket").agg(F.sum("n").alias("bucket_n"))
    along = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("start", F.coalesce(F.sum("bucket_n").over(along), F.lit(0)))
    located = targets.join(totals, keys).where(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("bucket_n"))
    )
    needed = located.select(*keys, "bucket", "start").distinct()
    inside = Window.partitionBy(*keys, "bucket").orderBy(F.asc_nulls_first("_value"))
    ranked = counts.join(needed, keys + ["bucket"]).withColumn(
        "end", F.col("start") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return ranked.join(located.select(*keys, "bucket", "what", "rank"), keys + ["bucket"]).where(
        (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Exact linear-interpolated quantiles and the number of values per group.

    A first pass brackets each wanted rank with a sketch, whose error is a
    fiftieth of a bracket; a second one counts what lies below and keeps only
    the values inside. Rows with a NULL key or value do not count.
    """
    keys = list(keys)
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, value)]))
    marks = _marks(present, keys, value)
    brackets, wanted = [], []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")
        first = F.greatest(F.lit(0), F.floor(low / F.col("total") * GRID).cast("int") - 1)
        last = F.least(F.lit(GRID), F.ceil((high + 2) / F.col("total") * GRID).cast("int") + 1)
        brackets.append(
            F.struct(F.lit(i).alias("prob"), F.get("marks", first).alias("lower"), F.get("marks", last).alias("upper"))
        )
        for what, rank in (("low", low), ("high", high)):
            wanted.append(F.struct(F.lit(i).alias("prob"), F.lit(what).alias("what"), rank.alias("rank")))
    counts = _bracketed(present, keys, value, marks.select(*keys, F.array(*brackets).alias("brackets")))
    hits = _at_ranks(counts, [*keys, "prob"], marks.select(*keys, F.inline(F.array(*wanted))))
    found = hits.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("prob") == i) & (F.col("what") == what), F.col("_value"))).alias(f"{what}{i}")
            for i in range(len(probs))
            for what in ("low", "high")
        ]
    )

    def interpolate(i: int, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("total") - 1)
        return F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (position - F.floor(position))

    return found.join(marks.select(*keys, "total"), keys).select(
        *keys, "total", *[interpolate(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))]
    )


def box_stats(df: DataFrame, keys: Sequence[str], value: str = "value", reach: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers, number of outliers.

    Whiskers end at the outermost values within `reach` interquartile ranges of
    the box. The numbers of a group are written once and joined back to its
    values, which are aggregated per task.
    """
    keys = list(keys)
    box = written(quantiles(df, keys, value, (0.25, 0.5, 0.75), ("q1", "median", "q3")), "box")
    low = F.col("q1") - reach * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + reach * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(low, high)
    return (
        df.where(F.col(value).isNotNull())
        .join(box, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum(F.when(~inside, 1).otherwise(0)).alias("outliers"),
        )
    )
