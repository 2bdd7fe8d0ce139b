"""Mixing sources to target weights with a hash-random order and distributed prefix sums.

Every document has a key that is as good as random and the same on every run.
Within a source documents are in the order of their keys. A source whose target
is more than its size is taken whole as often as it fits; then the documents up
to a cut are taken once more. Keys are uniform, so ranges of equal width are of
like size: sums per range give the range that holds the cut, and only the rows
of that range are sorted. A cut is a key per source, so the choice is made where
the document lies and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.common import hash_key, key_range, n_words, settled

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
DIGITS = 3


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """`target` for every row of `source`, `source_size`.

    Weights repeat over the sources in the order of their names, NULL last. All
    words are shared by weight; a source gets `epochs` times its size at most,
    and what it leaves goes to the others by weight. That is: with sources in
    the order of size per weight, those come to their cap whose cap is below
    what the rest would get. One row per source, sums over all of them.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights))
    rows = sources.withColumns({"weight": weight.cast("bigint"), "cap": F.col("source_size") * epochs})
    by_share = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = by_share.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = F.col("cap").cast("double") * F.col("heavy") <= F.col("weight").cast("double") * F.col("rest")
    rows = rows.withColumns({"rest": rest, "heavy": heavy}).withColumn("full", full)
    left = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    shared = (F.col("weight") * F.col("left")).cast("double") / F.col("open_weight")
    return rows.withColumns({"left": left, "open_weight": open_weight}).select(
        "source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def cuts(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source its size, target, whole `rounds` and the last `cut` key of the round after them.

    `sized` has `source`, `key`, `size`. The document over which the budget
    ends is taken where that comes nearer to the budget.
    """
    sources = settled(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    goal = targets(sources, weights, epochs)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goal = goal.withColumn("rounds", rounds)
    goal = settled(goal.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size")), "targets")

    # 16 ** DIGITS rows per source at most.
    ranges = sized.groupBy("source", key_range(F.col("key"), DIGITS).alias("range")).agg(F.sum("size").alias("held"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("held").over(along), F.lit(0)))
    at = _per_source(ranges, goal.select("source", "budget")).where(
        (F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("held"))
    )
    at = settled(at.select("source", "range", "before", "budget"), "cut_ranges")

    hold = sized.withColumn("range", key_range(F.col("key"), DIGITS))
    wanted = at.withColumnsRenamed({"source": "_source", "range": "_range"})
    hold = hold.join(wanted, hold["source"].eqNullSafe(wanted["_source"]) & (hold["range"] == wanted["_range"]))
    keys = hold.groupBy("source", "range", "before", "budget", "key").agg(F.sum("size").alias("size"))
    until = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("before") + F.coalesce(F.sum("size").over(until), F.lit(0)) + F.col("size") / 2
    last = keys.withColumn("taken", place <= F.col("budget")).groupBy("source", "range").agg(
        F.max(F.when(F.col("taken"), F.col("key"))).alias("last")
    )
    first = F.lpad(F.lower(F.hex("range")), DIGITS, "0")
    cut = last.select("source", F.coalesce("last", first).alias("cut"))
    return settled(_per_source(goal.drop("budget"), cut, "left"), "cuts")


def _per_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what their source has; a missing source is a source."""
    other = per_source.withColumnRenamed("source", "_source")
    return rows.join(other, rows["source"].eqNullSafe(other["_source"]), how).drop("_source")


def copies() -> Column:
    """How often a document is taken, from its `key` and its source's `rounds` and `cut`."""
    return F.col("rounds") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """`doc_id`, `size`, `source`, `source_size`, `target`, `taken` for every row.

    Sizes are words; NULL and empty texts have none and are never short of being
    taken. NULL is a source of its own, the last one. Rows without id are ordered
    by their text. Rows with the same id are taken together, so repeated rows do
    not make the choice depend on the run. Other columns are not read.
    """
    text = docs[text_col]
    sized = settled(
        docs.select(
            docs[id_col].alias("doc_id"),
            docs[source_col].alias("source"),
            hash_key(docs[id_col], text, seed).alias("key"),
            n_words(text).alias("size"),
        ),
        "sizes",
    )
    return _per_source(sized, cuts(sized, weights, epochs)).select(
        "doc_id", "size", "source", "source_size", "target", (F.col("size") * copies()).alias("taken")
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, all columns as they were.

    Rows are taken as by `mix`: NULL is the last source, rows with the same id
    go together, rows without id are ordered by their text. NULL and empty texts
    have no size and follow their source's rounds and cut. An empty table gives none;
    further columns may have any name.
    """
    text, source = docs[text_col], docs[source_col].alias("source")
    key = hash_key(docs[id_col], text, seed).alias("key")
    cut = cuts(settled(docs.select(source, key, n_words(text).alias("size")), "sizes"), weights, epochs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), source, key)
    taken = _per_source(rows, cut.select("source", "rounds", "cut")).withColumn("copies", copies().cast("int"))
    return taken.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
