"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityhealth.llm.common import settled


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    others = down.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(low.select("a", F.col("low").alias("b")))


def roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`node`, `root` for every linked node that is not the smallest of its component.

    Alternating stars: each round links nodes to smaller ones until every
    component is a star around its smallest node. Each round is written to the
    shared folder, so the lineage stays short. Groups only carry a minimum,
    which is taken before the shuffle; a hot centre is a skewed join, which
    adaptive execution splits.
    """
    links = settled(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        n, mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if n == 0 or (n, mark) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = (n, mark)
        links = settled(_small_star(_large_star(links).distinct()).distinct(), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
