"""Nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut in two halves, and each half has its own centroids, fitted
on a bounded sample. A cell is a pair of centroids, so k centroids a half make
k * k cells. A query walks the cells in the order of the sum of both distances
with a heap until the cells hold enough vectors, and these are compared exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.common import settled

NEIGHBOURS = 5
#: Vectors that the centroids are fitted on, centroids a half at most, and vectors per cell aimed at below that.
FIT_ROWS = 20_000
MAX_CENTROIDS = 256
CELL_ROWS = 16
#: A query walks cells until they hold so many distinct vectors, or where that is more the share of
#: all that finds this part of the neighbours of so many vectors of the sample.
CANDIDATES = 2_000
RECALL = 0.97
TRIALS = 256
#: Vectors that meet queries in one unit of work, and queries in it.
UNIT_ROWS = 4_096
UNIT_QUERIES = 4_096
#: Queries that one task walks for.
WALK_QUERIES = 128
#: Lengths of vectors that have an index.
INDEXED = 8
#: Pairs compared at once.
UNIT_PAIRS = 1 << 18


def usable(vector: Column) -> Column:
    """Not NULL, not empty, not zero, and without NULL or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, k: int, rounds: int = 15, seed: int = 11) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct points; empty ones are set on the points farthest away."""
    rnd = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rnd.permutation(len(distinct))[: min(k, len(distinct))]]
    for _ in range(rounds):
        distance = _distances(points, centres)
        own = distance.argmin(axis=1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if (n == 0).any():
            far = np.argsort(-distance.min(axis=1), kind="stable")[: (n == 0).sum()]
            centres[np.flatnonzero(n == 0)[: len(far)]] = points[far]
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points * points).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(axis=1)[None, :]


def _units(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    # Scaled first, so that no square overflows or vanishes.
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def walk(first: np.ndarray, second: np.ndarray, held: dict[int, int], wanted: int) -> list[int]:
    """Cells in the order of summed distance until those that hold vectors hold `wanted` of them."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out, n = [(first[a[0]] + second[b[0]], 0, 0)], [], 0
    while heap and n < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if cell in held:
            out.append(cell)
            n += held[cell]
        # (i, j) is reached from (i, j - 1), and (i, 0) from (i - 1, 0): every pair once.
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return out


class Index:
    """The centroids of both halves; at most 2 * MAX_CENTROIDS vectors, whatever the table."""

    def __init__(self, sample: np.ndarray, rows: int):
        k = max(1, min(MAX_CENTROIDS, math.ceil(math.sqrt(rows / CELL_ROWS))))
        self.middle = sample.shape[1] // 2
        self.first, self.second = kmeans(sample[:, : self.middle], k), kmeans(sample[:, self.middle :], k)

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(units[:, : self.middle], self.first), _distances(units[:, self.middle :], self.second)

    def share(self, sample: np.ndarray, neighbours: int, recall: float) -> float:
        """The part of all vectors that a walk has to see to find `recall` of the nearest ones.

        Measured in the sample: for some of its vectors, how many others lie in
        cells no farther than the cells of their true neighbours. In a larger
        table neighbours are nearer, so the part is rather too large than too small.
        """
        sample = np.unique(sample, axis=0)
        if len(sample) < 2:
            return 1.0
        tried = sample[np.random.default_rng(5).permutation(len(sample))[:TRIALS]]
        own = self.cells(sample)
        places = []
        for lo in range(0, len(tried), 16):
            some = tried[lo : lo + 16]
            a, b = self.distances(some)
            sums = a[:, own // len(self.second)] + b[:, own % len(self.second)]
            near = some @ sample.T
            order = np.argsort(-near, axis=1, kind="stable")[:, 1 : neighbours + 1]
            reach = np.take_along_axis(sums, order, axis=1)
            places.append((sums[:, None, :] <= reach[:, :, None]).sum(axis=2).ravel() / len(sample))
        return float(np.quantile(np.concatenate(places), recall))

    def cells(self, units: np.ndarray) -> np.ndarray:
        a, b = self.distances(units)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)


def shelve(held: dict[int, int]) -> tuple[dict[int, int], list[int]]:
    """A shelf for every cell, and the parts that each shelf is cut into.

    Neighbouring cells share a shelf of about UNIT_ROWS vectors; a cell with more
    has a shelf of its own, in parts.
    """
    shelves, parts, n = {}, [], UNIT_ROWS
    for cell in sorted(held):
        if n + held[cell] > UNIT_ROWS:
            parts.append(max(1, math.ceil(held[cell] / UNIT_ROWS)))
            n = 0
        shelves[cell] = len(parts) - 1
        n += held[cell]
    return shelves, parts


def _cell_column(index: Index, vector: Column) -> Column:
    @F.pandas_udf("int")
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(index.cells(_units(vectors)).astype(np.int32)) if len(vectors) else pd.Series([], dtype="int32")

    return cells(vector)


def _walks(index: Index, held: dict[int, int], shelves: dict[int, int], wanted: int):
    """Rows of a query and a shelf: the cells there that the query walks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                some = batch.iloc[lo : lo + 64]
                rows = []
                for asked, vector, x, y in zip(some["class"], some["vector"], *index.distances(_units(some["vector"]))):
                    by_shelf: dict[int, list[int]] = {}
                    for cell in walk(x, y, held, wanted):
                        by_shelf.setdefault(shelves[cell], []).append(cell)
                    rows.extend((asked, vector, shelf, cells) for shelf, cells in by_shelf.items())
                yield pd.DataFrame(rows, columns=["class", "vector", "shelf", "cells"])

    return run


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, pair by pair in the same order of operations whatever comes with them."""
    dot = np.einsum("ij,ij->i", queries, vectors)
    return dot / np.sqrt(np.einsum("ij,ij->i", queries, queries) * np.einsum("ij,ij->i", vectors, vectors))


def _nearest(neighbours: int):
    """The best rows of a unit for each of its queries: by a product of matrices, then exactly, ties included."""

    def best(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": pd.Series([], dtype="int64"), "entry": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if queries.empty or entries.empty:
            return none
        q, e = (np.stack([np.asarray(v, np.float64) for v in df["vector"]]) for df in (queries, entries))
        unit_q, unit_e = _units(queries["vector"]), _units(entries["vector"])
        asked, named, ids = (df.to_numpy() for df in (queries["class"], entries["class"], entries["first_id"]))
        cells, place = np.unique(entries["cell"].to_numpy(), return_inverse=True)
        # A query's own class can be the best, so one more is taken.
        keep, out = min(neighbours + 1, len(e)), [none]
        step = max(1, UNIT_PAIRS // len(e))
        for lo in range(0, len(q), step):
            walked = np.stack([np.isin(cells, c) for c in queries["cells"].iloc[lo : lo + step]])
            near = np.where(walked[:, place], unit_q[lo : lo + step] @ unit_e.T, -2)
            least = np.partition(near, len(e) - keep, axis=1)[:, len(e) - keep]
            i, j = np.nonzero((near >= least[:, None] - 1e-9) & (near > -2))
            score = cosines(q[lo + i], e[j])
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            top = np.arange(len(i)) - np.searchsorted(i, i) < keep
            out.append(pd.DataFrame({"query": asked[lo + i[top]], "entry": named[j[top]], "score": score[top]}))
        return pd.concat(out, ignore_index=True)

    return best


def search(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
    candidates: int = CANDIDATES,
    recall: float = RECALL,
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for every query its nearest vectors, ties by smaller id.

    All rows are indexed and `is_query` says which are queries. A row is never
    its own neighbour; rows are told apart by id, and a vector that an id has
    twice counts once. Vectors that are NULL, empty, zero or of non-finite or
    NULL components take no part, neither do rows without id. A cosine needs two
    vectors of one length, so candidates of a query are those of its length: the
    INDEXED commonest lengths have an index each, vectors of rarer lengths are
    compared with all of theirs. How far a query walks is fitted to
    the sample, so that about `recall` of the neighbours are found: little for
    vectors in clusters, much for vectors without any. A table with fewer vectors
    than `candidates` is walked whole. Other columns are not read.

    Equal vectors are one class, of which only the smallest ids can be
    neighbours, so large groups of copies cost no more than one vector. Cells lie
    on shelves of UNIT_ROWS vectors, and a query goes to each shelf that it walks
    once, with the cells it walks there. The table of
    cells has MAX_CENTROIDS ** 2 rows at most; it and the centroids are all that
    reaches the driver besides the bounded sample and INDEXED lengths.
    """
    rows = table.select(
        table[id_col].cast("bigint").alias("id"), table[vector_col].cast("array<double>").alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    length = F.size("vector")
    lengths = rows.groupBy(length.alias("length")).agg(F.count("*").alias("n"))
    common = [r["length"] for r in lengths.orderBy(F.desc("n"), "length").limit(INDEXED + 1).collect()]
    found = [_search_indexed(rows.where(length == n), neighbours, candidates, recall) for n in common[:INDEXED]]
    if len(common) > INDEXED:
        found.append(_search_whole(rows.where(~length.isin(common[:INDEXED])), neighbours))
    if not found:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, found)


def _members(rows: DataFrame, neighbours: int) -> DataFrame:
    """Distinct ids of each vector in order, no more than can be neighbours."""
    # -0.0 and 0.0 are one value to the grouping, and to a cosine.
    firsts = Window.partitionBy("vector").orderBy("id")
    members = rows.select("id", "vector").dropDuplicates(["id", "vector"]).withColumn("place", F.row_number().over(firsts))
    # A query can be in its own class, so one more id than neighbours.
    return settled(members.where(F.col("place") <= neighbours + 1), "members")


def _queries(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that ask, and their distinct vectors, dealt evenly over the tasks of what follows."""
    asking = rows.where(F.coalesce("asks", F.lit(False))).select("id", "vector")
    return asking, settled(asking.groupBy("vector").agg(F.min("id").alias("class")), "queries")


def _ranked(found: DataFrame, members: DataFrame, entries: DataFrame, asking: DataFrame, queries: DataFrame, neighbours: int) -> DataFrame:
    """The best classes of each class of queries, then their ids for each query."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= neighbours + 1).drop("place")
    ids = members.select("id", "vector").join(entries.select("class", "vector"), "vector").select(F.col("class").alias("entry"), "id")
    of_query = asking.join(queries, "vector").select(F.col("id").alias("query_id"), F.col("class").alias("query")).distinct()
    pairs = of_query.join(top, "query").join(ids, "entry").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )


def _every(n: str | Column) -> Column:
    """A row for each number below n."""
    return F.explode(F.sequence(F.lit(0), (F.col(n) if isinstance(n, str) else n) - 1))


_FOUND = "query bigint, entry bigint, score double"


def _search_whole(rows: DataFrame, neighbours: int) -> DataFrame:
    """The nearest of all vectors of the same length, for lengths that are too rare for an index."""
    members, (asking, queries) = _members(rows, neighbours), _queries(rows)
    entries = members.where("place = 1").select(F.col("id").alias("class"), F.col("id").alias("first_id"), "vector")

    def units(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy(F.size("vector").alias("length")).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    # A row per length; Spark picks the join by its size.
    sizes = settled(units(entries, UNIT_ROWS, "parts").join(units(queries, UNIT_QUERIES, "groups"), "length"), "lengths")
    spread, all_of_it = F.xxhash64("class"), F.lit(0).alias("cell")
    part, group = (F.pmod(spread, n).cast("int").alias(n[:-1]) for n in ("parts", "groups"))
    left = queries.withColumn("length", F.size("vector")).join(sizes, "length")
    left = left.select("class", "vector", "length", F.array(F.lit(0)).alias("cells"), group, _every("parts").alias("part"))
    right = entries.withColumn("length", F.size("vector")).join(sizes, "length")
    right = right.select("class", "first_id", "vector", "length", all_of_it, part, _every("groups").alias("group"))
    unit = ["length", "part", "group"]
    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(_nearest(neighbours), _FOUND)
    return _ranked(found, members, entries, asking, queries, neighbours)


def _search_indexed(rows: DataFrame, neighbours: int, candidates: int, recall: float) -> DataFrame:
    """The nearest vectors by an index of rows of one length."""
    spark = rows.sparkSession
    sample = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").toPandas()["vector"]
    members = _members(rows, neighbours)
    fitted = _units(sample)
    n = members.where("place = 1").count()
    index = Index(fitted, n)
    entries = members.where("place = 1").select(
        F.col("id").alias("class"), F.col("id").alias("first_id"), "vector", _cell_column(index, F.col("vector")).alias("cell")
    )
    entries = settled(entries, "entries")
    cells = entries.groupBy("cell").agg(F.count("*").alias("n"))
    held = {r["cell"]: r["n"] for r in cells.collect()}
    wanted = max(candidates, math.ceil(index.share(fitted, neighbours, recall) * n))

    asking, queries = _queries(rows)
    n_queries = queries.count()
    groups = max(1, math.ceil(n_queries / UNIT_QUERIES))
    shelves, parts = shelve(held)
    # Queries are few and lie in few files; walking takes long, so they are dealt out first.
    walkers = max(1, math.ceil(n_queries / WALK_QUERIES))
    walked = queries.repartition(walkers, "class").mapInPandas(
        _walks(index, held, shelves, wanted), "class bigint, vector array<double>, shelf int, cells array<int>"
    )
    # A row per cell, so both may be broadcast.
    of_cell = spark.createDataFrame([(c, k, parts[k]) for c, k in shelves.items()], "cell int, shelf int, parts int")
    of_shelf = spark.createDataFrame(list(enumerate(parts)), "shelf int, parts int")
    spread = F.xxhash64("class")
    part, group = (F.pmod(spread, n).cast("int") for n in (F.col("parts"), F.lit(groups)))
    left = walked.join(F.broadcast(of_shelf), "shelf").select(
        "class", "vector", "cells", "shelf", group.alias("group"), _every("parts").alias("part")
    )
    right = entries.join(F.broadcast(of_cell), "cell").select(
        "class", "first_id", "vector", "cell", "shelf", part.alias("part"), _every(F.lit(groups)).alias("group")
    )
    unit = ["shelf", "part", "group"]
    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(_nearest(neighbours), _FOUND)
    return _ranked(found, members, entries, asking, queries, neighbours)
