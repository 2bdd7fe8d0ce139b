"""The largest inner products, exactly, by the threshold algorithm over sorted lists.

A block of vectors has a list per dimension, sorted by that component. A query
reads all lists from the end where its own component makes products large, some
rows deeper at a time. Every vector that it meets is scored in full. No vector
that it has not met can score more than the sum of the products at the depth
reached, so it stops when that bound cannot beat its kth result. A unit of work
keeps its queries and their results while one block after the other passes, so
later blocks are left sooner, often before the first row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.codes import usable, whole
from entityhealth.llm.common import settled

NEIGHBOURS = 5
#: Queries of a unit of work, and vectors that pass them: at least, at most, and units aimed at in between.
GROUP_QUERIES = 1 << 15
LEAST_ROWS, MOST_ROWS, RANGES = 1 << 11, 1 << 20, 64
#: Vectors that have sorted lists at once, queries that read them together, and rows of the first step.
BLOCK_ROWS = 1 << 13
TOGETHER = 512
FIRST_STEP = 32
#: Lengths of vectors that are counted one by one; the rarer ones are dealt like the last of these.
LENGTHS = 64
#: Tasks that units are dealt to, in turn.
MOST_TASKS = 1 << 14
LONGEST = 2**63 - 1


class Block:
    """Vectors in order of their ids, and for every dimension their order by that component."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        place = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[place], points[place]
        self.order = np.argsort(self.points, axis=0, kind="stable").astype(np.int32)
        self.lists = np.take_along_axis(self.points, self.order, axis=0)

    def bound(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """What a vector that none of the first `depth` rows of a query's lists named can score at most."""
        high, low = self.lists[len(self.ids) - 1 - depth], self.lists[depth]
        return _clamped(np.where(queries >= 0, queries * high, queries * low).sum(axis=1))


def _clamped(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; larger ones are the largest long, so they tie."""
    if scores.dtype == object:
        return np.array([min(LONGEST, max(-LONGEST, int(x))) for x in scores.ravel()], np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


#: Score of a place that holds no result.
NONE = -(2**63)


class Results:
    """The best `k` ids of every query so far, best first."""

    def __init__(self, n: int, k: int):
        self.score, self.entry = np.full((n, k), NONE, np.int64), np.full((n, k), -1, np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray, fits: np.ndarray) -> None:
        """Scores of queries `rows` with vectors `ids`, where `fits`; ids come in rising order, each once."""
        k = self.score.shape[1]
        score, old, held = np.where(fits, score, NONE), self.score[rows], self.entry[rows]
        # An id that is a result already and has another row here keeps the better score.
        place = np.minimum(np.searchsorted(ids, held), len(ids) - 1)
        i, j = np.nonzero((ids[place] == held) & np.take_along_axis(fits, place, axis=1))
        score[i, place[i, j]] = np.maximum(score[i, place[i, j]], old[i, j])
        old[i, j] = NONE
        all_scores = np.concatenate([old, score], axis=1)
        all_ids = np.concatenate([held, np.broadcast_to(ids, score.shape)], axis=1)
        least = np.partition(all_scores, all_scores.shape[1] - k, axis=1)[:, -k]
        i, j = np.nonzero((all_scores >= least[:, None]) & (all_scores > NONE))
        found, named = all_scores[i, j], all_ids[i, j]
        order = np.lexsort((named, -found, i))
        i, found, named = i[order], found[order], named[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = place < k
        self.score[rows], self.entry[rows] = NONE, -1
        self.score[rows[i[top]], place[top]] = found[top]
        self.entry[rows[i[top]], place[top]] = named[top]

    def last(self, rows: np.ndarray) -> np.ndarray:
        return self.score[rows, -1]


def read(block: Block, queries: np.ndarray, asked: np.ndarray, rows: np.ndarray, results: Results) -> int:
    """Go down the lists of a block for the queries `rows` until none can gain; returns how many vectors were scored."""
    n, depth, step, scored = len(block.ids), 0, FIRST_STEP, 0
    met = np.zeros((len(rows), n), bool)
    active = np.flatnonzero(block.bound(queries[rows], 0) >= results.last(rows))
    while len(active) and depth < n:
        end = min(n, depth + step)
        new = np.zeros((len(active), n), bool)
        up = queries[rows[active]] >= 0
        for j in range(queries.shape[1]):
            for readers, named in ((up[:, j], block.order[n - end : n - depth, j]), (~up[:, j], block.order[depth:end, j])):
                if readers.any():
                    new[np.ix_(np.flatnonzero(readers), named)] = True
        new &= ~met[active]
        met[active] |= new
        columns = np.flatnonzero(new.any(axis=0))
        if len(columns):
            own = rows[active]
            # A query's own rows are met like any other, but are no result.
            fits = new[:, columns] & (asked[own][:, None] != block.ids[columns][None, :])
            results.add(own, block.ids[columns], _clamped(queries[own] @ block.points[columns].T), fits)
            scored += int(new.sum())
        depth, step = end, 2 * step
        if depth < n:
            going = (block.bound(queries[rows[active]], depth) >= results.last(rows[active])) & ~met[active].all(axis=1)
            active = active[going]
    return scored


def _exact(queries: np.ndarray, points: np.ndarray) -> bool:
    """Whether all products and their sums stay whole in doubles."""
    if queries.dtype == object or points.dtype == object:
        return False
    return max(1, queries.shape[1]) * float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) < 2**52


def _layers(ids: np.ndarray) -> Iterator[np.ndarray]:
    """Places of distinct ids: the first row of every id, then the second, and so on."""
    order = np.argsort(ids, kind="stable")
    held = ids[order]
    nth = np.arange(len(ids)) - np.searchsorted(held, held)
    for layer in range(int(nth.max(initial=-1)) + 1):
        yield order[nth == layer]


class _Unit:
    """One group of queries, and the blocks that pass it."""

    def __init__(self, k: int):
        self.k, self.ids, self.parts, self.results = k, [], [], None
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add_queries(self, ids: np.ndarray, points: np.ndarray) -> None:
        self.ids.append(ids)
        self.parts.append(points)

    def add_vectors(self, ids: np.ndarray, points: np.ndarray) -> None:
        self.waiting.append((ids, points))
        if sum(len(i) for i, _ in self.waiting) >= BLOCK_ROWS:
            self._pass()

    def _pass(self) -> None:
        if not self.ids:
            self.waiting = []
        if not self.waiting:
            return
        if self.results is None:
            self.asked, self.queries = np.concatenate(self.ids), np.concatenate(self.parts)
            self.results = Results(len(self.asked), self.k)
        ids, points = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, queries = [], self.queries
        if not _exact(queries, points):
            points, queries = (np.frompyfunc(int, 1, 1)(x) if x.size else x.astype(object) for x in (points, queries))
        for layer in _layers(ids):
            block = Block(ids[layer], points[layer])
            for at in range(0, len(queries), TOGETHER):
                read(block, queries, self.asked, np.arange(at, min(len(queries), at + TOGETHER)), self.results)

    def end(self) -> Iterator[pa.RecordBatch]:
        self._pass()
        if self.results is not None:
            row, place = np.nonzero(self.results.score > NONE)
            columns = [self.asked[row], self.results.entry[row, place], self.results.score[row, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search(k: int):
    """The results of sorted units: in each, rows of queries first, then vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, unit = None, _Unit(k)
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "group", "range", "kind")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if lo == hi:
                    continue
                *at, kind = key[lo].tolist()
                if at != now:
                    yield from unit.end()
                    now, unit = at, _Unit(k)
                rows = batch.slice(lo, hi - lo)
                points = whole(rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), at[0]))
                # Vectors without components have one list, of zeros.
                points = points if at[0] else np.zeros((len(rows), 1))
                (unit.add_vectors if kind else unit.add_queries)(rows.column("id").to_numpy(), points)
        yield from unit.end()

    return run


def search(
    table: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = NEIGHBOURS
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for every query the largest inner products, ties by smaller id.

    Components count as floor(256 * x). All rows are candidates and `is_query` says
    which are queries; a row is never its own result. A query with fewer candidates
    than `neighbours` gets all. Vectors that are NULL or hold a NULL or non-finite
    component take no part, neither do rows without id. An inner product needs two
    vectors of one length, so candidates of a query are those of its length. Rows
    are told apart by id: an id with several rows has the best score of any of them.
    Scores that a long cannot hold count as the largest, or smallest, long. Other
    columns are not read. No rows give no rows.

    A unit of work is a group of up to about GROUP_QUERIES queries with a range of up
    to about MOST_ROWS vectors, both dealt by a hash, so no unit grows with the
    table. It holds the queries and one block; the vectors stream past. A row goes
    to one unit for every group of queries, a query to one for every range, and a
    unit returns `neighbours` rows a query. Only counts reach the driver.
    """
    rows = table.select(
        table[id_col].cast("bigint").alias("id"),
        table[vector_col].cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    # Copies meet as hashes of what they hold, added up before the shuffle.
    rows = rows.groupBy("id", "vector").agg(F.bool_or("asks").alias("asks"))
    rows = settled(rows.withColumn("length", F.size("vector")), "vectors")
    sizes = rows.groupBy("length").agg(F.count("*").alias("n"), F.count_if("asks").alias("queries"))
    counted = sizes.orderBy(F.desc("n"), "length").limit(LENGTHS).collect()
    if not counted:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def by_length(values: list[int]) -> Column:
        """A value for each counted length; the last one is that of all others."""
        out = F.lit(values[-1])
        for r, value in zip(counted, values):
            out = F.when(F.col("length") == r["length"], F.lit(value)).otherwise(out)
        return out

    counts = [(r["n"], r["queries"]) for r in counted]
    if len(counted) == LENGTHS:
        # A length that is not among the counted has no more rows than the last of these.
        counts.append((counted[-1]["n"], counted[-1]["n"]))
    n_groups = [max(1, -(-q // GROUP_QUERIES)) for _, q in counts]
    n_ranges = [-(-n // min(MOST_ROWS, max(LEAST_ROWS, n // RANGES))) for n, _ in counts]
    first = [sum(g * r for g, r in zip(n_groups[:i], n_ranges)) for i in range(len(counts))]
    tasks = min(MOST_TASKS, first[-1] + n_groups[-1] * n_ranges[-1])
    groups, ranges = by_length(n_groups), by_length(n_ranges)
    spread = F.xxhash64("id", "vector")
    own_group, own_range = F.pmod(spread, groups).cast("int"), F.pmod(F.shiftright(spread, 20), ranges).cast("int")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    queries = rows.where("asks").select(
        "length", own_group.alias("group"), every(ranges).alias("range"), F.lit(0).alias("kind"), "id", "vector"
    )
    vectors = rows.select("length", every(groups).alias("group"), own_range.alias("range"), F.lit(1).alias("kind"), "id", "vector")
    unit = ["length", "group", "range"]
    task = F.pmod(by_length(first) + F.col("group") * ranges + F.col("range"), F.lit(tasks)).cast("int")
    work = queries.unionByName(vectors).repartitionById(tasks, task).sortWithinPartitions(*unit, "kind")
    found = work.mapInArrow(_search(neighbours), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.repartition("query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
