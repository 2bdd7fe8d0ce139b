import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityhealth.llm import multiindex

SF = "/root/testdata/sf0.1"


def brute(rows, queries, k=5):
    """Exact neighbours of `queries` among (id, vector) rows."""
    fine = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids = np.array([i for i, _ in fine])
    vectors = np.array([v for _, v in fine], np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    out = {}
    for i, v in zip(ids, vectors):
        if i in queries:
            score = (vectors * v).sum(axis=1) / (norms * np.sqrt((v * v).sum()))
            order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def test_walks_of_fitted_length(table):
    """Vectors without clusters: a walk has to see much of the table."""
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    got = answers(multiindex.search(table, table["vec_id"] % 50 == 0, candidates=10))
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        scores = [s for _, s in found]
        assert scores == sorted(scores, reverse=True) and len(found) == 5 and q not in {i for i, _ in found}


def test_walks_are_short_in_clusters(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(60, 16))
    rows = [(i, [float(x) for x in centres[i % 60] + 0.1 * rnd.normal(size=16)]) for i in range(3000)]
    units = multiindex._units([np.array(v) for _, v in rows])
    index = multiindex.Index(units, len(units))
    assert index.share(units, 5, 0.97) < 0.1
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = answers(multiindex.search(table, table["vec_id"] % 50 == 0, candidates=10))
    assert recall(got, brute(rows, {i for i, _ in rows if i % 50 == 0})) >= 0.9


def test_production_parameters_against_brute_force(table):
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    got = answers(multiindex.search(table, table["vec_id"] % 50 == 0))
    assert recall(got, want) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    assert all(abs(s - exact[q][i]) < 1e-12 for q, found in got.items() for i, s in found if i in exact[q])


def test_copies_ties_and_vectors_without_a_part(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(200)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]) for i in range(500)]  # one large group of copies
    rows += [(2000 + i, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0, 14.0, 16.0]) for i in range(3)]  # the same direction
    rows += [(3000, None), (3001, []), (3002, [0.0] * 8), (3003, [1.0] * 7 + [float("nan")]), (3004, [1.0] * 7 + [float("inf")])]
    rows += [(3005, [None] + [1.0] * 7), (None, [1.0] * 8), (5, rows[5][1]), (3006, [1e300] * 8), (3007, [-0.0] * 7 + [1.0]), (3008, [0.0] * 7 + [1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"class": F.lit(1), "cell": F.lit("x")})
    asks = table["vec_id"] % 50 == 0
    got = answers(multiindex.search(table, asks))
    clean = {i: v for i, v in rows if i is not None and i != 3006}
    want = brute(list(clean.items()), {i for i in clean if i % 50 == 0})
    assert set(got) == set(want) | ({3000} & set(got)) and 3000 not in got
    for q, w in want.items():
        near = [i for i, _ in got[q] if i != 3006]
        assert near == [i for i, _ in w][: len(near)] and len(near) >= 4
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]
    assert [i for i, _ in got[1100]] == [1000, 1001, 1002, 1003, 1004]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_small_tables(spark, n):
    table = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id bigint, embedding array<float>")
    got = answers(multiindex.search(table, table["vec_id"] % 50 == 0))
    assert {q: len(v) for q, v in got.items()} == {50 * i: n - 1 for i in range(n) if n > 1}


def test_walk_is_in_the_order_of_the_sums():
    rnd = np.random.default_rng(1)
    a, b = rnd.random(9), rnd.random(7)
    held = {c: 1 for c in range(63) if c % 3}
    sums = [a[c // 7] + b[c % 7] for c in multiindex.walk(a, b, held, 10**9)]
    assert len(sums) == len(held) and sums == sorted(sums)
    assert len(multiindex.walk(a, b, held, 5)) == 5


def test_units_cut_a_large_cell(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    rows = [(i, [float(x) for x in 1 + 1e-3 * rnd.normal(size=6)]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(multiindex, "UNIT_ROWS", 50)
    monkeypatch.setattr(multiindex, "UNIT_QUERIES", 2)
    monkeypatch.setattr(multiindex, "CELL_ROWS", 400)
    got = answers(multiindex.search(table, table["vec_id"] % 50 == 0))
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def by_length(rows, queries):
    out = {}
    for n in {len(v) for _, v in rows}:
        out |= brute([r for r in rows if len(r[1]) == n], queries)
    return {q: w for q, w in out.items() if w}


def test_a_stray_length_does_not_drop_the_others(spark):
    """Whatever id hashes first: every vector has the neighbours of its length."""
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(200)]
    queries = {i for i in range(1000) if i % 50 == 0}
    for stray in ([(777, [1.0, 2.0])], [(750, [1.0, 2.0]), (777, [2.0, 1.0]), (800, [3.0, 1.0])]):
        df = spark.createDataFrame(rows + stray, "vec_id bigint, embedding array<double>")
        got, want = answers(multiindex.search(df, df["vec_id"] % 50 == 0)), by_length(rows + stray, queries)
        assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
        assert len([q for q in got if q < 200]) == 4


def test_rare_lengths_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "INDEXED", 1)
    monkeypatch.setattr(multiindex, "UNIT_QUERIES", 2)
    monkeypatch.setattr(multiindex, "UNIT_ROWS", 16)
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.normal(size=(6, 3, 4)[i % 5 % 3])]) for i in range(300)]
    rows += [(400 + i, [1.0, 1.0, 1.0]) for i in range(60)] + [(1000, [2.0] * 9)]
    df = spark.createDataFrame(rows + rows[:7], "vec_id bigint, embedding array<double>")
    got = answers(multiindex.search(df, df["vec_id"] % 20 == 0))
    want = by_length(rows, {i for i, _ in rows if i % 20 == 0})
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
