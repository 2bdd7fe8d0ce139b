import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityhealth.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, k=5, every=5):
    """(query, rank, id, score) by definition; an id has the best score of any of its rows."""
    fine = [(i, [math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256 for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = {}
    for q, a in fine:
        for i, b in fine:
            if q % every == 0 and i != q and len(a) == len(b):
                score = max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
                best.setdefault(q, {})[i] = max(score, best.get(q, {}).get(i, score))
    return {(q, n, i, s) for q, found in best.items() for n, (s, i) in enumerate(sorted(((s, i) for i, s in found.items()), key=lambda x: (-x[0], x[1]))[:k], 1)}


def answers(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def asked(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("length", F.lit(1)).repartition(3)
    return answers(topk.search(df, df["vec_id"] % 5 == 0, **more))


def vectors(n, length, seed=0, scale=1.0):
    rnd = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in np.round(rnd.normal(size=length) * 4) / 64 * scale]) for i in rnd.permutation(n)]


def test_equals_brute_force(spark):
    rows = vectors(230, 6)
    rows += rows[:9] + [(i, [0.25] * 6) for i in range(300, 380)] + [(i, [0.0] * 6) for i in range(400, 420)]
    rows += [(500, None), (505, [1.0, None] + [1.0] * 4), (510, [float("nan")] * 6), (515, [float("-inf")] * 6), (None, [9.0] * 6)]
    assert asked(spark, rows) == brute(rows)
    assert asked(spark, rows, neighbours=1) == brute(rows, 1)


def test_lengths_and_repeated_ids(spark):
    rows = vectors(80, 4, 1) + vectors(60, 4, 2)[:50] + [(i + 40, v) for i, v in vectors(40, 3, 3)] + [(1000 + i, []) for i in range(9)]
    assert asked(spark, rows) == brute(rows)


def test_few_or_no_rows(spark):
    assert asked(spark, []) == set()
    assert asked(spark, [(0, [1.0])]) == set()
    assert asked(spark, [(0, [1.0]), (3, [-2.0]), (7, [-2.0])]) == {(0, 1, 3, -131072), (0, 2, 7, -131072)}


@pytest.mark.parametrize("scale", [1e8, 1e200])
def test_scores_beyond_a_long_tie(spark, scale):
    rows = vectors(40, 5, 4, scale) + [(100 + i, v) for i, v in vectors(30, 5, 5)]
    assert asked(spark, rows) == brute(rows)


def test_many_units(spark, monkeypatch):
    """Small groups and ranges deal the work to many units, whose results meet."""
    rows = vectors(300, 8, 6)
    want = brute(rows)
    for name, value in (("GROUP_QUERIES", 7), ("LEAST_ROWS", 20), ("LENGTHS", 1), ("MOST_TASKS", 5)):
        monkeypatch.setattr(topk, name, value)
    more = rows + [(1000 + i, v) for i, v in vectors(30, 3, 7)]
    assert asked(spark, rows) == want and asked(spark, more) == brute(more)


def test_blocks_one_after_the_other(monkeypatch):
    """Results carried from block to block, in which ids come again, are those of all rows at once."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rnd = np.random.default_rng(8)
    ids, points = rnd.integers(0, 60, 200), rnd.integers(-5, 6, (200, 4)).astype(float)
    asked, queries = np.arange(0, 60, 7), rnd.integers(-5, 6, (9, 4)).astype(float)
    unit = topk._Unit(5)
    unit.add_queries(asked, queries)
    for at in range(0, 200, 10):
        unit.add_vectors(ids[at : at + 10], points[at : at + 10])
    got = [tuple(r.values()) for b in unit.end() for r in b.to_pylist()]
    want = []
    for q, v in zip(asked, queries):
        best = {}
        for i, s in zip(ids.tolist(), (points @ v).astype(int).tolist()):
            if i != q:
                best[i] = max(s, best.get(i, s))
        want += [(int(q), i, s) for s, i in sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:5]]
    assert sorted(got) == sorted(want)


def test_reading_stops_when_the_bound_cannot_win():
    """One large component decides: a few rows of its list are enough; a second block of small vectors is not read."""
    rnd = np.random.default_rng(9)
    points = rnd.integers(-3, 4, (4000, 8)).astype(float)
    points[:, 0] = rnd.permutation(4000)
    query, results = np.array([[100.0, 1, -1, 1, -1, 0, 1, 1]]), topk.Results(1, 5)
    scored = topk.read(topk.Block(np.arange(4000), points), query, np.array([-1]), np.array([0]), results)
    truth = (points @ query[0]).astype(int)
    order = np.lexsort((np.arange(4000), -truth))[:5]
    assert results.entry[0].tolist() == order.tolist() and results.score[0].tolist() == truth[order].tolist() and scored < 800
    small = topk.Block(np.arange(5000, 6000), points[:1000] * [0.001, 1, 1, 1, 1, 1, 1, 1] // 1)
    assert topk.read(small, query, np.array([-1]), np.array([0]), results) == 0
