import random

import pytest
from pyspark.sql import functions as F

from entityhealth.llm import mixing


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets as the rule is told: share, cut at the cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, target = set(), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(sizes.values()) - sum(cap * sizes[s] for s in fixed)
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        over = [s for s in free if target[s] > cap * sizes[s]]
        for s in over:
            target[s] = float(cap * sizes[s])
        if not over:
            return target
        fixed |= set(over)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_the_rule(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}" if i else None: rnd.choice((0, 1, 5, 40, 300, 10_000)) for i in range(rnd.randrange(1, 15))}
    sizes |= {"é": 7, "Z": 900, "\U0001f600": 3, "￿": 11}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = shares(sizes)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], rel=1e-12) for s in want)


def corpus(n=3000):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        source = rnd.choice(["big"] * 12 + ["a", "b", "c", None, "é"])
        rows.append((i, "w " * rnd.randrange(0, 60), source))
    return rows


def test_taken_words_come_near_the_targets(spark):
    docs = frame(spark, corpus()).withColumns({"size": F.lit("x"), "key": F.lit(1), "rounds": F.lit(2), "cut": F.lit("c")})
    got = mixing.mix(docs).collect()
    assert len(got) == 3000 and {r.doc_id: r["size"] for r in got} == {i: len(t.split()) for i, t, _ in corpus()}
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken % max(1, r["size"]) == 0 and 0 <= r.taken <= 3 * r["size"]
    want = shares(sizes)
    assert {r.source: r.source_size for r in got} == sizes
    assert all(r.target == pytest.approx(want[r.source]) for r in got)
    assert all(abs(taken[s] - want[s]) <= 30 for s in want)
    # Whole rounds first: within a source the numbers differ by one round at most.
    for s in want:
        times = {r.taken // r["size"] for r in got if r.source == s and r["size"]}
        assert max(times) - min(times) <= 1


def test_rerun_and_partitions_do_not_matter(spark, rows):
    docs = frame(spark, corpus(500))
    one = rows(mixing.mix(docs), "doc_id", "taken")
    assert one == rows(mixing.mix(docs.repartition(13)), "doc_id", "taken")
    assert one != rows(mixing.mix(docs, seed="other"), "doc_id", "taken")


def test_documents_of_the_mix(spark):
    docs = frame(spark, corpus(600)).withColumns({"row": F.lit("r"), "copies": F.lit(0)})
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.schema["text"] == docs.schema["text"]
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    assert {i: got.get(i, 0) for i in want} == want


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "a b c", "x"), (None, "d e", "x"), (2, "", "x"), (3, "a b", None), (3, "a b", None), (4, None, "empty")]
    got = mixing.mix(frame(spark, rows)).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 0, 2, 2, 2, 3]
    same = [r.taken for r in got if r.doc_id == 3]
    assert same[0] == same[1]
    assert all(r.taken == 0 for r in got if not r["size"])
    assert mixing.mix(frame(spark, [])).collect() == [] and mixing.mixed(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_one_document_over_the_budget(spark):
    rows = [(0, "w " * 100_000, "a")] + [(i, "x y", "b") for i in range(1, 50)] + [(i, "z", "c") for i in range(50, 60)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert sum(r.taken for r in got if r.source == "b") == 3 * 98 and sum(r.taken for r in got if r.source == "c") == 30
