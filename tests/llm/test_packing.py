import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from entityhealth.llm import packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(8))
def test_bounds_pad_least(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randrange(1, 15) for _ in range(rnd.randrange(1, 60))]
    counts = Counter(lengths)
    for k in range(1, 5):
        got = packing.bounds(list(counts), list(counts.values()), k)
        assert got == sorted(set(got)) and len(got) <= k and got[-1] == max(lengths)
        best = min(
            padding(lengths, [*some, max(lengths)]) for some in itertools.combinations_with_replacement(sorted(counts), k - 1)
        )
        assert padding(lengths, got) == best


def test_bounds_of_odd_histograms():
    assert packing.bounds([], [], 4) == []
    assert packing.bounds([7], [10**12], 4) == [7]
    assert packing.bounds([3, 1, 2], [1, 1, 1], 10) == [1, 2, 3]
    assert packing.bounds(range(1, 4097), [10**9] * 4096, 2) == [2048, 4096]


def brute_pieces(rows, most):
    out = []
    for i, text in rows:
        n = len((text or "").split())
        out += [(i, p, p * most, min(most, n - p * most)) for p in range(-(-n // most))]
    return out


@pytest.mark.parametrize("budget", [1, 64, 1000])
def test_every_sequence_is_packed_once(spark, budget):
    rnd = random.Random(budget)
    rows = [(i, "w " * rnd.choice((0, 1, 2, 5, 9, 30, 31, 100, 450))) for i in range(700)]
    rows += [(None, "a b c"), (None, "d"), (5, None), (9, ""), (6, rows[6][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"bucket": F.lit("x"), "size": F.lit(0)})
    got = packing.pack(docs, max_length=100, buckets=4, budget=budget).collect()
    pieces = brute_pieces(rows, 100)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length) for r in got), key=key) == sorted(pieces, key=key)
    ends = sorted({r.bucket for r in got})
    counts = Counter(p[3] for p in pieces)
    assert padding([p[3] for p in pieces], ends) == padding(
        [p[3] for p in pieces], packing.bounds(list(counts), list(counts.values()), 4)
    )
    batches = defaultdict(list)
    for r in got:
        assert r.bucket == min(e for e in ends if e >= r.length)
        batches[r.bucket, r.batch].append(r.slot)
    for (end, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, budget // end)
    for end in ends:
        numbers = sorted(b for e, b in batches if e == end)
        assert numbers == list(range(len(numbers)))
        assert all(len(batches[end, b]) == max(1, budget // end) for b in numbers[:-1])


def test_rerun_and_partitions_do_not_matter(spark, rows):
    docs = spark.createDataFrame([(i, "w " * (i % 37)) for i in range(400)], "doc_id bigint, text string")
    assert rows(packing.pack(docs, buckets=3)) == rows(packing.pack(docs.repartition(7), buckets=3))


def test_tables_without_sequences(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    assert packing.pack(spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")).collect() == []
