import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityhealth.llm import codes

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, rounds=2):
    """Code, error and label error by definition, in Python numbers, for vectors of one length."""
    fine = [(i, [math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256 for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(fine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    parts = codes.split(len(fine[0][1]))
    books = [[r[1][p] for r in order[:64]] for p in parts]

    def nearest(j, v):
        x = v[parts[j]]
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[j]))[::-1]

    for _ in range(rounds):
        for j in range(16):
            own = {}
            for _, v, _ in fine:
                own.setdefault(nearest(j, v)[0], []).append(v[parts[j]])
            books[j] = [[sum(c) // len(own[n]) for c in zip(*own[n])] if n in own else e for n, e in enumerate(books[j])]
    out, by_label = [], {}
    for i, v, y in fine:
        found = [nearest(j, v) for j in range(16)]
        error = sum(f for _, f in found)
        by_label[y] = by_label.get(y, 0) + error
        out.append((i, "".join(f"{n:02x}" for n, _ in found), error, y))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    top = 2**63 - 1
    return sorted(((i, c, min(top, e), min(top, by_label[y]), sha) for i, c, e, y in out), key=str)


def coded(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, length, seed=0, scale=1.0):
    rnd = np.random.default_rng(seed)
    # Few values, so that ties between entries are common.
    return [(int(i), [float(x) for x in np.round(rnd.normal(size=length) * 3) / 64 * scale], [None, 1, 2][i % 3]) for i in rnd.permutation(n)]


def test_equals_brute_force(spark):
    rows = vectors(300, 32)
    rows += rows[:5] + [(400, None, 1), (401, [1.0] * 31 + [None], 1), (402, [float("nan")] * 32, 2), (403, [float("inf")] * 32, 2), (None, [0.5] * 32, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).repartition(4)
    assert coded(codes.compress(df)) == brute(rows)


def test_fewer_rows_than_entries_and_no_rows(spark):
    rows = vectors(9, 16)
    got = coded(codes.compress(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and {r[2] for r in got} == {0}
    assert coded(codes.compress(spark.createDataFrame([], SCHEMA))) == []


def test_each_length_has_its_own_codebooks(spark):
    long, odd = vectors(90, 32, 1), [(i + 1000, v, y) for i, v, y in vectors(80, 20, 2)]
    empty = [(2000, [], 1)]
    got = coded(codes.compress(spark.createDataFrame(long + odd + empty, SCHEMA)))
    want = [r[:3] + r[4:] for rows in (long, odd, empty) for r in brute(rows)]
    assert [r[:3] + r[4:] for r in got] == sorted(want, key=str)
    sums = {}
    for i, _, error, label_error, _ in got:
        y = next(y for x, _, y in long + odd + empty if x == i)
        sums.setdefault(y, []).append((error, label_error))
    assert all({e for _, e in s} == {sum(e for e, _ in s)} for s in sums.values())


@pytest.mark.parametrize("scale", [1e5, 1e9, 1e30, 1e300])
def test_large_components_stay_exact(spark, scale):
    rows = vectors(100, 16, 3, scale) + [(500 + i, v, y) for i, v, y in vectors(40, 16, 4)]
    assert coded(codes.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_active_entries_give_what_a_whole_scan_gives():
    rnd = np.random.default_rng(5)
    for trial in range(40):
        points = rnd.integers(-4, 5, size=(200, 3)).astype(float)
        old = rnd.integers(-4, 5, size=(12, 3)).astype(float)
        new, moved = old.copy(), rnd.random(12) < [0, 0.2, 0.5, 1][trial % 4]
        new[moved] += rnd.integers(-2, 3, size=(int(moved.sum()), 3))
        moved = (new != old).any(axis=1)
        code, held, _ = codes.assign(points, old)
        got = codes.assign(points, new, moved, code, held)
        want = codes.assign(points, new)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
        lost = moved[code].sum()
        assert got[2] == lost * 12 + (200 - lost) * moved.sum() <= want[2]


def test_limbs_add_up():
    for value in (0, -1, 2**40, -(2**90) + 5, 10**40):
        assert sum(x << (codes.LIMB * i) for i, x in enumerate(codes._limbs(value))) == value
        assert all(abs(x) < 2**codes.LIMB for x in codes._limbs(value))
