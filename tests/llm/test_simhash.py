import itertools
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from entityhealth.llm import components, simhash

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(ids))]


def unsigned(n):
    return n & (1 << 64) - 1


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a B", "A b\tC", "ÀB c d É", "x y z " * 500, "w" * 5000])
def test_fingerprint_of_odd_texts(text):
    assert unsigned(simhash.fingerprint(text)) == brute_fingerprint(text)


def test_long_text_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "_CHUNK", 300)
    text = " ".join(str(i * i % 977) for i in range(2000))
    assert unsigned(simhash.fingerprint(text)) == brute_fingerprint(text)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in ids] == brute_components(ids, prints, 2)
    assert len(set(brute_components(ids, prints, 2))) < len(ids)


@pytest.mark.parametrize("radius,home,halo", [(0, 7, 5), (1, 7, 5), (2, 3, 4), (2, 2048, 16384), (3, 10, 1000)])
def test_links_connect_what_all_pairs_connect(spark, radius, home, halo):
    """Clouds around a few centres, one of them large, cut into many parts and groups."""
    rnd = random.Random(radius * 100 + home)
    prints = {0, (1 << 64) - 1}
    for centre, size in ((rnd.getrandbits(64), 250), (rnd.getrandbits(64), 30), (0xFF, 10)):
        for _ in range(size):
            p = centre
            for _ in range(rnd.randrange(4)):
                p ^= 1 << rnd.randrange(64)
            prints.add(p)
    prints |= {rnd.getrandbits(64) for _ in range(100)}
    prints = sorted(int(p) for p in prints)
    nodes = spark.createDataFrame([(int(np.array(p, np.uint64).view(np.int64)),) for p in prints], "fp bigint")
    found = simhash.links(nodes, radius, home, halo)
    assert all(bin(unsigned(r.a) ^ unsigned(r.b)).count("1") <= 60 for r in found.collect())
    rooted = {unsigned(r.node): unsigned(r.root) for r in components.roots(found).collect()}
    want = brute_components(list(range(len(prints))), prints, radius)
    group = {}
    for p, w in zip(prints, want):
        group.setdefault(rooted.get(p, p), set()).add(w)
    assert all(len(v) == 1 for v in group.values()) and len(group) == len(set(want))


@pytest.mark.parametrize("rows,most", [(10**5, 22), (10**8, 30), (10**9, 160)])
def test_copies_of_a_fingerprint(spark, rows, most):
    """Rows that units read per fingerprint, from the tiles of so many random ones; below 22 there are the tiles around alone."""
    share = [math.comb(16, k) / 2**16 for k in range(17)]
    tiles = [
        (sum((c + 5) << (5 * i) for i, c in enumerate(counts)), round(rows * math.prod(share[c] for c in counts)))
        for counts in itertools.product(range(17), repeat=4)
    ]
    sizes = spark.createDataFrame([t for t in tiles if t[1]], "tile bigint, n bigint")
    read = F.sum(F.expr("n * groups + around * parts")) / F.sum("n")
    assert 0 < simhash.tile_plan(sizes).agg(read).first()[0] < most


def test_chain_longer_than_a_tile(spark):
    chain = [(1 << i) - 1 for i in range(0, 63)]
    nodes = spark.createDataFrame([(c,) for c in chain], "fp bigint")
    out = simhash.classes(nodes, 1).collect()
    assert {r.root for r in out} == {0} and len(out) == 63


def test_odd_rows(spark):
    data = [(5, None, 1), (6, "", 2), (None, "a b c d", 3), (9, "a b c d", 4), (None, "lonely text of its own", 5), (9, "a b c d", 6), (None, None, 7)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, fp int").withColumn("component_id", F.lit("x"))
    out = simhash.near_duplicates(docs).collect()
    got = sorted(str((r.doc_id, r.fingerprint == "0" * 16, r.component_id)) for r in out)
    want = [(5, True, 5), (6, True, 5), (None, True, 5), (9, False, 9), (9, False, 9), (None, False, 9), (None, False, None)]
    assert got == sorted(map(str, want))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "lonely text of its own"), (5, ""), (9, "a b c d")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000 + rnd.randrange(60), 5000 + rnd.randrange(60)) for _ in range(40)]
    rnd.shuffle(links)
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo += near[x]
    assert got == {n: r for n, r in want.items() if n != r}
