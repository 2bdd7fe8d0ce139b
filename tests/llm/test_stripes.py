import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entityhealth.llm import stripes

SCHEMA = "doc_id bigint, lang string, source string, text string"


def brute(rows, least=30, top=50):
    """The report by definition, from (lang, source, text) rows."""
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        counts[lang, source].update(found)
        docs.update((lang, t) for t in set(found))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= least)

        def share(held):
            total = sum(held[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (held[t] + 5) // total for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in sources - {s}]
            own = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", own, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, t, f, i) for i, (t, f) in enumerate(items[:last], 1)}
    return out


def report(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def said():
    """Sources that share most words, one that repeats its own, rows without language, source or text."""
    rnd = np.random.default_rng(4)
    vocabulary = ["the", "THE", "of", "straße", "Élan", "élan", "naïve", "x1y", "don't", "日本", "ab_cd", *(f"w{chr(97 + i)}" for i in range(12))]
    rows = []
    for i in range(260):
        lang, source = ["en", "fr", None][i % 7 % 3], [f"s{i % 5}", None, "S", "é"][i % 11 % 4]
        words = rnd.choice(vocabulary, size=int(rnd.integers(0, 40)))
        rows.append((i, lang, source, "\n".join(words) + " -- " + "own " * (i % 5 == 1)))
    rows += [(900, "de", "a", "nur hier"), (901, "de", "b", None), (902, "de", None, ""), (903, "xx", "alone", "!? 12")]
    return rows + rows[:3] + [(None, "en", "s0", "the the the " * 50)]


def test_report_equals_brute_force(spark, said):
    docs = spark.createDataFrame(said, SCHEMA).withColumn("term", F.lit(1)).withColumn("rank", F.lit(2))
    want = brute([r[1:] for r in said], least=8, top=4)
    assert report(stripes.audit(docs.repartition(5), min_docs=8, top=4)) == want
    assert {r[4] for r in want if r[0] == "de"} == {0} and len({r[5] for r in want if r[2] == "term"}) == 4


def test_no_documents(spark):
    assert stripes.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_languages_in_several_units(spark, said, monkeypatch):
    """More stripes and sources than a unit holds give the same sums."""
    rows = [(i, "en", f"s{i % 9:02}", t) for i, (_, _, _, t) in enumerate(said)]
    members = pa.table(
        {"lang": ["en"] * 9, "source": [f"s{i:02}" for i in range(9)], "n": [0] * 9, "lang_n": [0] * 9, "terms": [0] * 9, "block": [1] * 9}
    )
    monkeypatch.setattr(stripes, "UNIT_SOURCES", 4)
    none = stripes._diverge(5, 50)(pa.table({"term": []}), members)
    assert sorted(zip(none["source"].to_pylist(), none["item"].to_pylist()))[0] == ("s04", "s05") and none.num_rows == 4 + 3 + 2 + 1
    monkeypatch.setattr(stripes, "UNIT_TERMS", 3)
    # Workers read the module anew; the driver's block count is what the unit sees.
    monkeypatch.setattr(stripes, "UNIT_SOURCES", 1024)
    assert report(stripes.audit(spark.createDataFrame(rows, SCHEMA), min_docs=8)) == brute([r[1:] for r in rows], least=8)


def test_blocks_of_sources_cover_every_pair_once(monkeypatch):
    names = [f"s{i}" for i in range(7)]
    held = pa.table(
        {
            "term": ["a", "b", "c"],
            "sources": pa.array([["s0", "s6"], ["s3"], names], pa.list_(pa.string())),
            "counts": pa.array([[4, 9], [1], list(range(1, 8))], pa.list_(pa.int64())),
        }
    )
    n = {s: sum(c for i in range(3) for x, c in zip(held["sources"][i].as_py(), held["counts"][i].as_py()) if x == s) for s in names}

    def units(blocks):
        out = []
        for block in range(blocks):
            members = pa.table({"lang": ["en"] * 7, "source": names, "n": [n[s] for s in names], "lang_n": [sum(n.values())] * 7, "terms": [3] * 7, "block": [block] * 7})
            out += stripes._diverge(5, 50)(held, members).to_pylist()
        return sorted(tuple(r.values()) for r in out)

    whole = units(1)
    monkeypatch.setattr(stripes, "UNIT_SOURCES", 3)
    monkeypatch.setattr(stripes, "UNIT_CELLS", 7)
    assert units(3) == whole and len([r for r in whole if r[1] == "pair"]) == 21


def test_spilled_stripes_merge_to_the_same(monkeypatch, said):
    batch = pa.record_batch(
        [pa.array([r[i] or "" for r in said], pa.string()) for i in (1, 2)] + [pa.array([(r[3] or "").encode() for r in said], pa.binary())],
        names=["lang", "source", "text"],
    )

    def folded():
        spilled = list(stripes._fold(iter([batch])))
        rows = pa.Table.from_batches(spilled).sort_by([("lang", "ascending"), ("term", "ascending")])
        out = pa.Table.from_batches(list(stripes._merge(iter(rows.to_batches(max_chunksize=3))))).to_pylist()
        assert len({(r["lang"], r["term"]) for r in out}) == len(out)
        return len(spilled), {(r["lang"], r["term"]): (r["docs"], dict(zip(r["sources"], r["counts"]))) for r in out}

    few, whole = folded()
    monkeypatch.setattr(stripes, "ENTRIES", 10)
    many, spilled = folded()
    assert many > 4 * few and spilled == whole


def test_long_texts_come_in_pieces_at_term_ends(monkeypatch):
    text = "Alpha beta, gamma " * 40 + "x" * 500
    whole = [t for piece in stripes.terms(text.encode()) for t in piece]
    monkeypatch.setattr(stripes, "PIECE", 7)
    pieces = list(stripes.terms(text.encode()))
    assert len(pieces) > 50 and [t for p in pieces for t in p] == whole == re.findall(rb"[a-z]+", text.lower().encode())


def test_shares_are_exact():
    counts = [0, 1, 5, 10**12 + 7, 8 * 10**13]
    totals = [3, 7, 10**12 + 1, 8 * 10**13 + 5]
    for t in totals:
        small = np.array([c for c in counts if c <= t], np.int64)
        assert stripes.shares(small, np.int64(t)).tolist() == [1 + 10**9 * int(c) // t for c in small]
