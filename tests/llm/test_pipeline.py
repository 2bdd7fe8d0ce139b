import hashlib
import re
from collections import Counter

import check_queries
import numpy as np
import pytest
from test_hostrules import brute as measure
from test_mixing import shares
from test_packing import brute_pieces
from test_secrets import brute as find_secrets
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from entityhealth.llm import hostrules, packing
from entityhealth.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def good(docs):
    """Rules per document, and host rates drawn to the mean by the fitted prior."""
    rated = []
    for d in docs:
        words, chars, symbols, dup, repeated = measure(d["text"])
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (d["text"] or "").split("\n"))
        base = words < 20 or 100 * repeated > 30 * words
        more = 100 * symbols > 10 * words or not 3 * words <= chars <= 10 * words or 100 * dup > 30 * lines
        rated.append((d, base, base or more))
    hosts = {}
    for d, _, failed in rated:
        n, bad = hosts.get(d["source"], (0, 0))
        hosts[d["source"]] = (n + 1, bad + failed)
    total, failing = len(rated), sum(f for _, _, f in rated)
    mean = failing / total
    spread = sum(n * (bad / n - mean) ** 2 for n, bad in hosts.values()) / total - mean * (1 - mean) * len(hosts) / total
    weight = min(1000, max(2, mean * (1 - mean) / spread - 1)) if spread > 0 else 1000
    rejected = {h for h, (n, bad) in hosts.items() if (bad + mean * weight) / (n + weight) > hostrules.HOST_LIMIT}
    return [d for d, base, failed in rated if not base and not (failed and d["source"] in rejected)]


def without_copies(docs):
    ids = [d["doc_id"] for d in docs]
    component = brute_components(ids, [brute_fingerprint(d["text"]) for d in docs], 2)
    return [d for d, c in zip(docs, component) if d["doc_id"] == c]


def without_secrets(docs):
    out = []
    for d in docs:
        at, clean = 0, ""
        for a, _, b in find_secrets(d["text"]):
            if a >= at:
                clean += d["text"][at:a] + "[secret]"
            at = max(at, b)
        text = clean + d["text"][at:]
        out.append(d | {"text": text, "n_chars": len(text) if at else d["n_chars"]})
    return out


def mix(docs):
    size = lambda d: len([w for w in re.split(r"[\x20\x09-\x0D]+", d["text"] or "") if w])
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += size(d)
    out = []
    for source, target in shares(dict(sizes)).items():
        rounds = int(target // sizes[source])
        budget, before = target - rounds * sizes[source], 0
        for d in sorted((d for d in docs if d["source"] == source), key=lambda d: md5(f"{d['doc_id']}:mix")):
            out += [d] * (rounds + (before + size(d) / 2 <= budget))
            before += size(d)
    return out


BRUTE = [good, without_copies, without_secrets, mix]


def bag(rows):
    return Counter(tuple(sorted(r.items())) for r in rows)


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    assert [len(corpus_pipeline.STAGES), len(BRUTE)] == [5, 4]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, BRUTE):
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        rows = brute(rows)
        assert bag(r.asDict() for r in out.collect()) == bag(rows), name
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    pieces = brute_pieces([(r["doc_id"], r["text"]) for r in rows], packing.MAX_LENGTH)
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in packed) == Counter(pieces)
    lengths = Counter(p[3] for p in pieces)
    ends = packing.bounds(list(lengths), list(lengths.values()), packing.BUCKETS)
    assert all(r.bucket == min(e for e in ends if e >= r.length) for r in packed)
    run = corpus_pipeline.run(spark, SF).collect()
    assert Counter(map(tuple, run)) == Counter(map(tuple, packed))


def test_stages_take_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", "s", None), (2, None, "en", "s", None)]
    rows += [(i, " ".join(f"w{i}x{k}" for k in range(30 + i)) + " password=abcdef12", None, None if i % 2 else "s", None) for i in range(3, 40)]
    rows += [(None, " ".join(f"v{k}" for k in range(50)), "de", "t", 7)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.schema.names == docs.schema.names
            table = out
        packed = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert packed.columns == ["doc_id", "piece", "start", "length", "bucket", "batch", "slot"]
        packed.collect()


def test_clean_documents_stay(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"word{i * 131 + k}" for k in range(60)), "en", f"s{i % 5}", 9) for i in range(200)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
    assert docs.count() == 200


def test_registration():
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    result = check_queries.compare(QUERIES[name](spark, SF), check_queries.connect(SF), ORACLES[name])
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_all_rows(spark, name):
    got = QUERIES[name](spark, SF)
    table = {"op2_page_text": "pages", "op7_nearest": None, "op6_packing": None}.get(name, "documents")
    assert got.count() > 0 and (table is None or got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count())
    assert np.isin([d for _, d in got.dtypes], ["bigint", "int", "string", "double", "boolean"]).all()
