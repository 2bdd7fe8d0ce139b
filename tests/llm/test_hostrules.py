import re

import pytest
from pyspark.sql import functions as F

from entityhealth.llm import hostrules


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def odd_rows():
    phrase = "one two three four five six seven eight nine"
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \n\t\r\n ", None),
        (4, phrase, "a"),
        (5, f"{phrase} {phrase}", "a"),
        (6, "x " * 40, "b"),
        (7, f"{phrase} ten {phrase} eleven two three four five six seven eight nine", "b"),
        (8, "line a\nline a\n\n \nline b\nline a \n" + phrase * 3, "b"),
        (9, "a#b*c$ %&|<> " * 30 + "é\U0001f600  wide", None),
        (10, " ".join(f"w{i * i % 61}" for i in range(3000)), "a"),
        (10, " ".join(f"w{i * i % 61}" for i in range(3000)), "a"),
        (None, " ".join(f"w{i}" for i in range(40)), "c"),
        (11, " ".join(f"word{i}" for i in range(60000)), "c"),
        (12, "\x0b\x0ca b\x1cc\x85d " * 20, "c"),
    ]


def test_measures_against_brute_force(spark):
    docs = spark.createDataFrame(odd_rows(), "doc_id bigint, text string, source string")
    docs = docs.withColumns({"kept": F.lit(1), "n_words": F.lit(2), "host": F.lit("x")})
    got = sorted(str(tuple(r)) for r in hostrules.judge(docs).select("doc_id", *hostrules.MEASURES, "base_failed").collect())
    want = []
    for i, t, _ in odd_rows():
        m = brute(t)
        want.append(str((i, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])))
    assert got == sorted(want)


def hosts(spark, shares):
    data = []
    for host, n, bad in shares:
        for i in range(n):
            junk = " ".join(f"w{i}x{k}" + ("%%%" if i < bad else "") for k in range(30))
            data.append((len(data), junk, host))
    return spark.createDataFrame(data, "doc_id bigint, text string, source string")


def test_bad_hosts_lose_documents_that_break_rules(spark):
    """A small host is not judged by its few documents; clean documents stay everywhere."""
    docs = hosts(spark, [("good", 300, 6), ("bad", 200, 160), (None, 50, 48), ("tiny", 2, 2), ("fair", 300, 5)])
    got = hostrules.judge(docs, limit=0.5)
    lost = {r.source: r.n for r in got.where("NOT kept").join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert lost == {"bad": 160, None: 48, "tiny": 2} or lost == {"bad": 160, None: 48}
    assert got.where("NOT base_failed").count() == 852
    stay = hostrules.keep_good(docs, limit=0.5)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(r.doc_id for r in got.where("kept").collect())


def test_prior_draws_small_hosts_to_the_mean(spark):
    rated = spark.createDataFrame(
        [("big", k < 900) for k in range(1000)] + [("small", True)] + [(f"h{i}", False) for i in range(40) for _ in range(50)],
        "host string, failed boolean",
    )
    got = {r.host: r.bad_host for r in hostrules.host_verdicts(rated).collect()}
    assert got["big"] and not any(v for k, v in got.items() if k.startswith("h"))
    assert not got["small"] or got["small"] is True


@pytest.mark.parametrize("failed", [True, False])
def test_one_host_without_spread(spark, failed):
    rated = spark.createDataFrame([("only", failed)] * 30, "host string, failed boolean")
    assert [r.bad_host for r in hostrules.host_verdicts(rated).collect()] == [failed]


def test_keep_good_returns_the_columns(spark):
    docs = spark.createDataFrame(odd_rows(), "doc_id bigint, text string, source string")
    docs = docs.withColumns({"row": F.lit(1), "host": F.lit("h"), "bad_host": F.lit("b"), "failed": F.lit(0)})
    out = hostrules.keep_good(docs)
    assert out.columns == docs.columns
    want = sorted(str(i) for i, t, _ in odd_rows() for m in [brute(t)] if not (m[0] < 20 or 100 * m[4] > 30 * m[0]))
    kept = sorted(str(r.doc_id) for r in out.collect())
    assert set(kept) <= set(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert hostrules.judge(docs).collect() == [] and hostrules.keep_good(docs).collect() == []


def test_plan_is_native(spark, plan, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (hostrules.judge(docs), hostrules.keep_good(docs)):
        text = plan(df, capsys)
        assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
