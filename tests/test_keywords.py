import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from entityhealth.operators import keywords


def by_hand(texts, table):
    words = {(w.lower(), c) for w, c in table if w}
    return {(i, c, n) for i, t in texts if t is not None for c in {c for _, c in words} if (n := sum(w in t.lower() for w, x in words if x == c))}


def test_counts_equal_searching_every_word(spark, plan, capsys):
    rnd = random.Random(6)
    letters = "abcdeé ABČ日"
    texts = [(i, "".join(rnd.choices(letters, k=rnd.randrange(0, 90)))) for i in range(150)] + [(200, None), (201, ""), (202, "the the"), (203, "😀a😀b")]
    table = [("".join(rnd.choices(letters, k=rnd.randrange(1, 7))), f"c{i % 3}") for i in range(400)]
    table += [(None, "c1"), ("", "c2"), ("the ", "c1"), ("THE", "c1"), ("the", "c2"), ("😀b", "c2"), ("x" * 40, "c0")]
    docs = spark.createDataFrame(texts, "id int, note string").withColumn("word", F.lit("clash"))
    given = spark.createDataFrame(table, "keyword string, category string")
    out = keywords.keyword_counts(docs, ["id"], "note", given)
    assert {tuple(r) for r in out.collect()} == by_hand(texts, table)
    text = plan(out, capsys)
    assert not [w for w in ("Cartesian", "NestedLoop", "EvalPython", "InPandas") if w in text]
    none = keywords.keyword_counts(docs, ["id"], "note", given.limit(0))
    assert none.columns == ["id", "category", "n_keywords"] and none.collect() == []
    assert keywords.keyword_counts(docs.limit(0), ["id"], "note", given).collect() == []


def test_every_place_of_a_long_text_is_cut(spark):
    text = "".join(random.Random(1).choices("abé日", k=1500))
    for sizes in ([4], [1, 3]):
        got = sorted(r.piece for r in keywords.cut(spark.createDataFrame([(text,), ("ab",), ("",), (None,)], "t string"), "t", sizes).collect())
        assert got == sorted(t[i : i + n] for t in (text, "ab") for n in sizes for i in range(len(t) - n + 1))


def test_words_are_filed_under_their_rarest_piece(spark):
    docs = spark.createDataFrame([("common commons",), ("commonly",), ("rarest",)], "t string")
    words = spark.createDataFrame([("commonzz",), ("com",), ("rarest common",)], "word string")
    filed = {r.word: (r.piece, r["size"]) for r in keywords.file_keywords(words, docs, "t", [3, 8]).collect()}
    assert filed["commonzz"] == ("commonzz", 8)
    assert filed["com"] == ("com", 3) and " common" not in filed["rarest common"][0]


def test_texts_of_the_same_id_count_as_one_and_collisions_are_told_apart(spark, monkeypatch):
    texts = [(1, "abcabc"), (1, "ABC d"), (1, "abcabc"), (2, "xyz"), (None, "abc"), (3, None)]
    docs = spark.createDataFrame(texts, "id int, note string")
    table = spark.createDataFrame([("abc", 1), ("abc", 2), ("c d", 1), ("abc", None), ("zzz", 1)], "keyword string, category int")
    want = {(1, 1, 2), (1, 2, 1), (1, None, 1)}
    assert {tuple(r) for r in keywords.keyword_counts(docs, ["id"], "note", table).collect()} == want
    chunk = keywords._Chunk(4)
    monkeypatch.setattr(keywords, "_mixed", lambda h: h * np.uint64(0))
    points, ends = keywords._code_points(pa.array(["abca", "bcab", "caa\0"]))
    chunk.add(points, ends, np.array([0, 1, 1]), [2], np.full(1 << (keywords.FILTER_BITS - 3), 255, np.uint8))
    found = {(r["word"], d) for t in chunk.found for r in t.to_pylist() for d in r["docs"]}
    assert found == {("ab", 0), ("bc", 0), ("ca", 0), ("bc", 1), ("ca", 1), ("ab", 1), ("aa", 1), ("a\0", 1)}


def test_windows_that_are_no_keyword_are_not_shuffled(spark):
    """Before, every place of every text was a row of the shuffle."""
    rnd = random.Random(3)
    docs = spark.createDataFrame([(i, "".join(rnd.choices("abcdefghijklmnop", k=4000))) for i in range(40)], "id int, note string")
    words = docs.selectExpr("id % 2 AS category", "substring(note, 100, 12) AS keyword")
    marked = keywords._marked(words, "keyword")
    texts = docs.selectExpr("id", "array(note) AS _texts")
    packed = keywords.pack_windows(texts, ["id"], [12], keywords._filter(marked), 2).where("kind = 'words'").collect()
    found = [r for p in packed for r in keywords._table(p["data"]).to_pylist()]
    assert {r["word"] for r in found} >= {r.keyword for r in words.collect()} and len(found) < 100
    assert sum(len(p["data"]) for p in packed) < 40 * 4000 / 10
    counted = keywords.keyword_counts(docs, ["id"], "note", words).collect()
    assert sorted(map(tuple, counted)) == [(i, i % 2, 1) for i in range(40)]


def everything(power):
    return np.full(1 << (power - 3), 255, np.uint8)


def test_keywords_of_many_texts_are_counted_with_the_texts(spark):
    """Before, every text sent each of its keywords through the shuffle."""
    rnd = random.Random(9)
    common = ["".join(rnd.choices("abcdefgh", k=12)) for _ in range(30)]
    texts = [(i, " ".join(rnd.sample(common, 20)) + f" own keyword {i:06}", i % 3) for i in range(300)]
    docs = spark.createDataFrame(texts, "id int, note string, c int")
    given = [(w, c) for k, w in enumerate(common) for c in {None if k % 5 == 0 else k % 4, 3}] + [(f"keyword {i:06}", 1) for i in range(300)]
    table = spark.createDataFrame(given, "keyword string, category int")
    marked = keywords._marked(table, "keyword")
    bits = keywords._filter(marked)
    known = keywords._frequent(docs, ["id"], "note", marked, [12, 14], bits, "keyword", "category")
    packed = keywords.pack_windows(docs.selectExpr("id", "array(note) AS _texts"), ["id"], [12, 14], bits, 2, known)
    found = [r for p in packed.where("kind = 'words'").collect() for r in keywords._table(p["data"]).to_pylist()]
    assert len(known.hashes) == 30 and not {r["word"] for r in found} & set(common)
    assert 300 <= sum(len(r["docs"]) for r in found) < 600
    want = {(i, c, n) for i, t, _ in texts for c in (None, 0, 1, 2, 3) if (n := sum(w in t for w, x in given if x == c))}
    assert {tuple(r) for r in keywords.keyword_counts(docs, ["id"], "note", table).collect()} == want


def test_windows_are_those_of_each_text_whatever_is_hashed_at_a_time(monkeypatch):
    texts = pa.array(["", "abcab", "日本語", "a", "x😀y" * 9, "", "zz"])
    points, ends = keywords._code_points(texts.slice(1))
    assert bytes(points).decode("utf-32-le") == "".join(texts.to_pylist()) and ends.tolist() == [0, 5, 8, 9, 36, 36, 38]
    for at_a_time in (1, 4, 1 << 16):
        monkeypatch.setattr(keywords, "HASHED_CHARS", at_a_time)
        for size, at, h, owner in keywords._windows(points, ends, [1, 3, 5, 26], everything(16)):
            want = [(i, t[k : k + size]) for i, t in enumerate(texts.slice(1).to_pylist()) for k in range(len(t) - size + 1)]
            assert list(zip(owner.tolist(), keywords._strings(points, at, size).to_pylist())) == want
            assert (h == keywords._hashes(pa.array([w for _, w in want]))).all()


def test_a_known_word_is_told_by_its_letters(monkeypatch):
    rows = pa.table({"word": ["ab", "cd", "ab", "abc"], "category": pa.array(["x", None, "y", "x"])})
    points, ends = keywords._code_points(pa.array(["abcd", "cdab"]))

    def named(known):
        return {(known.find(points, at, h, size) >= 0).sum().item() for size, at, h, _ in keywords._windows(points, ends, [2], everything(16))}

    known = keywords._Known.of(rows, "word", "category")
    assert len(known.hashes) == 3 and named(known) == {4}
    owner, code, n = known.counts(np.repeat(np.arange(3), 2), np.zeros(6, np.int64))
    assert {(known.categories[c].as_py(), k) for c, k in zip(code.tolist(), n.tolist())} == {("x", 2), ("y", 1), (None, 1)}
    monkeypatch.setattr(keywords, "_mixed", lambda h: h * np.uint64(0))
    assert named(keywords._Known.of(rows, "word", "category")) == {2}
    assert named(keywords._Known.of(rows.slice(0, 0), "word", "category")) == {0}


def test_the_most_frequent_rows_fit_the_table(spark, monkeypatch):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate([9, 9, 5, 5, 5, 2])], "k int, n bigint")
    for most, want in ((6, 6), (5, 5), (4, 2), (1, 0)):
        monkeypatch.setattr(keywords, "KNOWN_ROWS", most)
        assert keywords._most_often(rows).count() == want


def test_keyword_tables_cuts_whole_keywords_only(spark, tmp_path):
    from catalog.text import keyword_tables

    rnd = random.Random(2)
    texts = [(i, "".join(rnd.choices("abé日😀", k=n))) for i, n in enumerate([0, 11, 12, 21, 22, 401, 402, 403, 900])] + [(40, None)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    table = [(t[10 * k : 10 * k + 12], i % 4) for i, t in texts if t for k in range(40) if len(t) >= 12 + 10 * k]
    assert {tuple(r) for r in keyword_tables(spark, str(tmp_path)).collect()} == by_hand(texts, table)
