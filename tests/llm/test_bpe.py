import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from entityhealth.llm import bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁▁a", "<s>", "</s><unk>x", "<0x0A>", "\n\n\t", "漢字かな交じり文。", "ａｂｃ", "é"]
ODD += ["​﻿", "😀👍🏽", "a" * 16, "ab" * 5, "0123456789" * 50, "=-" * 300, "\x00a\x00", "the" * 1000, " x", "ﬁ"]
ODD += ["x" * 5000, "!" * 3000, "a b  c   d    e     f", "Привет мир", "한국어 텍스트", "\U0010ffff"]
ODD += [" " * n for n in (7, 14, 15, 16, 17, 31, 100, 1000, 100_000)]
ODD += ["a" + " " * 700 + "b  c" * 400 + "\n" * 900, " a" * 600 + "  " * 600]


def test_odd_texts(library, model):
    assert bpe.count_tokens(ODD, model) == [len(x) for x in library.encode(ODD, num_threads=1)]
    assert bpe.count_tokens([None, ""], model) == [0, 0]


def test_random_texts(library, model):
    rnd = random.Random(7)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 60))) for _ in range(1000)]
    texts += ["".join(chr(rnd.choice((rnd.randrange(32, 127), rnd.randrange(160, 1280), 32, 0x1F600 + rnd.randrange(80)))) for _ in range(rnd.randrange(80))) for _ in range(1000)]
    texts += ["".join(rnd.choice("ab ▁\n") for _ in range(rnd.randrange(40))) for _ in range(1000)]
    assert bpe.count_tokens(texts, model) == [len(x) for x in library.encode(texts, num_threads=1)]


def test_words_are_forgotten_when_there_are_too_many(library, model, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    texts = [f"word{i} other{i % 7} thing" for i in range(200)]
    assert bpe.count_tokens(texts, model) == [len(x) for x in library.encode(texts, num_threads=1)]


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in bpe.count(docs, PATH).collect()}
    rows = docs.collect()
    want = [len(x) for x in library.encode([r.text or "" for r in rows], num_threads=1)]
    assert [got[r.doc_id].n_tokens for r in rows] == want
    assert all(got[r.doc_id].n_bytes == len((r.text or "").encode()) for r in rows)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got.values()) and any(r.over_limit for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None), (None, "a b"), (2, ""), (2, ""), (3, "é" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit("x"))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens > 0, r.over_limit) for r in bpe.count(docs, PATH).collect())
    assert got == [(0, 3, True, False), (1, 0, False, False), (2, 0, False, False), (2, 0, False, False), (3, 10000, True, True)]
    assert bpe.count(docs.limit(0), PATH).collect() == []
