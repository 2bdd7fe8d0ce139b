"""Toxicity of texts by a factorisation machine of terms and pairs of terms."""

from __future__ import annotations

import functools
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityhealth.llm import factorization

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
#: Lengths of the starts of terms that are features of their own.
STARTS = (3, 4, 5)

_TERM = re.compile(r"[^\W\d_]+")


@functools.lru_cache(maxsize=1 << 18)
def _hash(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass"))


def features(text: str, n_chars: int | None = None) -> dict[int, float]:
    """One feature per term, and per start of a term, that the text has.

    Starts tell inflected and compound forms of one word. One insult weighs as
    much in a long text as in a short one.
    """
    terms = set(_TERM.findall(text.lower()))
    starts = {f"^{t[:k]}" for k in STARTS for t in terms if len(t) > k}
    return dict.fromkeys(map(_hash, terms | starts), 1.0)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    fit_rows: int = factorization.FIT_ROWS,
) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row; a higher score is more toxic.

    The model learns from labels outside the held-out fold, from at most
    `fit_rows` of them. NULL is an empty text, which has a score like any other.
    Rows without id are not held out. Repeated rows come out as they went in.
    Without usable labels every score is 0.5. Other columns are not read.
    """

    def learn(doc_id):
        return factorization.fold(doc_id, FOLDS) != HELD_OUT

    model = factorization.fit(docs, labels, label_col, features, learn, id_col, text_col, None, fit_rows)
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(factorization.fold(docs[id_col], FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        factorization.score_column(model, features, docs[text_col], F.lit(None)).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
