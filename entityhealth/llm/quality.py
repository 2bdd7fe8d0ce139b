"""Quality of texts by a factorisation machine of words, structure and metadata."""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_right
from collections import Counter
from math import log, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityhealth.llm import factorization

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Shares are told apart at these bounds; words weigh this much beside the statistics.
SHARES = (0.0, 0.003, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.55, 0.7, 0.85)
WORD_WEIGHT = 3.0

_SYMBOLS = re.compile(r"[#*$%&|<>!{}\[\]=_~^@+]+")
_DIGITS = re.compile(r"\d+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")


@functools.lru_cache(maxsize=1 << 18)
def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def _share(name: str, part: float, whole: float) -> str:
    return f"\x00{name}={bisect_right(SHARES, part / whole if whole else 0.0)}"


def _level(name: str, value: float) -> str:
    return f"\x00{name}~{min(40, int(2 * log(1 + value)))}"


def features(text: str, n_chars: int | None) -> dict[int, float]:
    """Hashed words with logarithmic counts on the unit sphere, and one feature per statistic and metadata field."""
    words = text.split()
    counts = Counter(words)
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = _SYMBOLS.findall(text)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in ".!?" for w in words)
    shouts = sum(map(len, _UPPER.findall(text)))
    said = [
        _level("words", n),
        _level("lines", len(lines)),
        _level("word length", sum(map(len, words)) / n if n else 0),
        _level("line length", n / len(lines) if lines else 0),
        _share("symbols", sum(map(len, symbols)), len(text)),
        _share("symbol runs", len(symbols), n),
        _share("digits", sum(map(len, _DIGITS.findall(text))), len(text)),
        _share("shouted", shouts, len(text)),
        _share("same word again", repeats, n),
        _share("distinct words", len(counts), n),
        _share("commonest word", max(counts.values(), default=0), n),
        _share("repeated lines", len(lines) - len(set(lines)), len(lines)),
        _share("line ends", sum(x.rstrip()[-1] in ".!?\"'" for x in lines), len(lines)),
        _share("sentences", ends, n),
        _level("length field", n_chars or 0),
        "\x00length field " + ("none" if n_chars is None else "right" if n_chars == len(text) else "wrong"),
    ]
    found = {_hash(s): 1.0 for s in said}
    norm = sqrt(sum((1 + log(c)) ** 2 for c in counts.values())) or 1.0
    for word, c in counts.items():
        # Spellings of one word add up.
        place = _hash(word.lower())
        found[place] = found.get(place, 0.0) + WORD_WEIGHT * (1 + log(c)) / norm
    return found


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str = "n_chars",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    fit_rows: int = factorization.FIT_ROWS,
) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row; a higher score is better text.

    The model learns from labels outside the held-out fold, from at most
    `fit_rows` of them. NULL is an empty text, which has a score like any other.
    Rows without id are not held out. Repeated rows come out as they went in.
    Without usable labels every score is 0.5. Other columns are not read.
    """

    def learn(doc_id):
        return factorization.fold(doc_id, FOLDS) != HELD_OUT

    model = factorization.fit(docs, labels, label_col, features, learn, id_col, text_col, length_col, fit_rows)
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(factorization.fold(docs[id_col], FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        factorization.score_column(model, features, docs[text_col], docs[length_col]).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
