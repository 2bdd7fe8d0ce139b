"""Text columns: trimming and keyword matching."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python strips: all white space of the Basic Multilingual Plane.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Remove every kind of surrounding whitespace, line ends included."""
    return F.btrim(text, F.lit(WHITESPACE))


def unify_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def normalize_key(key: Column) -> Column:
    """Keys compare without case and surrounding blanks."""
    return F.lower(strip(key))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True where the already lower-cased text contains one of the words; never NULL.

    One `contains` per literal word keeps the test inside generated code.
    """
    tests = [F.contains(text, F.lit(w.lower())) for w in words]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def keyword_flag(text: Column, words: Iterable[str]) -> Column:
    """True where the text contains one of the words in any case; NULL text gives False."""
    return contains_any(F.lower(text), words)


# The characters a word ends at.
WORD_BREAKS = " \t\n\x0b\x0c\r"


def word_text(text: Column) -> Column:
    """The text in lower case without word breaks at its end."""
    return F.rtrim(F.lower(text), F.lit(WORD_BREAKS))


def words(text: Column, prepared: Column) -> Column:
    """Words of a text, split at every single word break; `prepared` is its `word_text`.

    Two breaks in a row give an empty word; breaks at the end give none.
    """
    only_breaks = (F.length(prepared) == 0) & (F.length(text) > 0)
    return F.when(only_breaks, F.array().cast("array<string>")).otherwise(F.split(prepared, r"\s"))


def without(words_column: Column, stop_words: Iterable[str]) -> Column:
    """The words that are not in the list, in order."""
    stop = [w.lower() for w in stop_words]
    return F.filter(words_column, lambda w: ~w.isin(stop)) if stop else words_column
