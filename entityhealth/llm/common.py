"""Columns and tables that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityhealth.session import written

#: Rows written to the shared folder: what made them runs once, and lost executors do not lose them.
settled = written

# A word is a run of characters other than these six.
WORD_BREAKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, in order; none for a NULL text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that tell rows apart; only rows with the same id and the same text share them."""
    said = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text.isNull().cast("string"), text)
    return F.unhex(F.md5(said))


def hash_key(doc_id: Column, text: Column, seed: str = "") -> Column:
    """A hexadecimal key that is as good as random and the same on every run; rows without id take it from the text."""
    base = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.md5(F.concat(base, F.lit(f":{seed}")))


def key_range(key: Column, digits: int = 3) -> Column:
    """The range of equal width that a hexadecimal key falls into: 16 ** digits of them, of like size."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")
