"""Date columns. Every parser returns NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts the lenient parser tries, in this order, and what
# a text of the layout looks like. A text of another shape is not parsed at
# all, because a failing parse costs an exception.
SHAPES = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "dd-MM-yyyy": r"^\d{2}-\d{2}-\d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
}
DATE_FORMATS = tuple(SHAPES)
# Layouts Spark casts without a formatter.
CASTS = {"yyyy-MM-dd": "date", "yyyy-MM-dd HH:mm:ss": "timestamp_ntz"}


def _parse(text: Column, fmt: str, kind: str) -> Column:
    parsed = text.try_cast(CASTS[fmt]) if fmt in CASTS else F.try_to_timestamp(text, F.lit(fmt))
    parsed = parsed.cast(kind)
    return F.when(text.rlike(SHAPES[fmt]), parsed) if fmt in SHAPES else parsed


def parse_timestamp(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Wall-clock time, without a time zone."""
    return _parse(text, fmt, "timestamp_ntz")


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return _parse(text, fmt, "date")


def parse_date_any(text: Column, fmts: Sequence[str] = DATE_FORMATS) -> Column:
    """The first layout that fits."""
    return F.coalesce(*[parse_date(text, f) for f in fmts])


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def iso_year(day: Column) -> Column:
    """The year the ISO week belongs to, so that weeks of two years never mix."""
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def age_in_years(day: Column, birth_year: Column) -> Column:
    return F.year(day) - birth_year
