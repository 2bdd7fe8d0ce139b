"""Alert levels: score to level, level to code, class and colour, prediction to band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityhealth import rules as R


def alert_level(score: Column, red: Column | int, orange: Column | int, yellow: Column | int = 1) -> Column:
    """First band that fits, from the most severe down."""
    out = F.when(score >= red, R.RED).when(score >= orange, R.ORANGE).when(score >= yellow, R.YELLOW)
    return out.otherwise(R.GREEN)


def level_code(level: Column, default: float = 0.0) -> Column:
    """Severity 3, 2, 1, 0; `default` for a level that is unknown or missing."""
    out = None
    for text, code in R.LEVEL_CODES.items():
        out = F.when(level == text, float(code)) if out is None else out.when(level == text, float(code))
    return out.otherwise(F.lit(float(default)))


def level_class(level: Column) -> Column:
    """Display class of a level text; NULL for any other text."""
    out = None
    for word, name in R.LEVEL_CLASSES:
        out = F.when(level.contains(word), name) if out is None else out.when(level.contains(word), name)
    return out


def level_colour(level: Column) -> Column:
    out = None
    for text, colour in R.LEVEL_COLOURS.items():
        out = F.when(level == text, colour) if out is None else out.when(level == text, colour)
    return out


def prediction_band(prediction: Column) -> Column:
    """Display class of a predicted code; NULL (shown as N/A) stays without one."""
    out = None
    for least, name in R.PREDICTION_BANDS:
        out = F.when(prediction >= least, name) if out is None else out.when(prediction >= least, name)
    return out.when(prediction.isNotNull(), "text-green")


def or_na(value: Column) -> Column:
    """The value as text, `N/A` where it is missing."""
    return F.coalesce(value.cast("string"), F.lit("N/A"))
