"""Numeric columns: lenient casts, z-scores and order-independent means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What a number looks like. Other texts are not cast at all: a failing cast
# costs an exception, and columns with many gaps have many of them.
NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"


def to_number(text: Column, kind: str = "double") -> Column:
    """NULL where the text is no finite number.

    Whole numbers may be written with decimals (`3.0`), which are cut.
    """
    text = text.cast("string")
    if kind in ("double", "float"):
        return F.when(text.rlike(NUMBER), text.try_cast(kind))
    return F.when(text.rlike(WHOLE), text.try_cast(kind)).when(
        text.rlike(NUMBER), text.try_cast("double").try_cast(kind)
    )


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """NULL where the spread is zero or unknown."""
    return F.try_divide(value - mean, std)


def is_outlier(z: Column, limit: float) -> Column:
    """Strictly beyond the limit on either side; an unknown score is no outlier."""
    return F.coalesce(F.abs(z) > F.lit(limit), F.lit(False))


def sums(value: Column) -> dict[str, Column]:
    """What `half_up_mean` needs of a group, as aggregates that add up over parts of it.

    NULL and NaN are no values. `exact` leaves out what 18 digits before and 10
    after the point do not hold; `held` counts the others.
    """
    value = F.when(~F.isnan(value.cast("double")), value)
    exact = value.try_cast("decimal(28,10)")
    return {
        "exact": F.sum(exact),
        "rough": F.sum(value.cast("double")),
        "n": F.count(value),
        "held": F.count(exact),
    }


def half_up_mean(exact: Column, rough: Column, n: Column, held: Column, places: int = 2) -> Column:
    """The mean of a group from its `sums`, rounded half away from zero; NULL without values.

    Sums of doubles depend in the last digits on the order in which rows
    arrive, so a retried task could change a rounded report. Decimals add up the
    same in any order, and the quotient is rounded once, as whole numbers.
    Groups with values or sums that do not fit have the mean of doubles.
    """
    exact = exact.try_cast("decimal(33,10)")
    # 2 * 10^places * |sum| + n, divided by 2 n without a rest, is the rounded mean in units of the last place.
    doubled = F.abs(exact) * F.lit(2 * 10**places).cast(f"decimal({places + 1},0)") + n.cast("decimal(20,0)")
    units = F.floor(F.try_divide(doubled, (2 * n).cast("decimal(20,0)")))
    rounded = F.sign(exact.cast("double")) * units.cast("double") / 10.0**places
    mean = F.round(F.try_divide(rough, n.cast("double")), places)
    return F.when(held == n, F.coalesce(rounded, mean)).otherwise(mean)


def mean_half_up(value: Column, places: int = 2) -> Column:
    """The rounded mean of a group; see `half_up_mean`."""
    return half_up_mean(**sums(value), places=places)
