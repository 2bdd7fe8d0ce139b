"""Quantiles over any range of days, merged from sketches of single days.

Exact quantiles (`ranks`) read every value again. Where a bounded error of the
rank will do, a day's values are kept as one small sketch per group; any days'
sketches merge at read, so a report costs as many rows as there are days and
groups in it, and a change of some days costs those days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. A returned value's rank is off by more than 0.35 % of the values in one of a hundred cases.
SKETCH_SIZE = 800
#: What tests hold the error of a rank against, as a share of the values.
RANK_ERROR = 0.01


def quantile_parts(df: DataFrame, keys: Sequence[str], value: str, day: str = "date", size: int = SKETCH_SIZE) -> DataFrame:
    """`n`, `least`, `most` and `sketch` of the values per day and group.

    NULL and NaN do not count; days and groups without another value have no
    row. A NULL key is a group, a NULL day a day. A sketch has a few times
    `size` values at most, however many the day has, and all of them where the
    day has no more than that.
    """
    v = F.col(value).cast("double")
    return (
        df.where(v.isNotNull() & ~F.isnan(v))
        .groupBy(day, *keys)
        .agg(
            F.count("*").alias("n"),
            F.min(v).alias("least"),
            F.max(v).alias("most"),
            F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"),
        )
    )


def quantiles_of_parts(
    parts: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str], size: int = SKETCH_SIZE
) -> DataFrame:
    """`n`, `least`, `most` and a column per quantile for every group, over the days whose parts are given.

    Counts and extremes are exact. Each quantile is a value that occurs and whose rank is
    within `RANK_ERROR` of the wanted one; sketches drop values by chance, so
    reruns may give another value inside that bound. No parts give no rows.
    """
    merged = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("_sketch"),
    )
    found = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(n) for p, n in zip(probs, names)]
    return merged.select(*keys, "n", "least", "most", *found)
