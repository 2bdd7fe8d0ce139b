"""Cleansing: conformance, lenient parsing, filling, simple filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityhealth.functions import dates, levels, numbers, text


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in order: cast, or typed NULL where missing."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def normalize_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: text.normalize_key(F.col(c)) for c in columns})


def parse_date_any(df: DataFrame, column: str, fmts: Sequence[str] = dates.DATE_FORMATS) -> DataFrame:
    """Dates in mixed layouts; rows without a readable date are dropped."""
    return df.withColumn(column, dates.parse_date_any(F.col(column), fmts)).where(F.col(column).isNotNull())


def cast_metrics(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast the columns that are present; a bad value becomes NULL."""
    types = dict(df.dtypes)
    texts = {c: numbers.to_number(F.col(c), k) for c, k in kinds.items() if types.get(c) == "string"}
    others = {c: F.col(c).try_cast(k) for c, k in kinds.items() if types.get(c, "string") != "string"}
    return df.withColumns({**texts, **others})


def coerce_numeric(df: DataFrame, column: str, kind: str = "double") -> DataFrame:
    """Numbers; rows without a readable number are dropped."""
    return cast_metrics(df, {column: kind}).where(F.col(column).isNotNull())


def fill_missing(df: DataFrame, columns: Iterable[str], value: float = 0) -> DataFrame:
    """Missing readings become `value`; column types stay."""
    return df.fillna(value, subset=list(columns))


def over_threshold(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(F.col(column) > limit)


def any_of(df: DataFrame, flags: Iterable[str]) -> DataFrame:
    """Rows with at least one flag set."""
    test: Column | None = None
    for f in flags:
        test = F.col(f) if test is None else test | F.col(f)
    return df if test is None else df.where(test)


def with_age(df: DataFrame, day: str = "date", birth_year: str = "birth_year", out: str = "age_at_log") -> DataFrame:
    return df.withColumn(out, dates.age_in_years(F.col(day), F.col(birth_year)))


def entity_slice(df: DataFrame, entity: str, value: object, day: str = "date") -> DataFrame:
    """The time-ordered rows of one entity; the filter reaches the scan.

    `value` may be a literal or a scalar subquery.
    """
    order = [day] + [c for c in df.columns if c not in (entity, day)]
    return df.where(F.col(entity) == value).orderBy(*order)


def explode_manifest(df: DataFrame, column: str = "manifest") -> DataFrame:
    """Map of name lists to `(kind, file)` rows; other columns are kept."""
    keep = [c for c in df.columns if c != column]
    kinds = df.select(*keep, F.explode(column).alias("kind", "files"))
    return kinds.select(*keep, "kind", F.explode("files").alias("file"))


def relabel(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Replace category texts; a text without a label stays."""
    return df.replace(dict(labels), subset=[column])


def melt_metrics(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """One row per metric."""
    return df.unpivot(list(ids), list(metrics), name, value)


def display_defaults(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns as text with `N/A` for missing values."""
    return df.withColumns({c: levels.or_na(F.col(c)) for c in columns})
