"""Rule scoring of entity-days in a single projection.

Baselines, points and keywords become literals of one CASE per metric. All
categories are scored in one pass over one scan, without a join, a shuffle or
Python code; the category filter reaches the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.functions.levels import alert_level
from entityhealth.functions.numbers import is_outlier
from entityhealth.functions.text import contains_any
from entityhealth.rules import DEFAULT_RULES, CategoryRules, RuleSet


def _per_category(
    rules: RuleSet, category: str, pick: Callable[[CategoryRules], Column | None], default: Column
) -> Column:
    out: Column | None = None
    for c in rules.categories:
        value = pick(c)
        if value is not None:
            is_category = F.col(category) == c.category
            out = F.when(is_category, value) if out is None else out.when(is_category, value)
    return default if out is None else out.otherwise(default)


def rule_zscores(df: DataFrame, rules: RuleSet = DEFAULT_RULES, category: str = "species") -> DataFrame:
    """Distance of every metric from its category baseline, in spreads.

    NULL for a metric without a baseline in that category.
    """

    def z(column: str, name: str) -> Callable[[CategoryRules], Column | None]:
        def pick(c: CategoryRules) -> Column | None:
            b = c.baselines.get(name)
            return (F.col(column) - F.lit(float(b.mean))) / F.lit(float(b.std)) if b else None

        return pick

    missing = F.lit(None).cast("double")
    return df.withColumns(
        {m.zscore: _per_category(rules, category, z(m.column, m.name), missing) for m in rules.metrics}
    )


def rule_flags(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return df.withColumns({m.flag: is_outlier(F.col(m.zscore), rules.z_limit) for m in rules.metrics})


def hit_column(signal: str, position: int) -> str:
    """Name of the column `annotate_notes` adds for a signal and a category position."""
    return f"_hit_{signal}_{position}"


def annotate_notes(notes: DataFrame, rules: RuleSet = DEFAULT_RULES, note: str = "note_text") -> DataFrame:
    """Keyword tests on the notes themselves, a flag per signal and category.

    Done before notes are joined to readings, each text is searched once and
    does not travel through the shuffle unless a report shows it.
    """
    lowered = notes.withColumn("_lower", F.lower(note))
    hits = {
        hit_column(s.name, i): contains_any(F.col("_lower"), c.keywords.get(s.name, ()))
        for s in rules.signals
        for i, c in enumerate(rules.categories)
    }
    return lowered.withColumns(hits).drop("_lower")


def keyword_flags(
    df: DataFrame, rules: RuleSet = DEFAULT_RULES, category: str = "species", note: str = "note_text"
) -> DataFrame:
    """A never-NULL flag per note signal, by the keyword list of the row's category."""
    no = F.lit(False)
    annotated = hit_column(rules.signals[0].name, 0) in df.columns if rules.signals else False
    if annotated:
        out = {}
        for s in rules.signals:
            hits = {c.category: F.col(hit_column(s.name, i)) for i, c in enumerate(rules.categories)}
            chosen = _per_category(rules, category, lambda c, hits=hits: hits[c.category], no)
            out[s.flag] = F.coalesce(chosen, no)
        hit_columns = [hit_column(s.name, i) for s in rules.signals for i, _ in enumerate(rules.categories)]
        return df.withColumns(out).drop(*hit_columns)
    if note not in df.columns:
        return df.withColumns({s.flag: no for s in rules.signals})
    lowered = df.withColumn("_lower", F.lower(note))
    out = {}
    for s in rules.signals:
        out[s.flag] = _per_category(
            rules, category, lambda c, s=s: contains_any(F.col("_lower"), c.keywords.get(s.name, ())), no
        )
    return lowered.withColumns(out).drop("_lower")


def risk_score(df: DataFrame, rules: RuleSet = DEFAULT_RULES, category: str = "species") -> DataFrame:
    """Sum of the points of all set flags, as int."""

    def points(name: str) -> Column:
        return _per_category(rules, category, lambda c: F.lit(int(c.points.get(name, 0))), F.lit(0))

    parts = [(m.flag, m.name) for m in rules.metrics] + [(s.flag, s.name) for s in rules.signals]
    terms = [F.when(F.col(flag), points(name)).otherwise(F.lit(0)) for flag, name in parts]
    return df.withColumn("risk_score", reduce(lambda a, b: a + b, terms).cast("int"))


def risk_level(df: DataFrame, rules: RuleSet = DEFAULT_RULES, category: str = "species") -> DataFrame:
    def bound(name: str) -> Column:
        return _per_category(rules, category, lambda c: F.lit(int(getattr(c, name))), F.lit(None).cast("int"))

    return df.withColumn(
        "health_alert_level", alert_level(F.col("risk_score"), bound("red"), bound("orange"), bound("yellow"))
    )


def score(
    df: DataFrame,
    rules: RuleSet = DEFAULT_RULES,
    category: str = "species",
    note: str = "note_text",
    missing: str = "zero",
) -> DataFrame:
    """Readings with z-scores, flags, risk score and alert level.

    Rows of a category outside the rule set drop out. `missing='zero'` counts a
    missing reading as 0, `missing='ignore'` leaves it NULL and scores nothing.
    """
    if missing not in ("zero", "ignore"):
        raise ValueError("missing is 'zero' or 'ignore'")
    known = df.where(F.col(category).isin([c.category for c in rules.categories]))
    if missing == "zero":
        known = known.fillna(0, subset=[m.column for m in rules.metrics])
    scored = keyword_flags(rule_flags(rule_zscores(known, rules, category), rules), rules, category, note)
    return risk_level(risk_score(scored, rules, category), rules, category)


def alerts(scored: DataFrame) -> DataFrame:
    """Only the rows that got points."""
    return scored.where(F.col("risk_score") > 0)


def alert_order(
    df: DataFrame, entity: str = "pet_id", day: str = "date", tie: Sequence[str] | None = None
) -> list[Column]:
    """Newest and most severe first, then by entity and `tie`.

    Without `tie` a hash of the row makes the order total. Whole rows are no
    sort key: the bounds of a global sort are samples of the key, which would
    bring note texts to the driver.
    """
    last = [F.col(c) for c in tie] if tie is not None else [F.xxhash64(*df.columns)]
    return [F.col(day).desc(), F.col("risk_score").desc(), F.col(entity), *last]


def alert_report(
    scored: DataFrame,
    columns: Sequence[str],
    entity: str = "pet_id",
    day: str = "date",
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with points, in report columns and report order."""
    report = alerts(scored).select(*columns)
    return report.orderBy(*alert_order(report, entity, day, tie))


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Bag union; columns match by name and a missing one is filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
