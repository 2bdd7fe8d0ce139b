"""Secrets in texts, found with an index of trigrams.

Each rule is a regular expression. What its matches must contain becomes a
Boolean query over trigrams: an OR of ANDs. The index lists, for every trigram
that a query names, the lines of the text that hold it; the lists of an AND are
intersected, and only texts with a line left are searched with the expression.
The lists lie with the text they index, so neither has to be shuffled to meet
the other. A rule without mandatory trigrams searches all texts.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.llm.common import let

#: No more strings than this are spelt out for a part of an expression.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern` whose group `group` has `least` characters or more.

    Patterns must not match line ends: the index is by line.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base kinds, in the order of their ranks.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # Runs are maximal, so asking for 24 in the expression drops the same matches as counting them after it.
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# Well-known public formats beyond the base kinds.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE + MORE

Clauses = frozenset[frozenset[str]]


def _strings(op: object, value: object) -> list[str] | None:
    """All strings that a part of an expression can match, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return [chr(value)]
    if name == "IN":
        found = []
        for kind, x in value:
            if str(kind) == "LITERAL":
                found.append(chr(x))
            elif str(kind) == "RANGE" and x[1] - x[0] < MAX_STRINGS:
                found += map(chr, range(x[0], x[1] + 1))
            else:
                return None
        return found if len(found) <= 8 else None
    if name == "SUBPATTERN":
        return _joined([_strings(*x) for x in value[3]])
    if name == "BRANCH":
        ways = [_joined([_strings(*x) for x in way]) for way in value[1]]
        return None if None in ways else sorted({s for way in ways for s in way})
    if name == "MAX_REPEAT" and value[1] == 1:
        once = _joined([_strings(*x) for x in value[2]])
        return None if once is None else ([""] if value[0] == 0 else []) + once
    return None


def _joined(parts: list[list[str] | None]) -> list[str] | None:
    if any(p is None for p in parts):
        return None
    out = ["".join(x) for x in itertools.islice(itertools.product(*parts), MAX_STRINGS + 1)]
    return out if len(out) <= MAX_STRINGS else None


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _least(clauses: set[frozenset[str]]) -> Clauses:
    """Without clauses that contain another one."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def trigram_query(pattern: str) -> Clauses | None:
    """An OR of ANDs of trigrams, in lower case, that every match satisfies; None if there is none.

    The expression is cut where it can match too many strings. Every piece
    between cuts gives an OR over its strings; the pieces hold together.
    """
    pieces: list[list[str]] = [[""]]
    for part in re._parser.parse(pattern):
        found = _strings(*part)
        grown = None if found is None else _joined([pieces[-1], found])
        if grown is None:
            pieces.append([""] if found is None else found)
        else:
            pieces[-1] = grown
    queries = [_least({trigrams(s.lower()) for s in piece}) for piece in pieces]
    queries = [q for q in queries if frozenset() not in q]
    if not queries:
        return None
    both = {frozenset().union(*x) for x in itertools.product(*queries)}
    return _least(both)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _candidate_lines(low: Column, clauses: Clauses) -> Column:
    """Numbers of the lines that satisfy a query: the lists of each clause intersected."""

    def posting(lines: Column, trigram: str) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.contains(F.get(lines, i), F.lit(trigram)))

    def matched(lines: Column) -> Column:
        lists = []
        for clause in sorted(clauses, key=sorted):
            held = _all([F.contains(low, F.lit(t)) for t in sorted(clause)])
            both = reduce(F.array_intersect, [posting(lines, t) for t in sorted(clause)])
            lists.append(F.when(held, both).otherwise(F.array().cast("array<int>")))
        return reduce(F.array_union, lists)

    return let(F.split(low, "\n"), matched)


SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The matches that count, as start and end in code points.

    Cutting the text at the matches gives what lies between them; running sums
    of both lengths are the places.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("held"),
        F.split(text, rule.pattern, -1).alias("gap"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        stop = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("kind"), stop.alias("stop"))
        counts = F.char_length(x["held"]) >= rule.least
        grown = F.struct(stop.alias("at"), F.when(counts, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))
        return F.when(x["hit"].isNull(), acc).otherwise(grown)

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
    return F.aggregate(parts, zero, step, lambda acc: acc["out"])


def _found(docs: DataFrame, keep: list[Column], text: Column, rules: tuple[Rule, ...]) -> DataFrame:
    """`keep`, the text, and `spans` of all rules by start, then rank."""
    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("_low", F.lower("_text"))
    t, low, none = F.col("_text"), F.col("_low"), F.array().cast(SPANS)
    found = []
    for rank, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        if clauses is None:
            found.append(F.when(t.rlike(rule.pattern), _spans(t, rule, rank)).otherwise(none))
            continue
        held = _any([_all([F.contains(low, F.lit(x)) for x in sorted(c)]) for c in sorted(clauses, key=sorted)])
        lines = F.size(_candidate_lines(low, clauses)) > 0
        found.append(F.when(held, F.when(lines, _spans(t, rule, rank)).otherwise(none)).otherwise(none))
    return rows.withColumn("_spans", F.sort_array(F.concat(*found))).drop("_low")


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    said = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(said, ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row the number of secrets of each base kind, a digest of the base spans, and all spans.

    Matches of a kind do not overlap and are found from the left; kinds are
    searched on their own. Places count code points, ends are exclusive. NULL is
    an empty text, which has no spans; its digest is that of the empty string.
    Repeated rows and NULL ids come out as they went in. Other columns are not read.
    """
    spans = F.col("_spans")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == rank)).cast("bigint")

    counts = [count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(BASE)]
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return _found(docs, [docs[id_col].alias("doc_id")], docs[text_col], rules).select(
        "doc_id",
        *counts,
        F.sha2(_listed(base, rules).cast("binary"), 256).alias("base_sha256"),
        _listed(spans, rules).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with a mark in place of every secret, overlapping ones under one mark.

    `length_col`, where it exists, follows the changed texts. Rows without
    secrets, NULL texts among them, come back as they were.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    t, spans = F.col("_text"), F.col("_spans")

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.char_length(t)))
    )
    found = _found(docs, [row], docs[text_col], rules).withColumn("_clean", F.when(F.size(spans) > 0, clean))
    out = []
    for c in docs.columns:
        was = F.col("_row").getField(c)
        if c == text_col:
            was = F.coalesce("_clean", was)
        elif c == length_col:
            was = F.when(F.col("_clean").isNotNull(), F.char_length("_clean").cast("bigint")).otherwise(was)
        out.append(was.alias(c))
    return found.select(*out)
