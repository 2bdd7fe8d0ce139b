"""Quality rules per document, and a verdict per host that its documents share.

A single odd document says little about its host; a host most of whose documents
break rules says something about the rest of them. The share of failing
documents of a host is drawn towards the share of the whole table by a beta
prior that is fitted to all hosts, so that a host with three documents is not
judged by them alone. On a host whose drawn rate is above the limit only
documents that break no rule stay; elsewhere only the base rules decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.llm.common import let, settled, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rules that only count against a host: symbols per 100 words, letters per word, repeated lines per 100.
MAX_SYMBOL_PERCENT = 10
WORD_LENGTHS = (3, 10)
MAX_DUP_LINE_PERCENT = 30
#: A host is bad above this rate; the prior weighs as much as so many documents.
HOST_LIMIT = 0.5
PRIOR_WEIGHTS = (2.0, 1000.0)


def _repeat_words(w: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more, each word once.

    Windows are compared by hash. Most texts repeat none, which a set of the
    hashes shows; only the others are sorted.
    """

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(z: Column) -> Column:
            twice = F.filter(z, lambda s, i: (F.get(z, i - 1)["h"] == s["h"]) | (F.get(z, i + 1)["h"] == s["h"]))
            return F.sort_array(F.transform(twice, lambda s: s["i"]))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(ranked, starts), covered)
        )

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])
        )

    hashes = let(F.transform(w, lambda x: F.xxhash64(x)), windows)
    return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(hashes, repeated)).cast("bigint")


def measures(text: Column) -> list[Column]:
    """What the rules look at; a NULL text has no words and no lines."""
    text = F.coalesce(text, F.lit(""))
    of_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    symbols = F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint")
    return [of_words.alias("w"), symbols.alias("n_symbols"), of_lines.alias("l")]


MEASURES = {
    "n_words": "w.n_words",
    "word_chars": "w.word_chars",
    "n_symbols": "n_symbols",
    "n_dup_lines": "l.n_dup_lines",
    "n_repeat_words": "w.n_repeat_words",
}


def base_failed() -> Column:
    n = F.col("w.n_words")
    return (n < MIN_WORDS) | (100 * F.col("w.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def any_failed() -> Column:
    n = F.col("w.n_words")
    low, high = WORD_LENGTHS
    return (
        base_failed()
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n)
        | (F.col("w.word_chars") < low * n)
        | (F.col("w.word_chars") > high * n)
        | (100 * F.col("l.n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("l.n_lines"))
    )


def host_verdicts(rated: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """`host`, `bad_host` for every host, from rows of `host` and `failed`.

    The prior has the mean of all documents; its weight is what the spread of
    the hosts' rates leaves after the spread that chance explains, within
    PRIOR_WEIGHTS. Documents without a host are a host of their own. One row
    per host and task is shuffled; three sums reach the driver.
    """
    hosts = settled(
        rated.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("bigint")).alias("bad")), "hosts"
    )
    n, bad, n_hosts = hosts.agg(F.sum("n"), F.sum("bad"), F.count("*")).first()
    if not n:
        return hosts.select("host", F.lit(False).alias("bad_host"))
    mean = bad / n
    gap = F.col("bad") / F.col("n") - F.lit(mean)
    spread = hosts.agg(F.sum(F.col("n") * gap * gap)).first()[0] / n - mean * (1 - mean) * n_hosts / n
    least, most = PRIOR_WEIGHTS
    weight = min(most, max(least, mean * (1 - mean) / spread - 1)) if spread > 0 else most
    rate = (F.col("bad") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return settled(hosts.select("host", (rate > limit).alias("bad_host")), "verdicts")


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """The measures of every row, `base_failed`, `bad_host` and `kept`.

    Rows with fewer than MIN_WORDS words, or over MAX_REPEAT_PERCENT of the words in
    repeated windows, fail; so do rows that break any rule on a bad host. NULL and
    empty texts have no words and fail. Repeated rows are judged, and counted for
    their host, one by one. NULL ids and hosts are kept as they are. Other columns
    are not read. Texts are read once and not shuffled: the measures are written to
    the shared folder, and the verdicts, a row per host, are joined to them.
    """
    rated = settled(
        docs.select(docs[id_col].alias("doc_id"), docs[host_col].alias("host"), *measures(docs[text_col])).select(
            "doc_id",
            "host",
            *[F.col(path).alias(name) for name, path in MEASURES.items()],
            base_failed().alias("base_failed"),
            any_failed().alias("failed"),
        ),
        "measures",
    )
    verdicts = host_verdicts(rated, limit).withColumnRenamed("host", "judged")
    joined = rated.join(verdicts, rated["host"].eqNullSafe(verdicts["judged"]), "left")
    return joined.select(
        "doc_id",
        *MEASURES,
        "base_failed",
        (~F.col("base_failed") & ~(F.col("bad_host") & F.col("failed"))).alias("kept"),
        "bad_host",
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """The rows that `judge` keeps, all columns as they were.

    The first pass over the texts rates the hosts, the second decides, so no text is shuffled.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    of = [docs[host_col].alias("host"), *measures(docs[text_col])]
    rated = docs.select(*of).select("host", any_failed().alias("failed"))
    verdicts = host_verdicts(rated, limit).where("bad_host").select(F.col("host").alias("judged"), "bad_host")
    # 0: the base rules fail, 1: another rule does, 2: none. The test needs both sides of the join, so it
    # cannot move below it, where the measures would be taken once for the test and once for the row.
    grade = F.when(base_failed(), 0).when(any_failed(), 1).otherwise(2)
    seen = docs.select(row, *of).select("row", "host", grade.alias("grade"))
    joined = seen.join(verdicts, seen["host"].eqNullSafe(verdicts["judged"]), "left")
    return joined.where(F.col("grade") > F.when(F.col("bad_host"), 1).otherwise(0)).select("row.*")
