"""Text features of notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from entityhealth.operators import keywords, textfeatures

STOP_WORDS = ("the", "of", "and", "is", "la", "de", "der", "was")
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("text").alias("note_text"))


@query(
    "tokens",
    r"SELECT doc_id, CAST(len(string_split_regex(lower(text), '\s')) AS INTEGER) AS n_tokens FROM documents",
)
def tokens(spark, sf):
    return textfeatures.tokens(_documents(spark, sf)).select("doc_id", F.size("words").alias("n_tokens"))


@query(
    "stopword_counts",
    rf"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens,
      CAST(len([x for x in w if NOT list_contains({STOP_SQL}, x)]) AS INTEGER) AS n_kept
    FROM (SELECT doc_id, string_split_regex(lower(text), '\s') AS w FROM documents)""",
)
def stopword_counts(spark, sf):
    words = textfeatures.tokens(_documents(spark, sf))
    return textfeatures.remove_stop_words(words, STOP_WORDS).select(
        "doc_id", F.size("words").alias("n_tokens"), F.size("filtered_words").alias("n_kept")
    )


@query(
    "tfidf_terms",
    rf"""WITH words AS (
      SELECT doc_id, unnest(list_distinct(string_split_regex(lower(text), '\s'))) AS term FROM documents
    ) SELECT term, count(*) AS doc_count,
      round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)), 9) AS idf
    FROM words WHERE NOT list_contains({STOP_SQL}, term) GROUP BY term""",
)
def tfidf_terms(spark, sf):
    """Document frequency and weight of every word of the whole texts."""
    out = textfeatures.document_frequencies(_documents(spark, sf), stop_words=STOP_WORDS)
    return out.withColumn("idf", F.round("idf", 9))


@query("tfidf_hashed")
def tfidf_hashed(spark, sf):
    """The non-empty buckets of every text's hashed TF-IDF vector: how many words fall there and what they weigh.

    The library's hash has no SQL; tests hold the entries against counting by hand.
    """
    return textfeatures.hashed_entries(_documents(spark, sf), ["doc_id"], stop_words=STOP_WORDS)


@query(
    "keyword_tables",
    """WITH keywords AS (
      SELECT DISTINCT doc_id % 4 AS category, lower(substr(text, 1 + 10 * i, 12)) AS keyword FROM documents, range(40) t(i)
      WHERE length(text) >= 12 + 10 * i)
    SELECT doc_id, category, count(*) AS n_keywords FROM documents JOIN keywords ON contains(lower(text), keyword)
    GROUP BY doc_id, category""",
)
def keyword_tables(spark, sf):
    """Keywords of four categories, some 10 for every text of the table, each looked for in all texts."""
    docs = _documents(spark, sf)
    at = F.explode(F.sequence(F.lit(0), F.lit(39))).alias("_i")
    # The keywords lie in the first 402 characters; a row for each need not carry the whole text.
    cut = docs.select("doc_id", F.substring("note_text", 1, 402).alias("note_text")).select("doc_id", "note_text", at).where(F.length("note_text") >= 12 + 10 * F.col("_i"))
    table = cut.select((F.col("doc_id") % 4).alias("category"), F.substring("note_text", 1 + 10 * F.col("_i"), 12).alias("keyword"))
    return keywords.keyword_counts(docs, ["doc_id"], "note_text", table)
