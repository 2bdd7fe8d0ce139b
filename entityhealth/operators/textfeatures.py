"""Text features: tokens, stop words, hashed TF-IDF, document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityhealth.functions.text import without, word_text, words
from entityhealth.session import written

# Vietnamese stop words.
STOP_WORDS = ("là", "và", "của", "có", "không", "những", "một", "rất", "này", "mà", "để", "ở", "với")
NUM_FEATURES = 1000


def tokens(df: DataFrame, text: str = "note_text", out: str = "words") -> DataFrame:
    """Lower-cased words split at single white space; rows without text are dropped."""
    prepared = df.where(F.col(text).isNotNull()).withColumn("_text", word_text(F.col(text)))
    return prepared.withColumn(out, words(F.col(text), F.col("_text"))).drop("_text")


def remove_stop_words(
    df: DataFrame, stop_words: Sequence[str] = STOP_WORDS, column: str = "words", out: str = "filtered_words"
) -> DataFrame:
    return df.withColumn(out, without(F.col(column), stop_words))


def hash_tf(
    df: DataFrame, column: str = "filtered_words", out: str = "raw_features", buckets: int = NUM_FEATURES
) -> DataFrame:
    return HashingTF(inputCol=column, outputCol=out, numFeatures=buckets).transform(df)


def tfidf(
    df: DataFrame,
    text: str = "note_text",
    stop_words: Sequence[str] = STOP_WORDS,
    buckets: int = NUM_FEATURES,
    out: str = "text_features",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Words, filtered words, hashed counts and their TF-IDF weights; with `keep`, only those columns and the weights.

    Weights need the counts of all texts first, so counted rows are written once:
    texts are split and hashed once. With `keep`, no texts and no words are written.
    """
    counted = hash_tf(remove_stop_words(tokens(df, text), stop_words), buckets=buckets)
    if keep is not None:
        counted = written(counted.select(*keep, "raw_features"), "counted")
        return IDF(inputCol="raw_features", outputCol=out).fit(counted).transform(counted).select(*keep, out)
    counted = written(counted, "counted")
    return IDF(inputCol="raw_features", outputCol=out).fit(counted).transform(counted)


def hashed_entries(
    df: DataFrame,
    ids: Sequence[str],
    text: str = "note_text",
    stop_words: Sequence[str] = STOP_WORDS,
    buckets: int = NUM_FEATURES,
) -> DataFrame:
    """`ids`, `bucket`, `count`, `weight`: the non-empty buckets of every text, with their TF-IDF weights.

    Only ids and hashed counts are written in between, no texts and no words.
    """
    words = remove_stop_words(tokens(df.select(*ids, text), text), stop_words)
    counted = written(hash_tf(words, buckets=buckets).select(*ids, "raw_features"), "counted")
    weighed = IDF(inputCol="raw_features", outputCol="_weights").fit(counted).transform(counted)
    pairs = F.arrays_zip(vector_to_array("raw_features").alias("count"), vector_to_array("_weights").alias("weight"))
    placed = weighed.select(*ids, F.posexplode(pairs).alias("bucket", "_entry")).where(F.col("_entry.count") > 0)
    return placed.select(*ids, "bucket", F.col("_entry.count").cast("bigint").alias("count"), F.col("_entry.weight").alias("weight"))


def document_frequencies(
    df: DataFrame, text: str = "note_text", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Per word: the number of texts with it and `ln((N+1)/(df+1))`.

    Repeats inside a text go before the shuffle, frequent words are counted per
    task first.
    """
    present = df.select(text).where(F.col(text).isNotNull())
    terms = tokens(present, text).select(F.explode(F.array_distinct("words")).alias("term"))
    terms = terms.where(~F.col("term").isin([w.lower() for w in stop_words]))
    total = present.agg(F.count("*").alias("n")).scalar()
    return (
        terms.groupBy("term")
        .agg(F.count("*").alias("doc_count"))
        .withColumn("idf", F.log((total + 1) / (F.col("doc_count") + 1)))
    )
