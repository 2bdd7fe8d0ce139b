"""From raw documents to training batches: five operators, each on all that the one before it kept.

Every stage takes an empty table, NULL in any column, empty and very long texts,
repeated rows and further columns of any name; what becomes of them is said at
the stage. An empty table gives an empty one, with the same columns but for the
last stage, which returns sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entityhealth.llm import hostrules, mixing, packing, secrets, simhash
from entityhealth.llm.common import settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, or their host's verdict, reject go.

    NULL and empty texts have no words and go. A NULL source is a host of its own. Repeated rows are judged alike.
    """
    return hostrules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Texts without words are one group. A row without id stays only where its
    group has none with one; rows with the same id and text are one row.
    """
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes. NULL and empty texts, and repeated rows, come back as they were."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the sources' weights give.

    A NULL source is the last source. Rows with the same id are taken together, rows without id are ordered by their text.
    """
    return mixing.mixed(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and the place of every sequence.

    NULL and empty texts have no sequence, long ones several; repeated rows are packed one by one.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: Fingerprints and the choice of bucket bounds have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
