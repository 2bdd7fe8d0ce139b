"""Owner notes: blocks of text behind header lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityhealth.functions.dates import parse_date
from entityhealth.functions.text import strip, unify_newlines

# How a note block starts.
BLOCK_MARKER = "# Pet ID:"
ID_PATTERN = r"pet\d+"
HEADER = r"(?i)^\s*({id}) - Notes on (\d{{4}}-\d{{2}}-\d{{2}})\r?$"


def read_note_blocks(
    spark: SparkSession, path: str, marker: str = BLOCK_MARKER, id_pattern: str = ID_PATTERN
) -> DataFrame:
    """`(pet_id, date, note_text)` from files of note blocks.

    The marker is the record separator, so Spark splits large files between
    blocks and no file has to fit into one task. Only the first line of a block
    goes through the regular expression, however long the note is. Blocks
    without a valid header are dropped.
    """
    blocks = spark.read.text(path, lineSep=marker)
    return parse_note_blocks(blocks, id_pattern)


def parse_note_blocks(blocks: DataFrame, id_pattern: str = ID_PATTERN) -> DataFrame:
    head = F.substring_index("value", "\n", 1)
    parts = blocks.withColumn("head", head).where(F.col("head").rlike(HEADER.format(id=id_pattern)))
    # A block that ends with its header line has no line end and is no note.
    parts = parts.where(F.length("head") < F.length("value"))
    return parts.select(
        F.lower(F.regexp_extract("head", HEADER.format(id=id_pattern), 1)).alias("pet_id"),
        parse_date(F.regexp_extract("head", HEADER.format(id=id_pattern), 2)).alias("date"),
        strip(unify_newlines(F.substr("value", F.length("head") + 2))).alias("note_text"),
    )


def format_note_blocks(notes: DataFrame, marker: str = BLOCK_MARKER) -> DataFrame:
    """The inverse: one text value per note, ready for `write.text`."""
    return notes.select(
        F.concat(
            F.lit(marker + " "),
            F.col("pet_id"),
            F.lit(" - Notes on "),
            F.date_format("date", "yyyy-MM-dd"),
            F.lit("\n"),
            F.col("note_text"),
            F.lit("\n"),
        ).alias("value")
    )
