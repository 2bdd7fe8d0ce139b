"""Training batches from length buckets whose bounds are optimal.

Sequences are padded to the bound of their bucket. The bounds come from the
histogram of all lengths by dynamic programming: no other choice of as many
bounds pads less. A batch holds as many sequences of a bucket as its token budget
allows; all batches of a bucket but the last are full.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.common import hash_key, key_range, n_words, settled

MAX_LENGTH = 4096
BUCKETS = 16
BUDGET = 65536
DIGITS = 3


def bounds(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """The bounds, at most `buckets` of them, that pad the sequences least; the last one is the largest length.

    best[j] is the least padding of the j shortest lengths; each further bucket
    ends at j and starts after some i, and all i are tried at once. Of equal
    choices the one with the earliest start is taken.
    """
    order = np.argsort(lengths)
    size, n = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    m = len(size)
    if not m:
        return []
    many, much = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    starts = []
    for _ in range(min(buckets, m)):
        grown, start = best.copy(), np.full(m + 1, -1)
        for j in range(1, m + 1):
            padding = best[:j] + size[j - 1] * (many[j] - many[:j]) - (much[j] - much[:j])
            i = int(padding.argmin())
            if padding[i] < grown[j]:
                grown[j], start[j] = padding[i], i
        best = grown
        starts.append(start)
    out, j = [], m
    for start in reversed(starts):
        if j and start[j] >= 0:
            out.append(int(size[j - 1]))
            j = int(start[j])
    return out[::-1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    seed: str = "pack",
) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `bucket`, `batch`, `slot` for every sequence.

    A token is a word. Documents longer than `max_length` are cut into pieces of
    that length and a rest; `start` is the first word of a piece. `bucket` is the
    length it is padded to, `batch` numbers the batches of a bucket from 0, `slot`
    the places in it. A batch has max(1, budget // bucket) places. NULL and empty
    texts have no sequence. Repeated rows are packed one by one; rows without id
    take their place by their text. Other columns are not read.

    The histogram has `max_length` rows at most, whatever the table; it alone
    reaches the driver. Places in a bucket come from counts per range of a random
    key, 16 ** DIGITS a bucket, and the order inside each range.
    """
    text, length = docs[text_col], F.least(F.col("size") - F.col("piece") * max_length, F.lit(max_length))
    sizes = docs.select(
        docs[id_col].alias("doc_id"), hash_key(docs[id_col], text, seed).alias("key"), n_words(text).alias("size")
    )
    last = F.floor((F.col("size") - 1) / max_length).cast("bigint")
    pieces = (
        sizes.where("size > 0")
        .select("doc_id", "key", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
        .select("doc_id", "piece", F.md5(F.concat_ws(":", "key", "piece")).alias("key"), length.alias("length"))
    )
    pieces = settled(pieces, "pieces")
    histogram = pieces.groupBy("length").count().collect()
    ends = bounds([r["length"] for r in histogram], [r["count"] for r in histogram], buckets)
    bucket = F.lit(None).cast("bigint")
    for end in reversed(ends):
        bucket = F.when(F.col("length") <= end, F.lit(end).cast("bigint")).otherwise(bucket)
    placed = pieces.withColumns({"bucket": bucket, "range": key_range(F.col("key"), DIGITS)})
    # buckets * 16 ** DIGITS rows at most, so it may be broadcast.
    held = placed.groupBy("bucket", "range").agg(F.count("*").alias("held"))
    along = Window.partitionBy("bucket").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("bucket", "range", F.coalesce(F.sum("held").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "range").orderBy("key", "doc_id", "piece")
    places = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket"))).cast("bigint")
    return (
        placed.withColumn("nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(before), ["bucket", "range"])
        .withColumns({"at": F.col("before") + F.col("nth"), "places": places})
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * max_length).alias("start"),
            "length",
            "bucket",
            F.floor(F.col("at") / F.col("places")).cast("bigint").alias("batch"),
            (F.col("at") % F.col("places")).alias("slot"),
        )
    )
