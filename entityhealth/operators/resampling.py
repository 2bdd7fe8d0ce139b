"""Bands of means by resampling, in one pass.

Drawing rows anew with replacement gives each of them a number of copies that is
close to a Poisson number with mean 1. These numbers follow here from a hash of
the row's key, so no row is drawn, nothing is kept in memory, and reruns agree.

Readings are shuffled, not their replicates: those of an entity and day meet in
one task, which adds up all replicates at once in arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityhealth.session import written

# 65536 times the distribution function of a Poisson number with mean 1, at 0 to 6.
POISSON = (24109, 48219, 60273, 64292, 65296, 65497, 65531)
#: Numbers in one MD5 hash, of four digits each.
PER_HASH = 8
#: How often a row is drawn, by its number.
COPIES = np.searchsorted(np.array(POISSON), np.arange(65536), side="right").astype(np.uint8)
#: A day with more readings than one task should hold is dealt over several tasks. At most REPORTED such days are dealt.
TASK_ROWS = 500_000
REPORTED = 10_000
TRACKED = 200_000
#: Readings whose replicates are at hand at a time.
SLICE = 5_000


def copies(names: Sequence[str], blocks: int) -> np.ndarray:
    """How often each row of these names is drawn, a column for each replicate of all blocks."""
    ends = [f":{b}".encode() for b in range(blocks)]
    digests = b"".join([hashlib.md5(name + end).digest() for name in (n.encode() for n in names) for end in ends])
    return COPIES[np.frombuffer(digests, ">u2")].reshape(len(names), blocks * PER_HASH)


def _middle(means: np.ndarray, drawn: np.ndarray, share: float) -> np.ndarray:
    """The quantile of each row's means, interpolated; `means` are sorted, and the first `drawn` of them count."""
    last = np.maximum(drawn - 1, 0)
    at = last * share
    below, above = np.floor(at).astype(np.int64), np.ceil(at).astype(np.int64)
    rows = np.arange(len(means))
    low, high = means[rows, below], means[rows, above]
    with np.errstate(invalid="ignore"):
        between = (above - at) * low + (at - below) * high
    return np.where((below == above) | (low == high), low, between)


def _bands(sums: np.ndarray, drawn: np.ndarray, shares: Sequence[float]) -> list[pa.Array]:
    """Quantiles of the replicates' means; a replicate that draws nothing has none."""
    with np.errstate(invalid="ignore", divide="ignore"):
        means = np.sort(np.where(drawn > 0, sums / drawn, np.nan), axis=1)
    n = (drawn > 0).sum(axis=1)
    return [pa.array(_middle(means, n, share), pa.float64(), mask=n == 0) for share in shares]


def _begins(columns: Sequence[pa.Array]) -> np.ndarray:
    """Where a row's values differ from those of the row before; NULLs are equal."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        out[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(out)


def _hot_days(df: DataFrame, on: Sequence[str], task_rows: int) -> dict[int, int]:
    """Hashes of the keys with more than `task_rows` rows and their parts, by a sketch of bounded size.

    Dealing a key into other parts changes no result.
    """
    keys = df.select(F.xxhash64(*on).alias("k"))
    top = keys.agg(F.expr(f"approx_top_k(k, {REPORTED}, {TRACKED})").alias("top")).first()["top"]
    return {t["item"]: -(-t["count"] // task_rows) for t in top or [] if t["count"] > task_rows}


def daily_mean_bootstrap(
    df: DataFrame,
    metric: str,
    key: Sequence[str],
    entity: str = "pet_id",
    day: str = "date",
    replicates: int = 200,
    level: float = 0.95,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """`entity`, `day`, `readings`, mean, low and high of a metric: the band holds the middle `level` of the replicates' means.

    `key` names a reading. `replicates` is rounded up to whole hashes. A replicate
    that draws no reading of a day has no mean there. A day of more than
    `task_rows` readings is dealt over tasks; sums of its parts, a row each, are
    added up in a second step.
    """
    blocks = -(-replicates // PER_HASH)
    n_sums = blocks * PER_HASH
    shares = ((1 - level) / 2, (1 + level) / 2)
    on = [entity, day]
    # The columns' own names may clash with those of the sums.
    name = F.concat_ws(":", *[F.col(c).cast("string") for c in key])
    rows = df.select(F.col(entity).alias("_entity"), F.col(day).alias("_day"), F.col(metric).cast("double").alias("_v"), name.alias("_key"))
    hot = _hot_days(df, on, task_rows)
    parts = F.lit(1)
    if hot:
        of_day = df.sparkSession.createDataFrame(list(hot.items()), "_hash bigint, _parts int")
        rows = rows.withColumn("_hash", F.xxhash64("_entity", "_day")).join(F.broadcast(of_day), "_hash", "left").drop("_hash")
        parts = F.coalesce("_parts", F.lit(1))
    rows = rows.select("_entity", "_day", (parts > 1).alias("_hot"), F.pmod(F.monotonically_increasing_id(), parts).cast("int").alias("_part"), "_v", "_key")
    own = ["_entity", "_day", "_hot", "_part"]
    met = rows.repartition(*[F.col(c) for c in own]).sortWithinPartitions(*own)

    fields = [T.StructField(o, rows.schema[o].dataType) for o in own[:3]]
    numbers = [T.StructField("_rows", T.LongType()), T.StructField("_known", T.LongType()), T.StructField("_sum", T.DoubleType())]
    bands = [T.StructField(c, T.DoubleType()) for c in ("_low", "_high")]
    lists = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_sums", "_drawn")]

    def finish(keys: pa.RecordBatch, sums: np.ndarray, drawn: np.ndarray, plain: np.ndarray) -> pa.RecordBatch:
        """Bands of whole days, sums of the parts of others."""
        hot_rows = keys.column("_hot").to_numpy(zero_copy_only=False)
        kept = np.where(hot_rows, n_sums, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32))
        out = [pa.ListArray.from_arrays(offsets, pa.array(x[hot_rows].ravel().astype(np.float64))) for x in (sums, drawn)]
        counts = [pa.array(plain[:, 0].astype(np.int64)), pa.array(plain[:, 1].astype(np.int64)), pa.array(plain[:, 2])]
        names = [f.name for f in (*fields, *numbers, *bands, *lists)]
        return pa.RecordBatch.from_arrays([*[keys.column(c) for c in own[:3]], *counts, *_bands(sums, drawn, shares), *out], names=names)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                b = whole.slice(start, SLICE)
                v = b.column("_v").to_numpy(zero_copy_only=False)
                known = b.column("_v").is_valid().to_numpy(zero_copy_only=False)
                w = copies(b.column("_key").to_pylist(), blocks) * known[:, None]
                v = np.where(known, v, 0.0)
                at = _begins([b.column(c) for c in own])
                keys = b.select(own).take(pa.array(at))
                with np.errstate(invalid="ignore"):
                    sums = np.add.reduceat(w * v[:, None], at, axis=0)
                drawn = np.add.reduceat(w.astype(np.int64), at, axis=0)
                plain = np.add.reduceat(np.stack([np.ones(len(v)), known, v], axis=1), at, axis=0)
                if held and len(_begins([pa.concat_arrays([held[0].column(c), keys.column(c).slice(0, 1)]) for c in own])) == 1:
                    for mine, theirs in zip((sums, drawn, plain), held[1:]):
                        mine[0] += theirs[0]
                elif held:
                    yield finish(*held)
                # The last day may go on in the next rows.
                if len(at) > 1:
                    yield finish(keys.slice(0, len(at) - 1), sums[:-1], drawn[:-1], plain[:-1])
                held = (keys.slice(len(at) - 1), sums[-1:].copy(), drawn[-1:].copy(), plain[-1:].copy())
        if held:
            yield finish(*held)

    done = met.mapInArrow(draw, T.StructType([*fields, *numbers, *bands, *lists]))
    named = [F.col("_entity").alias(entity), F.col("_day").alias(day)]
    mean = F.try_divide("_sum", "_known")
    result = [*named, F.col("_rows").alias("readings"), mean.alias(f"{metric}_mean"), F.col("_low").alias(f"{metric}_low"), F.col("_high").alias(f"{metric}_high")]
    if not hot:
        return done.select(*result)
    done = written(done, "bands")
    pairs = F.posexplode(F.arrays_zip("_sums", "_drawn")).alias("_i", "_pair")
    dealt = done.where("_hot").select("_entity", "_day", "_rows", "_known", "_sum", pairs)
    summed = dealt.groupBy("_entity", "_day", "_i").agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_known", "_sum")], F.try_divide(F.sum("_pair._sums"), F.sum("_pair._drawn")).alias("_m")
    )
    quantiles = [F.percentile("_m", F.lit(share)).alias(c) for share, c in zip(shares, ("_low", "_high"))]
    merged = summed.groupBy("_entity", "_day").agg(*[F.max(c).alias(c) for c in ("_rows", "_known", "_sum")], *quantiles)
    return done.where("NOT _hot").select(*result).unionByName(merged.select(*result))
