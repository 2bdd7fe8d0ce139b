"""A factorisation machine over hashed features, trained on a bounded sample.

The score of a text with features x is the logistic function of

    bias + sum(w_i x_i) + sum over pairs of <v_i, v_j> x_i x_j

The sum over pairs is half of (sum v_i x_i)^2 - sum (v_i x_i)^2, summed over the
factors, so it takes time linear in the number of features.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.llm.common import settled

#: Features of a text: hashes, and their values.
Features = Callable[[str, int | None], dict[int, float]]

#: Labelled rows that a model learns from, at most. Rows beyond it add little to a model of this size.
FIT_ROWS = 12_000
#: Hashes are taken modulo this; every feature of a text has a weight, however rare it is.
SPACE = 1 << 20
FACTORS = 8
#: A weight is not zero once its gradients add up to so many standard deviations of what chance gives, which
#: grows with the passes to this power; its pace from then on.
EVIDENCE = 3.0
GROWTH = 0.5
PACE = 2.0
#: Errors on the rarer class weigh this much.
RARER = 2.0
#: The factors of a term in so many texts move at half their rate, those of rarer terms the less the rarer they are.
TRUST = 1_000
#: Factors shorter than this part of the longest are zero in the last third of the passes.
KEPT = 0.2
#: Texts scored together.
BLOCK = 512


@dataclass
class Model:
    """Weights of the features whose hashes are in `keys`, in order; the last one stands for all others and is zero."""

    keys: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def __post_init__(self) -> None:
        told = np.flatnonzero((self.weights != 0) | self.factors.any(axis=1))
        self.told = dict(zip(self.keys[told].tolist(), told.tolist()))

    def rows(self, texts: list[dict[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, feature numbers and values; every text has a first feature of no weight, so none is empty."""
        starts, at, values = [], [], []
        for text in texts:
            # Features that meet in one place of the space are one feature.
            held: dict[int, float] = {len(self.keys): 0.0}
            for k, v in text.items():
                i = self.told.get(k & (SPACE - 1))
                if i is not None:
                    held[i] = held.get(i, 0.0) + v
            starts.append(len(at))
            at += held
            values += held.values()
        return np.array(starts, np.int64), np.array(at, np.int64), np.array(values)

    def score(self, texts: list[dict[int, float]]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(_sums(self, *self.rows(texts))[0], -30, 30)))


def _sums(model: Model, starts: np.ndarray, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What goes into the logistic function, and the sums of the weighted factors."""
    spread = model.factors[at] * values[:, None]
    both = np.add.reduceat(spread, starts, axis=0)
    squares = np.add.reduceat((spread * spread).sum(axis=1), starts)
    linear = np.add.reduceat(model.weights[at] * values, starts)
    return model.bias + linear + 0.5 * ((both * both).sum(axis=1) - squares), both


def _known(keys: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the features that have weights, after one that has none."""
    at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
    known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
    return np.concatenate([[len(keys)], at[known]]).astype(np.int64), np.concatenate([[0.0], values[known]])


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(h[0]) for h in held]
    at, values = (np.concatenate([h[k] for h in held]) for k in (0, 1))
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), at, values


def train(
    texts: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    factors: int = FACTORS,
    epochs: int = 12,
    batch: int = 128,
    rate: float = 0.02,
    factor_rate: float = 0.05,
    decay: float = 1e-3,
    seed: int = 7,
) -> Model:
    """A model of texts given as hashes and values. Without texts, or of one class only, it knows the share of the class.

    Weights and factors of all features learn together, from the error of the
    whole sum, so neither has to make up for the other afterwards. Weights follow
    the gradients summed over all texts ("follow the regularised leader"): chance
    moves many rare weights a little, so a weight is zero until its sum is larger
    than chance makes it. Factors have a step of their own for every entry and
    move the less the fewer texts have the term. Short factors, which differ from
    their random start by chance, become zero before the last passes, in which
    all others and the bias settle without them.
    """
    keys = np.unique(np.concatenate([t[0] for t in texts])) if texts else np.zeros(0, np.int64)
    rnd = np.random.default_rng(seed)
    share = min(0.999, max(0.001, float(labels.mean()))) if len(labels) else 0.5
    m = len(keys)
    model = Model(keys, float(np.log(share / (1 - share))), np.zeros(m + 1), np.zeros((m + 1, factors)))
    if not m or labels.min() == labels.max():
        return model
    held = [_known(keys, *t) for t in texts]
    sums, squares, chance, n_texts = (np.zeros(m + 1) for _ in range(4))
    for at, values in held:
        chance[at] += values * values
        n_texts[at] += 1
    chance = EVIDENCE * np.sqrt(chance * share * (1 - share))
    trust = n_texts / (n_texts + TRUST)
    # The feature that stands for unknown ones keeps weight and factors of zero.
    trust[m] = 0
    model.factors = rnd.normal(0, 0.02, (m + 1, factors)) * trust[:, None]
    moved = np.full_like(model.factors, 1e-8)
    importance = np.where((labels > 0) == (share < 0.5), RARER, 1.0)
    bias, step = [0.0, 0.0], 0
    for epoch in range(epochs):
        if epoch == epochs * 2 // 3:
            length = np.sqrt((model.factors**2).sum(axis=1))
            trust[length < KEPT * length.max()] = 0
            model.factors[trust == 0] = 0
        speed = 1 - epoch / epochs
        for rows in _batches(rnd, len(held), batch):
            starts, at, values = _joined([held[r] for r in rows])
            sizes = np.diff([*starts, len(at)])
            said, both = _sums(model, starts, at, values)
            off = (1 / (1 + np.exp(-np.clip(said, -30, 30))) - labels[rows]) * importance[rows]
            step, g = step + 1, float(off.mean())
            bias[:] = 0.9 * bias[0] + 0.1 * g, 0.999 * bias[1] + 0.001 * g * g
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            model.bias -= rate * speed * fix * bias[0] / (bias[1] ** 0.5 + 1e-8)

            used, place = np.unique(at, return_inverse=True)
            mine = np.repeat(off, sizes) * values
            g = np.bincount(place, weights=mine)
            grown = squares[used] + g * g
            sums[used] += g - (np.sqrt(grown) - np.sqrt(squares[used])) / PACE * model.weights[used]
            squares[used] = grown
            over = np.maximum(0, np.abs(sums[used]) - chance[used] * (epoch + 1) ** GROWTH)
            weights = -np.sign(sums[used]) * over * PACE / (1 + np.sqrt(grown))

            live = trust[used] > 0
            turn = np.repeat(both, sizes, axis=0) - model.factors[at] * values[:, None]
            grad = np.stack([np.bincount(place, weights=turn[:, f] * mine) for f in range(factors)], axis=1)[live]
            learnt = used[live]
            grad += decay * len(rows) * model.factors[learnt]
            moved[learnt] += grad * grad
            model.factors[learnt] -= factor_rate * speed * trust[learnt, None] * grad / np.sqrt(moved[learnt])
            model.weights[used] = weights
            model.weights[m] = 0
    return Model(keys, model.bias, model.weights, model.factors)


def _batches(rnd: np.random.Generator, n: int, batch: int) -> Iterator[np.ndarray]:
    order = rnd.permutation(n)
    for lo in range(0, n, batch):
        yield order[lo : lo + batch]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    features: Features,
    learn: Callable[[Column], Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    rows: int = FIT_ROWS,
) -> Model:
    """A model of at most `rows` labelled documents whose id `learn` allows, chosen by a hash of the id.

    The chosen ids are at most `rows`, so they are broadcast; the features of
    their texts are made where the texts lie, and one task trains on all of them.
    An id with several labels has the largest one. Rows without id or label are
    not learnt from; of rows with the same id one is.
    """
    named = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    named = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & learn(F.col("id")))
    chosen = named.groupBy("id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows)
    length = (docs[length_col] if length_col else F.lit(None)).cast("bigint")
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), length.alias("length"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_arrays(features(t, None if pd.isna(n) else int(n))) for t, n in zip(batch["text"], batch["length"])]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "label": batch["label"],
                    "hashes": [f[0].astype(np.int32) for f in found],
                    "vals": [f[1].astype(np.float32) for f in found],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, label int, hashes array<int>, vals array<float>"
    got = texts.join(F.broadcast(chosen), "id").mapInPandas(extract, schema).dropDuplicates(["id"])
    sample = settled(got.withColumn("label", (F.col("label") > 0).cast("int")), "sample")
    return _train_in_task(sample)


def _train_in_task(sample: DataFrame) -> Model:
    """The model of a bounded sample, trained in one task; only its weights reach the driver, SPACE of them at most."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, labels = [], []
        for batch in batches:
            held += [(np.array(h, np.int32), np.array(v, np.float32)) for h, v in zip(batch["hashes"], batch["vals"])]
            labels += batch["label"].tolist()
        model = train(held, np.array(labels, np.float64))
        # Features without weight and factors change no score.
        told = np.array([*model.told.values(), len(model.keys)], np.int64)
        weights, factors = model.weights[told].astype(np.float32), model.factors[told].astype(np.float32)
        parts = {"hashes": model.keys[told[:-1]].astype(np.int32), "weights": weights, "factors": factors}
        yield pd.DataFrame({"bias": [model.bias], **{k: [v.tobytes()] for k, v in parts.items()}})

    rows = sample.repartition(1).sortWithinPartitions("id").mapInPandas(
        learn, "bias double, hashes binary, weights binary, factors binary"
    )
    got = rows.collect()
    if not got:
        return train([], np.zeros(0))
    keys, weights, factors = (
        np.frombuffer(got[0][k], t) for k, t in (("hashes", np.int32), ("weights", np.float32), ("factors", np.float32))
    )
    return Model(keys, got[0]["bias"], weights, factors.reshape(len(weights), -1))


def _arrays(found: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in the space of the model, in order, and their values; features that meet in one are added."""
    keys = np.fromiter(found, np.int64, len(found)) & (SPACE - 1)
    hashes, place = np.unique(keys, return_inverse=True)
    return hashes, np.bincount(place, np.fromiter(found.values(), np.float64, len(found)), len(hashes))


def score_column(model: Model, features: Features, text: Column, length: Column) -> Column:
    """The score of every text. The model goes out with the function; its size is bounded by SPACE."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lengths in batches:
            out = []
            for lo in range(0, len(texts), BLOCK):
                pairs = zip(texts[lo : lo + BLOCK], lengths[lo : lo + BLOCK])
                out.append(model.score([features(t or "", None if pd.isna(n) else int(n)) for t, n in pairs]))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score(text, length.cast("bigint"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; NULL without id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts
