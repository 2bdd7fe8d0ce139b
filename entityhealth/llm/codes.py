"""Vectors as short codes: a codebook per part of the vector, fitted by Lloyd's rounds over active entries.

Components become whole numbers, so all distances and sums are exact and do not
depend on the order of rows. Between rounds every part keeps its entry and its
exact distance. A part whose entry did not move compares only the entries that
did with that distance; only the others are compared with the whole codebook.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.common import settled

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Rows compared at once.
STEP = 2048
#: Whole sums leave a task in limbs of this many bits, so that no sum is too large for its column.
LIMB = 40
LONGEST = 2**63 - 1
#: Groups in which the smallest ids are found before they meet.
SPREAD = 64

#: Codebooks by vector length: for every part an array of entries by components.
Books = dict[int, list[np.ndarray]]


def usable(vector: Column) -> Column:
    """Not NULL, and without NULL or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of every component: as doubles where these and all squared distances are exact, else as Python numbers."""
    rows = np.floor(vectors * SCALE)
    if _exact(rows):
        return rows
    # From 2 ** 60 on every double is a whole number, and its product might have no double.
    return np.frompyfunc(lambda x: int(x) * SCALE if abs(x) >= 2**60 else math.floor(x * SCALE), 1, 1)(vectors)


def _exact(rows: np.ndarray) -> bool:
    """Whether squared distances between such rows stay whole in doubles."""
    most = float(np.abs(rows).max()) if rows.size else 0.0
    return 4 * max(1, rows.shape[-1]) * most * most < 2**52


def split(length: int, parts: int = PARTS) -> list[slice]:
    """Equal consecutive parts; the last ones are shorter, or empty, where the length is no multiple of `parts`."""
    width = -(-length // parts)
    return [slice(min(length, i * width), min(length, (i + 1) * width)) for i in range(parts)]


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    if points.dtype == object or entries.dtype == object:
        points, entries = points.astype(object), entries.astype(object)
        if not points.shape[1]:
            return np.zeros((len(points), len(entries)), object)
        gaps = points[:, None, :] - entries[None, :, :]
        return (gaps * gaps).sum(axis=2)
    return (points * points).sum(axis=1)[:, None] - 2 * points @ entries.T + (entries * entries).sum(axis=1)[None, :]


def _fits(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if that is exact, both as Python numbers otherwise."""
    if points.dtype != object and entries.dtype != object and (not entries.size or _exact(np.concatenate([points, entries]))):
        return points, entries
    return tuple(x if x.dtype == object else _python(x) for x in (points, entries))


def assign(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray | None = None, code: np.ndarray | None = None, held: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of every point, lower index on ties, its exact distance, and the number of comparisons.

    `code` and `held` are the entry and distance of the round before and `moved`
    says which entries are others since. A point whose entry stayed put can only
    have become nearer to a moved one, so it is compared with those alone.
    """
    points, entries = _fits(points, entries)
    if code is None:
        new = distances(points, entries)
        best = new.argmin(axis=1)
        return best, np.take_along_axis(new, best[:, None], axis=1)[:, 0], new.size
    code, held, compared = code.copy(), held.astype(object) if points.dtype == object else held.copy(), 0
    lost = moved[code]
    if lost.any():
        code[lost], far, compared = assign(points[lost], entries)
        held[lost] = far
    active = np.flatnonzero(moved)
    stayed = np.flatnonzero(~lost)
    if len(active) and len(stayed):
        new = distances(points[stayed], entries[active])
        compared += new.size
        place = new.argmin(axis=1)
        far, other = np.take_along_axis(new, place[:, None], axis=1)[:, 0], active[place]
        better = (far < held[stayed]) | ((far == held[stayed]) & (other < code[stayed]))
        code[stayed[better]], held[stayed[better]] = other[better], far[better]
    return code, held, compared


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length, no more than STEP at once."""
    lengths = pc.list_value_length(batch.column("vector"))
    for length in pc.unique(lengths).to_pylist():
        same = batch.filter(pc.equal(lengths, length))
        for at in range(0, same.num_rows, STEP):
            yield length, same.slice(at, STEP)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _points(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return whole(_matrix(batch.column("vector"), length))


def _codes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int64)


def _step(batch: pa.RecordBatch, length: int, books: Books, moved: dict[int, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of rows of one length and their exact distances, from those of the round before if there was one."""
    points = _points(batch, length)
    before = (_codes(batch), _matrix(batch.column("held"), PARTS)) if moved else None
    code, held = np.zeros((len(points), PARTS), np.int64), []
    for j, part in enumerate(split(length)):
        known = ()
        # A distance that no double holds is NaN; such parts are compared with all entries again.
        if before and not np.isnan(before[1][:, j]).any():
            known = (moved[length][j], before[0][:, j], before[1][:, j])
        code[:, j], far, _ = assign(points[:, part], books[length][j], *known)
        held.append(far)
    return code, np.stack(held, axis=1)


_STATE = "vec_id bigint, label string, vector array<double>, code binary, held array<double>"


def _assigned(books: Books, moved: dict[int, np.ndarray] | None):
    """Every row with the nearest entry of each of its parts and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch):
                code, held = _step(rows, length, books, moved)
                if held.dtype == object:
                    held = np.where(held < 2**53, held, np.nan).astype(np.float64)
                stored = held.ravel()
                offsets = pa.array(np.arange(0, len(stored) + 1, PARTS, dtype=np.int32))
                columns = [rows.column(c) for c in ("vec_id", "label", "vector")]
                columns += [pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(stored))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "code", "held"])

    return run


_SCORED = "vec_id bigint, label string, code string, error bigint, length int"


def _scored(books: Books, moved: dict[int, np.ndarray] | None):
    """The last assignment: code and error of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch):
                code, held = _step(rows, length, books, moved)
                if held.dtype == object:
                    errors = [min(LONGEST, sum(map(int, row))) for row in held]
                else:
                    errors = held.astype(np.int64).sum(axis=1)
                columns = [rows.column("vec_id"), rows.column("label"), pa.array([c.tobytes().hex() for c in code.astype(np.uint8)], pa.string())]
                columns += [pa.array(errors, pa.int64()), pa.array([length] * len(code), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error", "length"])

    return run


_SUMS = "length int, part int, entry int, place int, limb int, value bigint"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and counts of the parts of every entry: one set of rows per task, whatever it reads."""
    sums: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}
    for batch in batches:
        for length, rows in _by_length(batch):
            places, points, code = split(length), _points(rows, length), _codes(rows)
            none = [np.zeros((ENTRIES, p.stop - p.start), object) for p in places], np.zeros((PARTS, ENTRIES), np.int64)
            total, n = sums.setdefault(length, none)
            for j, part in enumerate(places):
                # Whole doubles add up exactly within a step; across steps Python numbers do.
                added = np.zeros(total[j].shape, points.dtype)
                np.add.at(added, code[:, j], points[:, part])
                total[j] += _python(added)
                n[j] += np.bincount(code[:, j], minlength=ENTRIES)
    out: list[tuple[int, ...]] = []
    for length, (total, n) in sums.items():
        for j, e in zip(*(x.tolist() for x in np.nonzero(n))):
            out.append((length, j, e, -1, 0, int(n[j, e])))
            for place, value in enumerate(total[j][e]):
                out.extend((length, j, e, place, limb, part) for limb, part in enumerate(_limbs(value)))
    columns = zip(*out) if out else [()] * 6
    kinds = [pa.int32()] * 5 + [pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["length", "part", "entry", "place", "limb", "value"])


def _python(numbers: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(numbers) if numbers.size else numbers.astype(object)


def _limbs(value: int) -> list[int]:
    """A whole number as digits of LIMB bits, all with its sign, the lowest first."""
    sign, value, out = -1 if value < 0 else 1, abs(value), []
    while value or not out:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def _moved(books: Books, state: DataFrame) -> tuple[Books, dict[int, np.ndarray]]:
    """Codebooks of componentwise floor(sum / count), and which of their entries are others than before.

    What reaches the driver is a row per component of the codebooks, however many rows there are.
    """
    summed = state.select("vector", "code").mapInArrow(_summed, _SUMS)
    key = ["length", "part", "entry", "place", "limb"]
    rows = summed.groupBy(*key).agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total: dict[tuple[int, int, int, int], int] = {}
    for r in rows:
        at = (r["length"], r["part"], r["entry"], r["place"])
        total[at] = total.get(at, 0) + (int(r["value"]) << (LIMB * r["limb"]))
    out: Books = {}
    moved: dict[int, np.ndarray] = {}
    for length, parts in books.items():
        out[length], moved[length] = [], np.zeros((len(parts), ENTRIES), bool)
        for j, entries in enumerate(parts):
            new = _python(entries)
            for e in range(len(entries)):
                if n := total.get((length, j, e, -1)):
                    for place in range(entries.shape[1]):
                        new[e, place] = total[length, j, e, place] // n
            moved[length][j, : len(entries)] = (new != entries).any(axis=1) if entries.shape[1] else False
            out[length].append(_compact(new))
    return out, moved


def _compact(entries: np.ndarray) -> np.ndarray:
    """Python numbers as doubles where that is exact."""
    return entries.astype(np.float64) if all(abs(x) < 2**52 for x in entries.flat) else entries


def _first_books(rows: DataFrame) -> Books:
    """The parts of the vectors with the smallest ids, for each length."""
    picked, order = rows.select("vec_id", "vector"), [F.col("vec_id").asc_nulls_last(), "vector"]
    for spread in ([F.pmod(F.xxhash64("vec_id"), F.lit(SPREAD))], []):
        first = Window.partitionBy(F.size("vector"), *spread).orderBy(*order)
        picked = picked.withColumn("place", F.row_number().over(first)).where(F.col("place") <= ENTRIES)
    found: dict[int, list] = {}
    for r in sorted(picked.collect(), key=lambda r: r["place"]):
        found.setdefault(len(r["vector"]), []).append(np.asarray(r["vector"], np.float64))
    books: Books = {}
    for length, vectors in found.items():
        points = whole(np.stack(vectors))
        books[length] = [_compact(points[:, part]) for part in split(length)]
    return books


def fingerprint(parts: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas."""
    return hashlib.sha256(",".join(str(int(x)) for entries in parts for x in entries.flat).encode()).hexdigest()


def compress(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS
) -> DataFrame:
    """`vec_id`, `code`, `error`, `label_error`, `codebooks_sha256` for every vector that is fit for use.

    Components count as floor(256 * x) and a vector is cut into PARTS equal parts,
    each with a codebook that starts as that part of the ENTRIES smallest ids.
    `rounds` times every part goes to its nearest entry, lower index on ties, and
    every entry that has parts moves to the floor of their mean. `code` names the
    entries of the last assignment, `error` is the sum of its squared distances,
    `label_error` that sum over the rows with an equal label, NULL labels together.

    Vectors that are NULL or hold a NULL or non-finite component are left out.
    Vectors of another length have codebooks of their own, fitted by the same
    passes; where the length is no multiple of PARTS the last parts are shorter or
    empty. With fewer rows than ENTRIES the codebooks are smaller. Rows without id
    come last among the first, equal ids by their vectors; repeated rows count
    each. Sums that a long cannot hold come out as the largest long. Other columns
    are not read. No rows give no rows.

    Every round writes its rows with codes and exact distances to the shared
    folder, so that a lost executor repeats its own tasks only. The codebooks are
    all that a task receives and, as sums, all that reaches the driver: PARTS *
    ENTRIES entries for each length of vectors.
    """
    rows = table.select(
        table[id_col].cast("bigint").alias("vec_id"),
        table[label_col].cast("string").alias("label"),
        table[vector_col].cast("array<double>").alias("vector"),
    ).where(usable(F.col("vector")))
    books, moved, state = _first_books(rows), None, rows
    for _ in range(rounds):
        state = settled(state.mapInArrow(_assigned(books, moved), _STATE), "assigned")
        books, moved = _moved(books, state)
    last = state.mapInArrow(_scored(books, moved), _SCORED)
    last = settled(last, "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = last.groupBy("label").agg(F.least(exact, F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "_label")
    prints = F.lit(None).cast("string")
    for length, parts in books.items():
        prints = F.when(F.col("length") == length, fingerprint(parts)).otherwise(prints)
    return last.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", prints.alias("codebooks_sha256")
    )
