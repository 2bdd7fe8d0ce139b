"""Near copies by SimHash: fingerprints, and an exact comparison in tiles.

A fingerprint has a bit for every bit that is set in over half of the hashes of
a text's word shingles. Two fingerprints are linked where few bits differ. The
comparison goes over tiles of fingerprints whose four quarters have the same
population counts: the counts of two fingerprints differ, summed over the
quarters, by no more than their bits do, so pairs of tiles beyond the radius are
skipped and none that could hold a link is. Inside a pair of tiles every pair
is compared with exclusive-or and a bit count.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityhealth.llm.common import row_key, settled
from entityhealth.llm.components import roots

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints of one tile that meet in one unit of work, and those that stream past them. A unit holds the former,
#: eight bytes each, and a block of comparisons. Parts and groups of equal size copy the fewest rows for a unit's work.
HOME_ROWS = 1 << 17
HALO_ROWS = 1 << 17
#: Comparisons held in memory at once.
BLOCK = 1 << 20
_CHUNK = 1 << 16
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a whole text as a signed 64-bit number; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams: Iterator[bytes] = iter((b" ".join(words),))
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    counts, n, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    while part := [digest(g, seed) for g in itertools.islice(grams, _CHUNK)]:
        hashes = np.zeros(-(-len(part) // 255) * 255, np.uint64)
        hashes[: len(part)] = part
        n += len(part)
        for bit in range(8):
            # Eight counters of a byte each, none above 255.
            lanes = ((hashes >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
            counts[bit::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > n, bitorder="little").view(np.int64)
    return int(packed[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.pandas_udf("bigint")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle, seed) for t in batch], dtype="int64")

    return prints(text)


def _quarters(fp: Column) -> Column:
    """Population counts of the four quarters, each in a digit of five bits with room for the radius on both sides."""
    digits = [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) + 5 for i in range(4)]
    return sum((F.shiftleft(d.cast("bigint"), 5 * i) for i, d in enumerate(digits[1:], 1)), digits[0].cast("bigint"))


def _steps(radius: int) -> list[int]:
    """Distances between tile numbers whose counts are within the radius, one of each pair of opposites, and 0."""
    reach = range(-radius, radius + 1)
    near = [d for d in itertools.product(reach, repeat=4) if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]
    return [sum(x << (5 * (3 - i)) for i, x in enumerate(d)) for d in near]


def _join_labels(labels: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels after rows that share a column of `hits` got one label; the columns hit, and a row of each."""
    rows, columns = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
    hits, none = hits[np.ix_(rows, columns)], len(labels)
    while len(rows):
        own = labels[rows]
        low = np.where(hits, own[:, None], none).min(axis=0)
        new = np.minimum(own, np.where(hits, low[None, :], none).min(axis=1))
        if (new == own).all():
            break
        to = np.arange(none)
        np.minimum.at(to, own, new)
        while (to != to[to]).any():
            to = to[to]
        labels = to[labels]
    return labels, columns, rows[hits.argmax(axis=0)] if len(rows) else rows


class _Unit:
    """One tile part, its own fingerprints first, then those of other tiles as they come."""

    def __init__(self, unit: int, radius: int):
        self.unit, self.radius, self.parts = unit, radius, []
        self.home: np.ndarray | None = None
        self.labels = np.zeros(0, np.int64)

    def _hits(self, others: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.home[:, None] ^ others[None, :]) <= self.radius

    def _close(self) -> None:
        if self.home is None:
            self.home = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
            self.labels = np.arange(len(self.home))
            if self.unit & _GROUP_MASK == 0:
                for others in self._blocks(self.home):
                    self.labels, _, _ = _join_labels(self.labels, self._hits(others))

    def _blocks(self, others: np.ndarray) -> Iterator[np.ndarray]:
        step = max(1, BLOCK // max(1, len(self.home)))
        for at in range(0, len(others), step):
            yield others[at : at + step]

    def add(self, prints: np.ndarray, other: bool) -> Iterator[pd.DataFrame]:
        if not other:
            self.parts.append(prints)
            return
        self._close()
        for others in self._blocks(prints):
            self.labels, columns, rows = _join_labels(self.labels, self._hits(others))
            if len(columns):
                yield _links(others[columns], self.home[rows])

    def end(self) -> Iterator[pd.DataFrame]:
        self._close()
        moved = np.flatnonzero(self.labels != np.arange(len(self.labels)))
        if len(moved):
            yield _links(self.home[moved], self.home[self.labels[moved]])


def _links(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


_GROUP_BITS, _PART_BITS = 21, 22
_GROUP_MASK = (1 << _GROUP_BITS) - 1


def _compare(radius: int):
    """Links of sorted work units. A unit emits a forest: at most one link per row it read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Unit | None = None
        for batch in batches:
            units, other = batch["unit"].to_numpy(), batch["other"].to_numpy()
            prints = batch["fp"].to_numpy().view(np.uint64)
            cuts = np.flatnonzero((units[1:] != units[:-1]) | (other[1:] != other[:-1])) + 1
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(units)]):
                if lo == hi:
                    continue
                if now is None or now.unit != units[lo]:
                    if now is not None:
                        yield from now.end()
                    now = _Unit(int(units[lo]), radius)
                yield from now.add(prints[lo:hi], bool(other[lo]))
        if now is not None:
            yield from now.end()

    return run


def tile_plan(sizes: DataFrame, radius: int = RADIUS, home_rows: int = HOME_ROWS, halo_rows: int = HALO_ROWS) -> DataFrame:
    """`tile`, `n`, `around`, `parts`, `groups` from the `tile`, `n` of all tiles that hold a fingerprint.

    A tile's units hold `n * groups` rows of its own and at most `around * parts`
    of others, so the copies of a fingerprint follow from the histogram alone.
    No tiles give no rows.
    """
    around = (
        sizes.select(F.explode(_ways(radius)).alias("step"), "tile", "n")
        .select((F.col("tile") + F.col("step")).alias("tile"), "n")
        .groupBy("tile")
        .agg(F.sum("n").alias("around"))
    )
    return sizes.join(around, "tile").select(
        "tile",
        "n",
        "around",
        F.ceil(F.col("n") / home_rows).cast("bigint").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.col("around") / halo_rows)).cast("bigint").alias("groups"),
    )


def _ways(radius: int) -> Column:
    return F.array(*[F.lit(s).cast("bigint") for s in _steps(radius)])


def links(nodes: DataFrame, radius: int = RADIUS, home_rows: int = HOME_ROWS, halo_rows: int = HALO_ROWS) -> DataFrame:
    """Links `a`, `b` that connect what any pair of distinct `fp` within the radius connects.

    A work unit is a part of a tile against a group of the fingerprints in the
    tiles around it. Tiles are cut into parts of about `home_rows`, their
    surroundings into groups of about `halo_rows`, so no unit grows with the
    table, however many fingerprints fall into one tile. Of the links in a unit
    only a spanning forest leaves it. The tile table is broadcast; it has
    17 ** 4 rows at most, whatever the input.
    """
    if not 0 <= radius <= 5:
        raise ValueError("the radius must be from 0 to 5")
    nodes = nodes.select("fp", _quarters(F.col("fp")).alias("tile"))
    sizes = nodes.groupBy("tile").agg(F.count("*").alias("n"))
    tiles = settled(tile_plan(sizes, radius, home_rows, halo_rows).select("tile", "parts", "groups"), "tiles")
    spread = F.xxhash64("fp")
    part = F.pmod(spread, F.col("parts"))
    group = F.pmod(F.shiftright(spread, 24), F.col("groups"))

    def unit(part_of: Column, group_of: Column) -> Column:
        at = F.shiftleft(F.col("tile"), _PART_BITS + _GROUP_BITS)  # tile numbers have 20 bits
        return (at + F.shiftleft(part_of, _GROUP_BITS) + group_of).alias("unit")

    home = (
        nodes.join(F.broadcast(tiles), "tile")
        .select("fp", "tile", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))
        .select(unit(F.col("part"), F.col("group")), F.lit(0).cast("byte").alias("other"), "fp")
    )
    halo = (
        nodes.select("fp", "tile", F.explode(_ways(radius)).alias("step"))
        .select("fp", "step", (F.col("tile") + F.col("step")).alias("tile"))
        .join(F.broadcast(tiles), "tile")
        .select("fp", "tile", "step", part.alias("part"), group.alias("group"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("to"))
        # Inside its own tile a fingerprint goes to the parts before its own.
        .where("step <> 0 OR to < part")
        .select(unit(F.col("to"), F.col("group")), F.lit(1).cast("byte").alias("other"), "fp")
    )
    work = home.unionByName(halo).repartition("unit").sortWithinPartitions("unit", "other")
    return work.mapInPandas(_compare(radius), "a bigint, b bigint")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`fp`, `root` per distinct fingerprint: the smallest fingerprint of its component."""
    nodes = settled(prints.select("fp").distinct(), "prints")
    return nodes.join(
        roots(links(nodes, radius)).withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hexadecimal digits), `component_id` for every row.

    `component_id` is the smallest id reachable over links of at most `radius`
    differing bits, the row's own included. Words are runs without ASCII white
    space, A-Z in lower case; a text with fewer words than a shingle is one
    shingle. NULL and empty texts have fingerprint 0, linked like any other.
    Rows without id get the id of their component, NULL if none of it has one.
    Repeated rows come out as often as they went in. Other columns are not read.
    """
    prints = settled(
        docs.select(
            docs[id_col].alias("doc_id"), fingerprint_column(docs[text_col], shingle, seed).alias("fp")
        ),
        "fingerprints",
    )
    return _with_components(prints, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_components(prints: DataFrame, radius: int) -> DataFrame:
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = settled(classes(prints, radius).join(first, "fp"), "classes")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "component_id"), "fp")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays.

    Rows without id stay only where no row of the component has one. Rows with
    the same id and text are one row. All columns of `docs` come back as they were.
    """
    key = row_key(docs[id_col], docs[text_col])
    prints = settled(
        docs.select(
            key.alias("key"),
            docs[id_col].alias("doc_id"),
            fingerprint_column(docs[text_col], shingle, seed).alias("fp"),
        ),
        "fingerprints",
    )
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    first = prints.groupBy("fp").agg(F.min(place).alias("first"))
    kept = classes(prints, radius).join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    rows = docs.select(key.alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return (
        rows.dropDuplicates(["key"]).join(kept.select(F.col("first.key").alias("key")), "key", "left_semi").select("row.*")
    )
