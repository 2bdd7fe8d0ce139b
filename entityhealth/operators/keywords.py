"""Keyword tables of any size against texts.

A `CASE` of `contains` per keyword searches every text once for each of them.
Here every keyword is filed under its rarest piece of a few characters. Texts
give their pieces, an equi-join finds the keywords filed under them, and only
those are searched in the text. The work grows with texts and hits, not with
texts times keywords.

Counting does not need the pairs of texts and keywords as rows. There, keywords
that are not long are looked for as whole windows of the texts. A filter of bounded
size tells most windows that are no keyword before anything is shuffled. Keywords
that many texts have are counted where the texts are, from a table of bounded size;
the other windows travel packed, once for a chunk of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from entityhealth.session import written

PIECE = 8
#: Texts whose pieces are counted to tell rare from frequent ones. The choice changes the work, never the result.
COUNTED_TEXTS = 2_000
CHUNK = 256
#: Keywords up to so many characters are searched whole.
WHOLE = 32
#: The filter of windows has 2 to this power bits at most, and some FILTER_SHARE for a keyword. More keywords let more windows pass.
FILTER_BITS = 30
FILTER_SHARE = 24
#: Texts (but one in SAMPLED_SHARE at most) whose windows are counted to tell which keywords many texts have, and rows
#: of the table of those. The choice changes the work, never the result.
SAMPLED_TEXTS = 60_000
SAMPLED_SHARE = 8
KNOWN_ROWS = 1_500_000
#: Code points at hand at a time, those hashed at a time, pairs of texts and windows in a chunk, keywords in a bucket,
#: windows looked up at a time, about.
SLICE_CHARS = 2_000_000
HASHED_CHARS = 1 << 16
CHUNK_PAIRS = 1_000_000
BUCKET_WORDS = 200_000
LOOKED_UP = 500_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PACKED_TYPES = (pa.int32(), pa.string(), pa.string(), pa.binary())
_COUNTED = pa.schema([("chunk", pa.string()), ("kind", pa.string()), ("data", pa.binary())])


def cut(df: DataFrame, text: str, sizes: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """`keep`, `piece`: every run of so many characters in the texts, a row for each place.

    Rows and substrings instead of arrays and lambdas: all of it is one generated
    loop. A text is cut into chunks first, because finding a place in a text takes
    time in proportion to how far it is from the start.
    """
    starts = F.explode(F.sequence(F.lit(0), F.length(text) - 1, F.lit(CHUNK)))
    chunks = df.where(F.length(text) > 0).select(*keep, F.col(text).alias("_whole"), starts.alias("_start"))
    chunks = chunks.select(*keep, F.substring("_whole", F.col("_start") + 1, F.lit(CHUNK + max(sizes) - 1)).alias("_chunk"))
    places = F.explode(F.sequence(F.lit(1), F.least(F.length("_chunk"), F.lit(CHUNK))))
    placed = chunks.select(*keep, "_chunk", places.alias("_place"))
    out = []
    for n in sizes:
        at_hand = placed.where(F.length("_chunk") >= F.col("_place") + (n - 1))
        out.append(at_hand.select(*keep, F.substring("_chunk", F.col("_place"), F.lit(n)).alias("piece")))
    return reduce(DataFrame.unionAll, out)


def file_keywords(words: DataFrame, texts: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """`word`, `piece`, `size`: each distinct word under its piece that is rarest in some of the texts, ties by piece.

    `sizes` are those of the words' pieces: PIECE, or the length of a shorter word.
    """
    own = words.select("word", _size().alias("size"))
    pieces = reduce(DataFrame.unionAll, [cut(own.where(F.col("size") == n), "word", [n], ["word", "size"]) for n in sizes])
    pieces = written(pieces, "pieces")
    some = texts.select(F.lower(text).alias("_text")).orderBy(F.xxhash64("_text")).limit(COUNTED_TEXTS)
    places = cut(written(some, "counted-texts"), "_text", sizes)
    often = places.join(pieces.select("piece").distinct(), "piece").groupBy("piece").agg(F.count("*").alias("n"))
    rated = pieces.join(often, "piece", "left").groupBy("word", "size")
    best = rated.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("_best"))
    return best.select("word", F.col("_best.piece").alias("piece"), "size")


def _size() -> Column:
    return F.least(F.length("word"), F.lit(PIECE))


def keyword_matches(docs: DataFrame, ids: Sequence[str], text: str, keywords: DataFrame, word: str = "keyword") -> DataFrame:
    """`ids`, `word`: which keywords occur in which text, in any case, each pair once.

    `ids` identify a text. NULL texts and keywords match nothing, neither does an
    empty keyword. The filed keywords are written, so Spark sees how large they
    are: a small file is sent to every task, so the pieces of the texts are not
    shuffled; a large one is joined by a shuffle of both.
    """
    words = keywords.select(F.lower(word).alias("word")).where(F.length("word") > 0).distinct()
    words = written(words, "words")
    sizes = sorted(r["size"] for r in words.select(_size().alias("size")).distinct().collect())
    texts = docs.select(*ids, F.lower(text).alias("_text")).where(F.col("_text").isNotNull())
    if not sizes:
        return texts.select(*ids, F.lit(None).cast("string").alias(word)).limit(0)
    filed = written(file_keywords(words, docs, text, sizes), "keywords")
    own = cut(texts, "_text", sizes, ids)
    candidates = own.join(filed.select("piece", "word"), "piece").groupBy(*ids).agg(F.collect_set("word").alias("_words"))
    found = texts.join(candidates, list(ids))
    hits = F.filter("_words", lambda w: F.contains(F.col("_text"), w))
    return found.select(*ids, F.explode(hits).alias(word)).distinct()


# --- whole keywords up to WHOLE characters -------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLIER
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, as many as `n`."""
    inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
    out = []
    for base in (_MULTIPLIER, inverse):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _utf8(texts: pa.LargeStringArray) -> memoryview:
    """The bytes of all texts in a row."""
    offsets = np.frombuffer(texts.buffers()[1] or b"\0" * 8, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]]


def _points(utf8: memoryview) -> np.ndarray:
    return np.frombuffer(str(utf8, "utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and where each text begins (and the last one ends)."""
    texts = texts.cast(pa.large_string())
    ends = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
    return _points(_utf8(texts)), ends


def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    return sums, down


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word; the windows of a text have the same ones."""
    out = [np.zeros(0, np.uint64)]
    for start, stop in _slices(pc.utf8_length(words).to_numpy(zero_copy_only=False)):
        points, ends = _code_points(words.slice(start, stop - start))
        sums, down = _sums(points)
        out.append(_mixed((sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]]))
    return np.concatenate(out)


def _window_sums(points: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Each size with the sum of every window of so many code points, what `_hashes` mixes for a word.

    The sums of longer windows are put together from those of shorter ones.
    """
    doubled, power = [points.astype(np.uint64) + np.uint64(1)], [_MULTIPLIER]
    for size in sizes:
        if size > len(points):
            continue
        total, done, factor = None, 0, np.uint64(1)
        for k in range(size.bit_length()):
            while len(doubled) <= k:
                n, last = 1 << (len(doubled) - 1), doubled[-1]
                doubled.append(last[:-n] + last[n:] * power[-1])
                power.append(power[-1] * power[-1])
            if size >> k & 1:
                part = doubled[k][done : done + len(points) - size + 1]
                total, done, factor = part if total is None else total + part * factor, done + (1 << k), factor * power[k]
        yield size, total


def _marks(hashes: np.ndarray) -> np.ndarray:
    """The three bits, of 64, that a hash has in its place of the filter."""
    one, low = np.uint64(1), np.uint64(63)
    return one << (hashes & low) | one << (hashes >> np.uint64(6) & low) | one << (hashes >> np.uint64(12) & low)


def _power(n: int) -> int:
    """The filter of so many words has 2 to this power bits."""
    return min(FILTER_BITS, max(16, (FILTER_SHARE * n).bit_length()))


def _bits(hashes: np.ndarray, power: int, split: int = 0, bits: np.ndarray | None = None) -> np.ndarray:
    """A filter of 2 to the power bits, or that part of it with the hashes' first `split` bits, with the marks of the hashes."""
    blocks = np.zeros(1 << (power - split - 6), np.uint64) if bits is None else bits.view(np.uint64)
    np.bitwise_or.at(blocks, (hashes >> np.uint64(64 + 6 - power)).view(np.int64) & (len(blocks) - 1), _marks(hashes))
    return blocks.view(np.uint8)


def _may_be(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets pass."""
    blocks = bits.view(np.uint64)
    marks = _marks(hashes)
    return np.flatnonzero(blocks[(hashes >> np.uint64(65 - len(blocks).bit_length())).view(np.int64)] & marks == marks)


def _windows(points: np.ndarray, ends: np.ndarray, sizes: Sequence[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each size that any has: places, hashes and texts of the windows that may be words, by place."""
    found, more = {}, max(sizes, default=1) - 1
    with np.errstate(over="ignore"):
        for start in range(0, len(points), HASHED_CHARS):
            for size, sums in _window_sums(points[start : start + HASHED_CHARS + more], sizes):
                h = _mixed(sums[:HASHED_CHARS])
                held = _may_be(h, bits)
                found.setdefault(size, []).append((held + start, h[held]))
    for size, parts in found.items():
        at, h = (np.concatenate(x) for x in zip(*parts))
        text = np.repeat(np.arange(len(ends) - 1), np.diff(np.searchsorted(at, ends)))
        whole = np.flatnonzero(at + size <= ends[1:][text])
        if len(whole):
            yield size, at[whole], h[whole], text[whole]


def _strings(points: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """The windows of `size` code points at the given places, as strings."""
    codes = points[at[:, None] + np.arange(size)]
    long = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(long.sum(axis=1))]).astype(np.int64)
    data = codes.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))


def _blob(batch: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def _table(blob: bytes) -> pa.Table:
    return _unpacked(blob) if blob[:1] == _PACKED else pa.ipc.open_stream(blob).read_all()


#: The first byte of packed windows.
_PACKED = b"W"


def _packed(windows: pa.Table) -> bytes:
    """`word`, `docs`, in order of their `size`, without the offsets of Arrow, which do not compress."""
    windows = windows.combine_chunks()
    sizes, rows = _runs(windows.column("size").to_numpy().copy())
    docs = windows.column("docs").combine_chunks()
    numbers = (sizes, rows, docs.value_lengths().to_numpy(), docs.flatten().to_numpy())
    head = np.array([len(x) for x in numbers], np.int64)
    body = b"".join([head.tobytes(), *(x.astype(np.int32).tobytes() for x in numbers), _utf8(windows.column("word").combine_chunks())])
    return _PACKED + len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> pa.Table:
    body = memoryview(pa.decompress(blob[9:], int.from_bytes(blob[1:9], "little"), "zstd", asbytes=True))
    edges = 32 + 4 * np.concatenate([[0], np.cumsum(np.frombuffer(body[:32], np.int64))])
    sizes, rows, n, docs = (np.frombuffer(body[a:b], np.int32) for a, b in zip(edges[:-1], edges[1:]))
    points, words, begin = _points(body[edges[-1] :]), [], 0
    for size, many in zip(sizes.tolist(), rows.tolist()):
        words.append(_strings(points, np.arange(begin, begin + size * many, size), size))
        begin += size * many
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.table({"word": pa.concat_arrays(words), "docs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(docs))})


def _marked(words: DataFrame, word: str) -> DataFrame:
    """The rows with a `_hash` of the word."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = _hashes(b.column(word)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hashes)], names=[*b.schema.names, "_hash"])

    return words.mapInArrow(mark, T.StructType([*words.schema.fields, T.StructField("_hash", T.LongType())]))


def _filter(marked: DataFrame, n: int | None = None) -> np.ndarray:
    """Three bits for the hash of every word, of the `n` that there are: a window without them is no word."""
    n = marked.count() if n is None else n
    power, split = _power(n), 7

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.sort(np.concatenate(held))
            edges = np.searchsorted(h >> np.uint64(64 - split), np.arange((1 << split) + 1, dtype=np.uint64))
            parts = np.flatnonzero(np.diff(edges))
            data = [h[edges[p] : edges[p + 1]].tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

        for b in batches:
            held.append(b.column("_hash").to_numpy().view(np.uint64))
            size += b.num_rows
            if size >= CHUNK_PAIRS:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def pack(group: pa.Table) -> pa.Table:
        bits = None
        for data in group.column("data"):
            bits = _bits(np.frombuffer(data.as_buffer(), np.uint64), power, split, bits)
        return pa.table({"part": group.column("part").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    size = 1 << (power - split - 3)
    out = np.zeros(size << split, np.uint8)
    dealt = marked.select("_hash").mapInArrow(deal, "part int, data binary")
    for r in dealt.groupBy("part").applyInArrow(pack, "part int, bits binary").toLocalIterator():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


@dataclass(frozen=True)
class _Known:
    """Some words by their hashes, each with its code points and its categories' places among `categories`."""

    hashes: np.ndarray
    starts: np.ndarray
    points: np.ndarray
    begins: np.ndarray
    entries: np.ndarray
    codes: np.ndarray
    categories: pa.Array

    @classmethod
    def of(cls, rows: pa.Table, word: str, category: str) -> _Known:
        words, categories = rows.column(word).cast(pa.large_string()).combine_chunks(), rows.column(category).combine_chunks()
        del rows
        words, categories = words.dictionary_encode(), categories.dictionary_encode(null_encoding="encode")
        hashes = _hashes(words.dictionary)
        order = np.argsort(hashes, kind="stable")
        hashes, names = hashes[order], words.dictionary.take(pa.array(order))
        lengths = pc.utf8_length(names).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[0], np.cumsum(lengths)])
        points = [np.zeros(WHOLE, np.uint16)]
        for start, stop in _slices(lengths):
            some = _code_points(names.slice(start, stop - start))[0]
            points.insert(-1, some.astype(np.uint16) if some.max() < 1 << 16 else some)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        place = place[words.indices.to_numpy()]
        by_word = np.argsort(place, kind="stable")
        prefix = cls._prefix(len(hashes))
        starts = np.searchsorted(hashes >> np.uint64(64 - prefix), np.arange((1 << prefix) + 1, dtype=np.uint64))
        entries = np.searchsorted(place[by_word], np.arange(len(hashes) + 1))
        return cls(
            hashes,
            starts.astype(np.int32),
            np.concatenate(points),
            begins.astype(np.int32),
            entries.astype(np.int32),
            categories.indices.to_numpy()[by_word].astype(np.int32),
            categories.dictionary,
        )

    @staticmethod
    def _prefix(n: int) -> int:
        """So many first bits of a hash tell where to look for it."""
        return n.bit_length()

    def find(self, points: np.ndarray, at: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
        """The word that a window is, or -1. Hashes find it, code points decide."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.hashes):
            return out
        bucket = (h >> np.uint64(64 - self._prefix(len(self.hashes)))).view(np.int64)
        place, end = self.starts[bucket], self.starts[bucket + 1]
        left = np.flatnonzero(place < end)
        while len(left):
            same = self.hashes[place[left]] == h[left]
            out[left[same]] = place[left[same]]
            left = left[~same]
            place[left] += 1
            left = left[place[left] < end[left]]
        hit = np.flatnonzero(out >= 0)
        word = out[hit]
        same = self.begins[word + 1] - self.begins[word] == size
        for start in range(0, len(hit), HASHED_CHARS):
            some = slice(start, start + HASHED_CHARS)
            windows = np.lib.stride_tricks.sliding_window_view(points, size)[at[hit[some]]]
            same[some] &= (windows == np.lib.stride_tricks.sliding_window_view(self.points, size)[self.begins[word[some]]]).all(axis=1)
        out[hit[~same]] = -1
        return out

    def counts(self, word: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners, categories and how many different words of it each has."""
        pairs = _runs(owner.astype(np.int64) << 32 | word)[0]
        word, owner = pairs & 0xFFFFFFFF, pairs >> 32
        entry, n = _spread(self.entries, word)
        pairs, counts = _runs(np.repeat(owner, n) << 32 | self.codes[entry])
        return (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each comes. Sorts in place; `np.unique` would hash some first."""
    values.sort()
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def _spread(begins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all places in a row, and how many each has."""
    n = (begins[1:] - begins[:-1])[at]
    return np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def _frequent(docs: DataFrame, ids: Sequence[str], text: str, marked: DataFrame, sizes: Sequence[int], bits: np.ndarray, word: str, category: str) -> _Known:
    """The words that most of some texts have, KNOWN_ROWS with their categories at most."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    one_in = max(SAMPLED_SHARE, docs.count() // SAMPLED_TEXTS)
    some = docs.where(F.pmod(F.xxhash64(*ids), F.lit(one_in)) == 0).select(F.lower(text).alias("_text")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = pc.utf8_length(b.column("_text")).to_numpy(zero_copy_only=False)
            for start, stop in _slices(lengths):
                points, ends = _code_points(b.column("_text").slice(start, stop - start))
                for _, _, h, owner in _windows(points, ends, sizes, shared.value):
                    h, n = _runs(_once(h, owner))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["_hash", "n"])

    counted = some.mapInArrow(count, "_hash bigint, n bigint").groupBy("_hash").agg(F.sum("n").alias("n")).where("n > 1")
    often = _most_often(written(counted, "counted")).toArrow()
    shared.destroy()
    hashes, n = (often.column(c).to_numpy() for c in ("_hash", "n"))
    order = np.argsort(hashes)
    wanted = docs.sparkSession.sparkContext.broadcast((hashes[order], n[order], _bits(hashes.view(np.uint64), _power(len(hashes)))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n, bits = wanted.value
        for b in batches:
            h = b.column("_hash").to_numpy()
            held = _may_be(h.view(np.uint64), bits)
            at = np.searchsorted(hashes, h[held])
            same = np.flatnonzero(at < len(hashes))
            same = same[hashes[at[same]] == h[held[same]]]
            own = b.select([word, category]).take(pa.array(held[same]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(n[at[same]])], names=[word, category, "n"])

    del often, hashes, n, order
    fields = [marked.schema[word], marked.schema[category], T.StructField("n", T.LongType())]
    picked = written(marked.select(word, category, "_hash").mapInArrow(pick, T.StructType(fields)), "frequent")
    known = _Known.of(_most_often(picked).select(word, category).toArrow(), word, category)
    wanted.destroy()
    return known


def _most_often(rows: DataFrame) -> DataFrame:
    """The rows with the largest `n`, KNOWN_ROWS at most; those of one `n` all or none."""
    total, least = 0, None
    for n, more in rows.groupBy("n").count().orderBy(F.col("n").desc()).collect():
        total += more
        if total > KNOWN_ROWS:
            break
        least = n
    return rows.where(F.lit(False) if least is None else F.col("n") >= least)


class _Chunk:
    """The windows of some texts that may be words: which text has which, a row per window, dealt over buckets.

    Those of the `known` words are counted at once.
    """

    def __init__(self, buckets: int, known: _Known | None = None):
        self.buckets, self.known, self.found, self.counts, self.pairs, self.texts = buckets, known, [], [], 0, 0

    def add(self, points: np.ndarray, ends: np.ndarray, owner: np.ndarray, sizes: Sequence[int], bits: np.ndarray) -> None:
        named = []
        for size, at, h, text in _windows(points, ends, sizes, bits):
            own = owner[text]
            if self.known is not None:
                word = self.known.find(points, at, h, size)
                named.append((word[word >= 0], own[word >= 0]))
                rest = np.flatnonzero(word < 0)
                at, h, own = at[rest], h[rest], own[rest]
            if len(h):
                self._keep(points, at, h, own, size)
        if named:
            self.counts.append(self.known.counts(*(np.concatenate(x) for x in zip(*named))))
            self.pairs += len(self.counts[-1][0])

    def _keep(self, points: np.ndarray, at: np.ndarray, h: np.ndarray, own: np.ndarray, size: int) -> None:
        # A window that repeats in a batch of texts is told by its hash, but kept as the string that it is.
        order = np.argsort(h, kind="stable")
        at, h, own = at[order], h[order], own[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
        same = np.ones(len(h), bool)
        for i in range(size):
            same &= points[at + i] == points[at[first][group] + i]
        first, group = np.append(first, np.flatnonzero(~same)), np.where(same, group, 0)
        group[~same] = np.arange(len(first) - (~same).sum(), len(first))
        pairs = _runs(group.astype(np.int64) << 32 | own)[0]
        group, own = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int32)
        offsets = np.searchsorted(group, np.arange(len(first) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(own))
        bucket = (h[first] % np.uint64(self.buckets)).astype(np.int32)
        sizes = pa.array(np.full(len(first), size, np.int32))
        self.found.append(pa.table({"bucket": pa.array(bucket), "size": sizes, "word": _strings(points, at[first], size), "docs": lists}))
        self.pairs += len(own)

    def blobs(self, name: str, ids: pa.Table) -> Iterator[tuple[int, str, str, bytes]]:
        """Also the ids of the texts, by their place in the chunk, and what is counted, which ride in one of the buckets."""
        own = zlib.crc32(name.encode()) % self.buckets
        yield own, name, "ids", _blob(ids.combine_chunks())
        if self.counts:
            doc, code, n = (np.concatenate(x) for x in zip(*self.counts))
            yield own, name, "counts", _blob(_counted(doc, self.known.categories.take(pa.array(code)), n))
        if not self.found:
            return
        found = pa.concat_tables(self.found)
        bucket = found.column("bucket").to_numpy()
        order = np.lexsort((found.column("size").to_numpy(), bucket))
        found, edges = found.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            yield int(b), name, "words", _packed(found.slice(edges[b], edges[b + 1] - edges[b]))


def _counted(doc: np.ndarray, category: pa.Array, n: np.ndarray) -> pa.Table:
    return pa.table({"doc": pa.array(doc, pa.int32()), "category": category, "n": pa.array(n, pa.int32())})


def _once(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The hashes, each once for an owner. Owners are in order."""
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    return h[np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])]


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded size together, whatever their lengths."""
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // SLICE_CHARS, prepend=0)).tolist()
    return ((start, stop) for start, stop in zip([0, *cuts], [*cuts, len(lengths)]) if start < stop)


PACKED = "bucket int, chunk string, kind string, data binary"


def pack_windows(docs: DataFrame, ids: Sequence[str], sizes: Sequence[int], bits: np.ndarray, buckets: int, known: _Known | None = None) -> DataFrame:
    """PACKED: the windows of the texts (`_texts`, a list) that may be words, and which texts have them.

    A row holds the windows of a chunk of texts that fall into one bucket,
    compressed, each once for some texts with those that have it. Of `known`
    words it holds counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast((bits, known))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value
        task, n, chunk, names = TaskContext.get().partitionId(), 0, _Chunk(buckets, known), []

        def flush() -> Iterator[pa.RecordBatch]:
            if names:
                for row in chunk.blobs(f"{task}-{n}", pa.Table.from_batches(names)):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _PACKED_TYPES)], names=["bucket", "chunk", "kind", "data"])

        for b in batches:
            texts = b.column("_texts")
            inner = np.concatenate([[0], np.cumsum(pc.utf8_length(texts.flatten()).to_numpy(zero_copy_only=False), dtype=np.int64)])
            lengths = np.diff(inner[np.concatenate([[0], np.cumsum(texts.value_lengths().to_numpy(zero_copy_only=False))])])
            for start, stop in _slices(lengths):
                part = b.slice(start, stop - start)
                lists = part.column("_texts")
                owner = np.repeat(np.arange(part.num_rows) + chunk.texts, lists.value_lengths().to_numpy(zero_copy_only=False))
                chunk.add(*_code_points(lists.flatten()), owner, sizes, bits)
                chunk.texts += part.num_rows
                names.append(part.select(list(ids)))
                if chunk.pairs >= CHUNK_PAIRS:
                    yield from flush()
                    n, chunk, names = n + 1, _Chunk(buckets, known), []
        yield from flush()

    return docs.select(*ids, "_texts").mapInArrow(pack, PACKED)


def _together(docs: DataFrame, ids: Sequence[str], text: str) -> DataFrame:
    """`ids`, `_texts`: a row for each text, but one for all texts of ids that repeat. NULL texts and ids have none."""
    known = docs.select(*ids, F.lower(text).alias("_text")).dropna()
    again = written(known.groupBy(*ids).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), "repeated")
    one = known.join(again, list(ids), "left_anti").select(*ids, F.array("_text").alias("_texts"))
    return one.unionByName(known.join(again, list(ids), "left_semi").groupBy(*ids).agg(F.collect_set("_text").alias("_texts")))


def _count_whole(docs: DataFrame, ids: Sequence[str], text: str, marked: DataFrame, sizes: dict[int, int], word: str, category: str) -> DataFrame:
    """`ids`, `category`, `n_keywords` for keywords that are searched as whole windows; `sizes` tells how many have which length.

    Keywords that many texts have are counted with the texts. Another window
    travels only if the filter says it may be a keyword, and once for a chunk of
    texts; the keywords of its bucket tell its categories, as strings. What comes
    back to a chunk are counts.
    """
    texts = docs.select(*ids)
    out = T.StructType([*texts.schema.fields, marked.schema[category], T.StructField("n_keywords", T.LongType(), False)])
    if not sizes:
        return docs.sparkSession.createDataFrame([], out)
    n = sum(sizes.values())
    buckets, lengths = max(8, -(-n // BUCKET_WORDS)), sorted(sizes)
    bits = _filter(marked, n)
    known = _frequent(docs, ids, text, marked, lengths, bits, word, category)
    packed = pack_windows(_together(docs, ids, text), ids, lengths, bits, buckets, known)

    def look_up(windows: pa.Table, words: pa.Table) -> pa.Table:
        rows = []
        names = words.column(word).cast(pa.large_string()).combine_chunks().dictionary_encode()
        order = np.argsort(names.indices.to_numpy(), kind="stable")
        begins = np.searchsorted(names.indices.to_numpy()[order], np.arange(len(names.dictionary) + 1))
        categories = words.column(category).combine_chunks().dictionary_encode(null_encoding="encode")
        codes = categories.indices.to_numpy()[order]

        def tell(chunks: list[str], tables: list[pa.Table]) -> None:
            found = pc.index_in(pa.concat_tables(tables).column("word"), value_set=names.dictionary).combine_chunks()
            for chunk, t in zip(chunks, tables):
                at, found = found.slice(0, len(t)), found.slice(len(t))
                held = at.is_valid()
                docs_of = t.column("docs").combine_chunks().filter(held)
                n_docs = docs_of.value_lengths().to_numpy(zero_copy_only=False)
                at, own = np.repeat(at.drop_null().to_numpy(), n_docs), docs_of.flatten().to_numpy()
                entry, n = _spread(begins, at)
                pairs, counts = _runs(np.repeat(own.astype(np.int64), n) << 32 | codes[entry])
                if len(pairs):
                    category_of = categories.dictionary.take(pa.array(pairs & 0xFFFFFFFF))
                    rows.append((chunk, "counts", _blob(_counted((pairs >> 32).astype(np.int32), category_of, counts))))

        chunks, tables, size = [], [], 0
        for chunk, kind, data in zip(*(windows.column(c).to_pylist() for c in ("chunk", "kind", "data"))):
            if kind != "words":
                rows.append((chunk, kind, data))
                continue
            chunks.append(chunk)
            tables.append(_table(data))
            size += len(tables[-1])
            if size >= LOOKED_UP:
                tell(chunks, tables)
                chunks, tables, size = [], [], 0
        if tables:
            tell(chunks, tables)
        return pa.Table.from_pylist([dict(zip(_COUNTED.names, r)) for r in rows], schema=_COUNTED)

    def add_up(group: pa.Table) -> pa.Table:
        kinds = {"ids": [], "counts": []}
        for kind, data in zip(group.column("kind").to_pylist(), group.column("data").to_pylist()):
            kinds[kind].append(_table(data))
        named = kinds["ids"][0]
        if not kinds["counts"]:
            return pa.table([*[c.slice(0, 0) for c in named.columns], pa.nulls(0, category_type), pa.nulls(0, pa.int64())], names=out.names)
        counts = [t.set_column(1, "category", t.column("category").cast(category_type)) for t in kinds["counts"]]
        total = pa.concat_tables(counts).group_by(["doc", "category"]).aggregate([("n", "sum")])
        own = named.take(total.column("doc"))
        return pa.table([*own.columns, total.column("category"), total.column("n_sum").cast(pa.int64())], names=out.names)

    category_type = to_arrow_type(marked.schema[category].dataType)
    words = marked.select(word, category, _bucket(buckets).alias("bucket"))
    counted = packed.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(look_up, "chunk string, kind string, data binary")
    return counted.groupBy("chunk").applyInArrow(add_up, out)


def _bucket(buckets: int) -> Column:
    """The unsigned hash modulo `buckets`, as windows have it."""
    high = F.pmod(F.shiftrightunsigned("_hash", 1), F.lit(buckets))
    return F.pmod(high * 2 + F.col("_hash").bitwiseAND(F.lit(1)), F.lit(buckets)).cast("int")


def keyword_counts(
    docs: DataFrame, ids: Sequence[str], text: str, keywords: DataFrame, word: str = "keyword", category: str = "category"
) -> DataFrame:
    """`ids`, `category`, `n_keywords`: how many keywords of each category a text has; texts without any have no row.

    Texts with the same ids count as one. Keywords of up to WHOLE characters are
    searched whole; the longer ones, whose windows would be of very many sizes,
    by their rarest piece.
    """
    table = keywords.select(F.lower(word).alias(word), category).where(F.length(word) > 0).distinct()
    marked = written(_marked(table, word), "words")
    sizes = {r["size"]: r["count"] for r in marked.groupBy(F.length(word).alias("size")).count().collect()}
    short = {k: n for k, n in sizes.items() if k <= WHOLE}
    counted = _count_whole(docs, ids, text, marked.where(F.length(word) <= WHOLE), short, word, category)
    if len(short) == len(sizes):
        return counted
    long = written(marked.where(F.length(word) > WHOLE).drop("_hash"), "long")
    matches = keyword_matches(docs, ids, text, long, word).join(long, word).groupBy(*ids, category).agg(F.count("*").alias("n_keywords"))
    return counted.unionByName(matches).groupBy(*ids, category).agg(F.sum("n_keywords").alias("n_keywords"))
