"""How far the sources of a language differ, from stripes folded inside the map tasks.

A stripe belongs to a term of a language: in how many documents it occurs, and
how often in each source. A map task folds whole documents into stripes in hash
tables, spills them when the tables are full, and stripes of the same term are
merged after a shuffle by term. Divergences come straight from merged stripes:
a slice of a language's stripes meets the sums of its sources and adds up every
pair of sources at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityhealth.llm.common import settled

MIN_DOCS = 30
SMOOTHING = 5
SCALE_LOW, SCALE_HIGH = 10**4, 10**5
TOP_TERMS = 50
#: Entries that the hash tables of a map task hold before they spill.
ENTRIES = 1 << 19
#: Bytes of a text whose terms are listed at once.
PIECE = 1 << 22
#: Stripes of a language that meet in one unit of work, sources whose pairs a unit adds up
#: with all others, and cells (terms by sources) that it holds at once.
UNIT_TERMS = 512
UNIT_SOURCES = 1024
UNIT_CELLS = 1 << 20

# Every other character ends a term, and only A-Z change their case.
_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _LETTERS else 0x20 for b in range(256))

_STRIPE = "lang string, term binary, docs bigint, sources array<string>, counts array<bigint>"
_STRIPE_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.binary()),
        ("docs", pa.int64()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a list for each piece of it."""
    text, at = text.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class _Stripes:
    """The stripes of a map task: hash tables of documents per term, and of occurrences per source and term."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs, counts = self.docs.get(lang), self.counts.setdefault(lang, {}).get(source)
        if docs is None:
            docs = self.docs[lang] = Counter()
        if counts is None:
            counts = self.counts[lang][source] = Counter()
        before, seen = len(docs) + len(counts), set()
        for piece in terms(text):
            counts.update(piece)
            seen.update(piece)
        docs.update(seen)
        self.entries += len(docs) + len(counts) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, docs in self.docs.items():
            place = {t: i for i, t in enumerate(docs)}
            names = list(self.counts[lang])
            held = [self.counts[lang][s] for s in names]
            row = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in held])
            n = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in held])
            source = np.repeat(np.arange(len(held)), [len(c) for c in held])
            order = np.argsort(row, kind="stable")
            yield _batch(
                pa.array([lang] * len(place), pa.string()),
                pa.array(list(place), pa.binary()),
                np.fromiter(docs.values(), np.int64, len(docs)),
                np.bincount(row, minlength=len(place)),
                pa.array(names, pa.string()).take(pa.array(source[order])),
                n[order],
            )
        self.__init__()


def _batch(lang: pa.Array, term: pa.Array, docs: np.ndarray, lengths: np.ndarray, sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, values) for values in (sources, pa.array(counts))]
    return pa.RecordBatch.from_arrays([lang, term, pa.array(docs), *lists], schema=_STRIPE_ARROW)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents (lang, source, text) to stripes, spilled whenever the tables are full."""
    stripes = _Stripes()
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            stripes.add(lang, source, text.as_py())
            if stripes.entries >= ENTRIES:
                yield from stripes.spill()
    yield from stripes.spill()


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode().indices.to_numpy()


def _flat(lists: pa.ListArray) -> pa.Array:
    return lists.flatten()


def merged(stripes: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring stripes of the same language and term as one."""
    lang, term = _codes(stripes.column("lang")), _codes(stripes.column("term"))
    first = np.concatenate([[True], (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])])
    starts, group = np.flatnonzero(first), np.cumsum(first) - 1
    names = _flat(stripes.column("sources")).dictionary_encode()
    lengths = pc.list_value_length(stripes.column("sources")).to_numpy()
    width = max(1, len(names.dictionary))
    cell = np.repeat(group, lengths) * width + names.indices.to_numpy()
    cells, back = np.unique(cell, return_inverse=True)
    n = np.zeros(len(cells), np.int64)
    np.add.at(n, back, _flat(stripes.column("counts")).to_numpy())
    at = pa.array(starts)
    return _batch(
        stripes.column("lang").take(at),
        stripes.column("term").take(at),
        np.add.reduceat(stripes.column("docs").to_numpy(), starts),
        np.bincount(cells // width, minlength=len(starts)),
        names.dictionary.take(pa.array(cells % width)),
        n,
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes in order of language and term, each term once; no more than a batch and one stripe is held."""
    last: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, _STRIPE_ARROW)], schema=_STRIPE_ARROW)
        if last is not None:
            batch = pa.concat_batches([last, batch])
        whole = merged(batch)
        last = whole.slice(whole.num_rows - 1)
        if whole.num_rows > 1:
            yield whole.slice(0, whole.num_rows - 1)
    if last is not None:
        yield last


def stripes(docs: DataFrame, lang: Column, source: Column, text: Column) -> DataFrame:
    """`lang`, `term`, `docs`, `sources`, `counts`: a row per term of a language, its sources by their counts.

    A term is in a map task's output once for each spill, so a term that every
    document has comes in as many rows as there are spills, not occurrences.
    """
    said = docs.select(
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
        F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    folded = said.mapInArrow(_fold, _STRIPE)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge, _STRIPE)


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10 ** 9 * counts / total), exact as long as counts and total stay below 9 * 10 ** 13."""
    whole, rest = np.divmod(counts * SCALE_HIGH, total)
    return 1 + whole * SCALE_LOW + rest * SCALE_LOW // total


_FOUND = "lang string, part string, source string, item string, value bigint"


def _found(part: str, lang: str, sources: list, items: list, values: np.ndarray) -> pa.Table:
    n = len(sources)
    kinds = [pa.array([x] * n, pa.string()) for x in (lang, part)]
    rest = [pa.array(sources, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())]
    return pa.table([*kinds, *rest], names=["lang", "part", "source", "item", "value"])


def _diverge(smoothing: int, top: int):
    """Sums of the differences of all pairs of sources over a slice of stripes, and each source's largest terms there."""

    def unit(stripes: pa.Table, members: pa.Table) -> pa.Table:
        if not members.num_rows:
            return _found("pair", "", [], [], np.zeros(0, np.int64))
        members = members.sort_by("source")
        lang, block = members["lang"][0].as_py(), members["block"][0].as_py()
        names = members["source"].combine_chunks()
        kept = members["terms"][0].as_py()
        totals = members["n"].to_numpy() + smoothing * kept
        own = range(block * UNIT_SOURCES, min(len(names), (block + 1) * UNIT_SOURCES))
        sums = np.zeros((len(own), len(names)), np.int64)
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if stripes.num_rows:
            stripes = stripes.sort_by("term").combine_chunks()
            none = shares(np.full(len(names), smoothing, np.int64), totals)
            all_total = members["lang_n"][0].as_py() + smoothing * kept
            step = max(1, UNIT_CELLS // len(names))
            for at in range(0, stripes.num_rows, step):
                some = stripes.slice(at, step)
                sources, counts = (some[c].combine_chunks() for c in ("sources", "counts"))
                row = np.repeat(np.arange(some.num_rows), pc.list_value_length(sources).to_numpy())
                code = pc.index_in(_flat(sources), value_set=names).to_numpy()
                n = _flat(counts).to_numpy()
                p = np.tile(none, (some.num_rows, 1))
                p[row, code] = shares(n + smoothing, totals[code])
                for i, a in enumerate(own):
                    sums[i, a + 1 :] += np.abs(p[:, a + 1 :] - p[:, a : a + 1]).sum(axis=0)
                everywhere = np.zeros(some.num_rows, np.int64)
                np.add.at(everywhere, row, n)
                more = p[row, code] - shares(everywhere + smoothing, np.int64(all_total))[row]
                held = (more > 0) & (code >= own.start) & (code < own.stop)
                best.append((code[held], more[held], at + row[held]))
        i, j = np.nonzero(np.arange(len(names))[None, :] > np.asarray(own)[:, None])
        name = names.to_pylist()
        out = [_found("pair", lang, [name[own[x]] for x in i], [name[x] for x in j], sums[i, j])]
        if best:
            code, more, row = (np.concatenate(x) for x in zip(*best))
            order = np.lexsort((row, -more, code))
            code, more, row = code[order], more[order], row[order]
            first = np.arange(len(code)) - np.searchsorted(code, code) < top
            said = stripes["term"].combine_chunks().take(pa.array(row[first])).to_pylist()
            out.append(_found("term", lang, [name[x] for x in code[first]], said, more[first]))
        return pa.concat_tables(out)

    return unit


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    smoothing: int = SMOOTHING,
    top: int = TOP_TERMS,
) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: how a source differs from the others of its language.

    A language keeps the terms in at least `min_docs` of its documents. A source's
    share of a term is 1 + floor(10 ** 9 * (count + smoothing) / (all its counts +
    smoothing * kept terms)), the language's likewise. Part `pair` has a row for
    every other source of the language: the shares' differences summed over all
    kept terms, 0 where none is kept. Part `term` has the `top` terms that the
    source has and whose share is above the language's, by how much. Ranks fall by
    value, ties rise by the item's bytes; all arithmetic is whole numbers.

    NULL languages, sources and texts count as empty; an empty text makes its
    source a source without terms. Repeated rows are documents of their own. Other
    columns are not read. No documents give no rows.

    Memory: a map task holds ENTRIES hash entries and a piece of a text, a merging
    task a batch and one stripe, a unit UNIT_TERMS stripes and the sums of
    UNIT_SOURCES sources against all of the language; a language with more
    sources has its stripes in several units. The report has a row per pair of
    sources by its nature. Nothing reaches the driver.
    """
    lang, source = (F.coalesce(docs[c].cast("string"), F.lit("")) for c in (lang_col, source_col))
    kept = stripes(docs, lang, source, docs[text_col]).where(F.col("docs") >= min_docs)
    kept = settled(kept.select("lang", F.col("term").cast("string").alias("term"), "sources", "counts"), "stripes")
    groups = docs.select(lang.alias("lang"), source.alias("source")).distinct()
    cells = kept.select("lang", F.inline(F.arrays_zip("sources", "counts")))
    sums = cells.groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    of_source = settled(
        groups.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "sources"
    )
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    of_lang = of_source.groupBy("lang").agg(F.count("*").alias("members"), F.sum("n").alias("lang_n"))
    of_lang = settled(
        of_lang.join(n_terms, "lang", "left").select(
            "lang",
            "lang_n",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            F.greatest(F.lit(1), F.ceil(F.col("terms") / UNIT_TERMS)).cast("int").alias("slices"),
            F.ceil(F.col("members") / UNIT_SOURCES).cast("int").alias("blocks"),
        ),
        "languages",
    )

    def numbered(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    sizes = of_lang.select("lang", "slices", "blocks")
    left = kept.join(sizes, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"), numbered("blocks").alias("block"), "term", "sources", "counts"
    )
    right = (
        of_source.join(of_lang, "lang")
        .select("lang", "source", "n", "lang_n", "terms", "slices", numbered("blocks").alias("block"))
        .select("lang", numbered("slices").alias("slice"), "block", "source", "n", "lang_n", "terms")
    )
    unit = ["lang", "slice", "block"]
    found = settled(
        left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_diverge(smoothing, top), _FOUND), "divergences"
    )
    once = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.inline(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = once.select("lang", both, F.lit("pair").alias("part"), "value")
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(own))
    most = found.where("part = 'term'").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.select(*columns).unionByName(most.select(*columns))
