"""Token counts of a sentencepiece BPE model by rank-synchronous merging of ragged arrays.

The symbols of many words lie one behind the other in one array. In each step
every word finds the lowest rank among its neighbouring pairs, and all words
apply theirs at once. What is left when no pair has a rank are the tokens.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LIMIT = 4096
#: Characters of text whose words are merged together, and words whose counts a worker remembers.
BLOCK_CHARS = 1 << 20
KNOWN_WORDS = 1 << 19
#: A word with more symbols is merged pair by pair where the order of equal ranks matters, as in long runs of blanks.
LONG = 512
_NONE = np.iinfo(np.int32).max


class PieceMerges:
    """The merges of a model, as arrays.

    Symbols are the pieces and the characters they are made of. Two neighbours
    merge if their strings together are a piece; a piece with a higher score has
    a lower rank.
    """

    def __init__(self, model: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        score = {
            sp.id_to_piece(i): sp.get_score(i) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        }
        if any(SPACE in p.lstrip(SPACE) for p in score):
            raise ValueError("models with pieces over a word's end are not supported")
        self.fallback = any(sp.is_byte(i) for i in ids)
        levels = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbols = {s: k for k, s in enumerate(dict.fromkeys([*score, *(c for p in score for c in p)]))}
        self.n = len(symbols)
        rank_of = {p: levels[s] for p, s in score.items()}
        pairs = {}
        bigrams = set()
        # A merge is safe if what it makes has a lower rank than any pair it can enter: then all
        # places of the pair may be merged in one step without changing the order.
        safe = np.ones(len(levels), bool)
        safe[[r for r, k in zip(*np.unique(list(rank_of.values()), return_counts=True)) if k > 1]] = False
        for piece, rank in rank_of.items():
            for i in range(1, len(piece)):
                left, right = piece[:i], piece[i:]
                bigrams.add(symbols[piece[i - 1]] * self.n + symbols[piece[i]])
                if left in symbols and right in symbols:
                    pairs[symbols[left] * self.n + symbols[right]] = (rank, symbols[piece])
                    for part in (left, right):
                        if part in rank_of and rank <= rank_of[part]:
                            safe[rank_of[part]] = False
        self.safe = safe
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.bigrams = np.array(sorted(bigrams), np.int64)
        self.chars = np.full(0x110000, -1, np.int32)
        self.whole = np.zeros(0x110000, bool)
        for s, k in symbols.items():
            if len(s) == 1:
                self.chars[ord(s)] = k
                self.whole[ord(s)] = s in score

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of neighbours; characters outside the model merge with nothing."""
        wanted = left.astype(np.int64) * self.n + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        known = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], _NONE), self.made[at]

    def _in_order(self, symbol: list[int], cost: list[int]) -> int:
        """What is left of a long word whose pairs of equal rank depend on their order: one merge after the other."""
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get(symbol[i] * self.n + symbol[j])):
                heapq.heappush(heap, (found[0], i, j, symbol[i], symbol[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, i, j, left, right = heapq.heappop(heap)
            if gone[i] or gone[j] or symbol[i] != left or symbol[j] != right or after[i] != j:
                continue
            symbol[i], cost[i], gone[j] = self.pairs[left * self.n + right][1], 1, True
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return sum(c for c, g in zip(cost, gone) if not g)

    def counts(self, words: list[str]) -> np.ndarray:
        """The number of tokens of every word."""
        total = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if not lengths.sum():
            return total
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(words)), lengths)
        symbol = self.chars[points]
        size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        cost = np.where(self.whole[points], 1, size if self.fallback else 1)
        # No token reaches over two characters that no piece holds side by side: words are cut there.
        beside = symbol[:-1].astype(np.int64) * self.n + symbol[1:]
        at = np.searchsorted(self.bigrams, beside)
        at[at == len(self.bigrams)] = 0
        cut = (self.bigrams[at] != beside) | (symbol[:-1] < 0) | (symbol[1:] < 0) | (word[:-1] != word[1:])
        first = np.concatenate([[True], cut])
        rank, made = np.full(len(symbol), _NONE, np.int32), np.zeros(len(symbol), np.int32)
        inner = np.flatnonzero(~first[1:])
        rank[inner], made[inner] = self._pairs(symbol[inner], symbol[inner + 1])
        while True:
            starts = np.flatnonzero(first)
            low = np.minimum.reduceat(rank, starts)
            owner = np.cumsum(first) - 1
            open_ = (low < _NONE)[owner]
            sizes = np.diff(np.append(starts, len(symbol)))
            for k in np.flatnonzero((sizes > LONG) & (low < _NONE) & ~self.safe[np.minimum(low, len(self.safe) - 1)]):
                at = slice(starts[k], starts[k] + sizes[k])
                left = self._in_order(symbol[at].tolist(), cost[at].tolist())
                cost[at], open_[at] = 0, False
                cost[starts[k]] = left
            if not open_.all():
                total += np.bincount(word[~open_], weights=cost[~open_], minlength=len(words)).astype(np.int64)
                if not open_.any():
                    return total
                symbol, cost, rank, made, word, first, owner = (x[open_] for x in (symbol, cost, rank, made, word, first, owner))
            hit = rank == low[owner]
            # Of places that overlap, and of those of an unsafe rank, the leftmost comes first.
            at = np.flatnonzero(hit)
            new_run = np.concatenate([[True], np.diff(at) > 1])
            begin = at[new_run][np.cumsum(new_run) - 1]
            leader = np.concatenate([[True], owner[at][1:] != owner[at][:-1]])
            at = at[leader | ((at - begin) % 2 == 0) & self.safe[rank[at]]]
            symbol[at], cost[at] = made[at], 1
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            symbol, cost, rank, made, word, first = (x[stay] for x in (symbol, cost, rank, made, word, first))
            moved = at - np.arange(len(at))
            changed = np.unique(np.concatenate([moved, moved[~first[moved]] - 1]))
            last = np.concatenate([first[1:], [True]])
            rank[changed[last[changed]]] = _NONE
            changed = changed[~last[changed]]
            rank[changed], made[changed] = self._pairs(symbol[changed], symbol[changed + 1])


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@functools.lru_cache(maxsize=4)
def _loaded(model: bytes) -> tuple[PieceMerges, dict[str, int]]:
    return PieceMerges(model), {}


def count_tokens(texts: list[str | None], model: bytes) -> list[int]:
    """The number of tokens of whole texts; 0 for None."""
    merges, known = _loaded(model)
    out, block, held = [], [], 0

    def flush() -> None:
        new = list({w for ws in block for w in ws if w not in known})
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = list({w for ws in block for w in ws})
        known.update(zip(new, merges.counts(new).tolist()))
        out.extend(sum(map(known.__getitem__, ws)) for ws in block)
        block.clear()

    for text in texts:
        # The model's own rules make the text ready: marks for spaces, and one before the text.
        block.append(_WORD.findall(merges.sp.normalize(text)) if text else [])
        held += len(text or "")
        if held >= BLOCK_CHARS:
            flush()
            held = 0
    flush()
    return out


def token_column(text: Column, model: bytes) -> Column:
    @F.pandas_udf("bigint")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(count_tokens(texts.tolist(), model), dtype="int64")

    return tokens(text)


def count(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens`, `over_limit` for every row, whole texts.

    Counts are those of the model's library without begin or end tokens. NULL is
    an empty text: 0 bytes, 0 tokens. Repeated rows and NULL ids come out as they
    went in. Other columns are not read. The model file is read by the driver and
    goes out with the function; it is below a few MB whatever the input.
    """
    model = Path(model_path).read_bytes()
    text = docs[text_col]
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_column(text, model).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
