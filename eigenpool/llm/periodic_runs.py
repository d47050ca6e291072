"""Periodic runs of words inside documents, found from an enhanced suffix array.

The texts of a batch become one row of word numbers. Ranks of stretches of 1, 2, 4, ... words, refined
until all suffixes of a text differ, give the suffix array, its inverse ISA, and, by comparing ranks from
the longest stretch down, the longest common prefix (LCP) of neighbours. An interval of LCP depth d holds the suffixes
that begin with the same d words. Branching-tandem test: for each suffix i outside the interval's largest child,
ISA[i + d] or ISA[i - d] inside the interval means that two equal stretches of d words stand side by side; they
branch where the word after them differs. Every run ends in exactly one such square of its period.
Rotating that square to the left, as long as words d apart are equal, gives the run; squares of
multiples of the period end in the same stretch and are merged into it. Intervals are read off a stack while the LCP values
pass by, so no tree is built.

Each document is searched for itself, so nothing is shuffled. Work is O(n log n) for n words, however
periodic they are; a task holds one slice of `SLICE_BYTES` of text, or one document if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import WORD, let

#: Words that a run has at least.
MIN_LENGTH = 12
#: Text taken at a time inside a task; a longer document is taken alone.
SLICE_BYTES = 4 << 20
#: Suffixes of small children tested at a time.
TEST_ROWS = 2 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Ranks:
    """Suffix array of texts laid end to end, and the ranks of their stretches of 2^k words."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        """`codes` are word numbers, `bounds` the places where texts begin, and the end."""
        n = len(codes)
        sizes = np.diff(bounds)
        self.codes = codes
        self.begin = np.repeat(bounds[:-1], sizes)
        self.end = np.repeat(bounds[1:], sizes)
        key = self.begin.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
        self.levels: list[np.ndarray] = []
        places = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        first = self._first(key[places])
        rank[places] = first
        open_ = self._open(first)
        places = places[open_]
        step = 1
        while len(places):  # places whose stretch of `step` words occurs again in its text
            self.levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
            after = places + step
            inside = after < self.end[places]
            key = rank[places] * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
            order = np.argsort(key, kind="stable")
            places, key = places[order], key[order]
            old, first = rank[places], self._first(key)
            rank[places] = old + first - self._first(old)
            places = places[self._open(first)]
            step *= 2
        self.isa = rank
        self.sa = np.empty(n, np.int64)
        self.sa[rank] = np.arange(n)

    @staticmethod
    def _first(ordered: np.ndarray) -> np.ndarray:
        """For each place the first place with an equal value."""
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))

    @staticmethod
    def _open(first: np.ndarray) -> np.ndarray:
        """Whether a place shares its value with another one."""
        alone = np.ones(len(first), bool)
        same = first[1:] == first[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        return ~alone

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b on, places of one text, are equal."""
        a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        limit = self.end[a]
        for k in range(len(self.levels) - 1, -1, -1):
            at = np.nonzero((a < limit) & (b < limit))[0]
            at = at[self.levels[k][a[at]] == self.levels[k][b[at]]]
            for moved in (a, b, length):
                moved[at] += 1 << k
        return length

    def common_before(self, a: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words before a equal those a period further on."""
        at, limit = a.copy(), self.begin[a]
        for k in range(len(self.levels) - 1, -1, -1):
            left = at - (1 << k)
            go = np.nonzero(left >= limit)[0]
            go = go[self.levels[k][left[go]] == self.levels[k][left[go] + period[go]]]
            at[go] = left[go]
        return a - at

    def lcp(self) -> np.ndarray:
        """Common words of each suffix with the one before it in the suffix array, 0 for the first of a text."""
        out = np.zeros(len(self.sa), np.int64)
        if self.levels:
            start = self.levels[0][self.sa]
            at = np.nonzero(start[1:] == start[:-1])[0] + 1
            out[at] = self.common(self.sa[at - 1], self.sa[at])
        return out


def intervals(lcp: np.ndarray) -> np.ndarray:
    """Rows (first, last, depth, first of the largest child, its size) of all LCP intervals deeper than 0."""
    found: list[tuple[int, int, int, int, int]] = []
    open_: list[list[int]] = []  # depth, first, first of the largest child so far, its size
    for r, depth in enumerate([*lcp[1:].tolist(), 0], 1):
        if not depth and not open_:
            continue
        child = r - 1  # the child that ends before r begins here
        while open_ and open_[-1][0] > depth:
            d, first, big, size = open_.pop()
            found.append((first, r - 1, d, big, size) if size >= r - child else (first, r - 1, d, child, r - child))
            child = first
        if not depth:
            continue
        if open_ and open_[-1][0] == depth:
            if r - child > open_[-1][3]:
                open_[-1][2:] = child, r - child
        else:
            open_.append([depth, child, child, r - child])
    return np.array(found, np.int64).reshape(-1, 5)


def branching_squares(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every square that doesn't stay one when moved a word to the right."""
    first, last, depth, big, size = intervals(ranks.lcp()).T
    # what lies beside the largest child, in two stretches of ranks
    low, count = np.concatenate([first, big + size]), np.concatenate([big - first, last + 1 - big - size])
    which = np.tile(np.arange(len(first)), 2)[count > 0]
    low, count = low[count > 0], count[count > 0]
    squares = []
    cuts = np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + TEST_ROWS, TEST_ROWS), side="right")
    for a, b in zip(cuts, cuts[1:], strict=False):
        many = count[a:b]
        if not len(many):
            continue
        own = np.repeat(which[a:b], many)
        rank = np.arange(many.sum()) + np.repeat(low[a:b] - np.cumsum(many) + many, many)
        i, d = ranks.sa[rank], depth[own]
        for left in (i, i - d):  # the square's place, if its other half is in the interval too
            right = left + d
            other = right if left is i else left
            at = np.nonzero((left >= ranks.begin[i]) & (right < ranks.end[i]))[0]
            seen = ranks.isa[other[at]]
            at = at[(seen >= first[own[at]]) & (seen <= last[own[at]])]
            after = right[at] + d[at]
            inside = after < ranks.end[i[at]]
            same = ranks.codes[np.where(inside, after, 0)] == ranks.codes[right[at]]
            at = at[~(inside & same)]
            squares.append(np.stack([left[at], d[at]]))
    if not squares:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, period = np.unique(np.concatenate(squares, axis=1), axis=1)
    return place, period


def runs_of(codes: np.ndarray, bounds: np.ndarray, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of all runs, ordered by start and period; places count through all texts."""
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    ranks = Ranks(codes, bounds)
    place, period = branching_squares(ranks)
    start = place - ranks.common_before(place, period)
    end = place + 2 * period
    keep = end - start >= least
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort([period, start])
    return start[order], (end - start)[order], period[order]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most SLICE_BYTES of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    a = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > a and total + size > SLICE_BYTES:
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += size
    if a < batch.num_rows:
        yield batch.slice(a)


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, one after the other, and where each text's begin."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = split.flatten(), np.asarray(split.offsets, np.int64)
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # a blank at either end leaves an empty one
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets]
    return flat.filter(pa.array(real)).dictionary_encode(), bounds


def _search(batch: pa.RecordBatch, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, runs and collapsed text of each row."""
    words, bounds = _words(batch["text"])
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = runs_of(codes, bounds, least)
    row = np.searchsorted(bounds, start, side="right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - bounds[row]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(bounds))).astype(np.int32)), runs)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    texts = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(kept)).dictionary_decode().cast(pa.string()))
    return pa.array(np.diff(bounds)), runs, pc.binary_join(texts, " ")


def find(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row (doc_id, text).

    `runs` are all stretches of at least `least` words and two periods that repeat with a smallest period, as far
    as they reach, ordered by start and period. `collapsed` are the words, joined by one blank, without those that some run
    holds after its first period. Null and empty texts have no words, no runs and an empty collapsed text. Rows
    are independent: ids may be null or repeated, and other columns are ignored.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                columns = [part["doc_id"], *_search(part, least)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which one document in ten ends in a loop over words of its own.

    With h the crc32 of the id and g = h // 10, documents with h % 10 = 0 loop from word a = g % n on with a period
    of 1 + (n - a) // (3 + g % 8) words. The others, those without words and those without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    g = F.floor(h / 10)

    def loop(words: Column) -> Column:
        n = F.size(words)
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(words, i.cast("int"))), " ")).otherwise("")

    text = F.col("text").cast("string")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(h % 10 == 0, let(words, loop)).otherwise(text).alias("text"))


def longest(runs: Column) -> Column:
    """The run with the greatest length, of equals the one that starts first, then the shorter period; null without runs."""
    best = F.sort_array(F.transform(runs, lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"))))
    return let(F.get(best, F.lit(0)), lambda b: F.when(b.isNotNull(), F.struct(
        b["start"].alias("start"), (-b["by"]).alias("length"), b["period"].alias("period"))))


def listed(runs: Column) -> Column:
    """One line `start,length,period` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
