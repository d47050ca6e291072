"""Fill-in-the-middle transformation, its cuts located on a wavelet matrix over character classes.

A text's units are runs of ASCII letters and all other characters one by one. Every byte of UTF-8 belongs to one
of four classes: a character that is a unit by itself, a letter that begins a run, a letter inside a run, and a
continuation byte. A wavelet matrix, two bit rows with counts of their ones, answers how many bytes of a class lie
before any place. The ranks of the first two classes add up to the units begun before it, those of the first three
to the characters. The number of units follows from the rank at the end, and each cut is located by
bisection on these sums, for all texts of a slice together.

Each document is cut for itself, so nothing is shuffled; a task holds the classes of one slice of `SLICE_BYTES`, or
of one document if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import let

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Text taken at a time inside a task; a longer document is taken alone.
SLICE_BYTES = 16 << 20
SINGLE, FIRST, INNER, CONTINUED = 0, 1, 2, 3


class Bits:
    """A row of bits that counts the ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Ranks of symbols 0 to 2^levels - 1: each level sorts the row stably by one bit, from the highest down."""

    def __init__(self, symbols: np.ndarray, levels: int = 2):
        self.size, self.levels, self.rows, self.zeros = len(symbols), levels, [], []
        for level in range(levels - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            self.rows.append(Bits(bits))
            self.zeros.append(len(bits) - int(bits.sum()))
            if level:
                symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.start = [int(self._down(c, np.zeros(1, np.int64))[0]) for c in range(1 << levels)]

    def _down(self, symbol: int, at: np.ndarray) -> np.ndarray:
        for row, zeros, level in zip(self.rows, self.zeros, range(self.levels - 1, -1, -1), strict=True):
            ones = row.rank(at)
            at = zeros + ones if symbol >> level & 1 else at - ones
        return at

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often `symbol` stands before each place."""
        return self._down(symbol, at) - self.start[symbol]


def classes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The class of each byte of texts laid end to end."""
    letter = (data | 32) - np.uint8(97) < 26  # bytes below 97 wrap around
    inner = letter.copy()
    inner[1:] &= letter[:-1]
    inner[:1] = False
    begins = bounds[:-1][bounds[:-1] < len(data)]
    inner[begins] = False
    out = np.where(letter, np.where(inner, INNER, FIRST), SINGLE).astype(np.uint8)
    out[data >> 6 == 2] = CONTINUED
    return out


@dataclass(frozen=True)
class Units:
    """Units and characters before places of texts laid end to end."""

    matrix: WaveletMatrix

    def begun(self, at: np.ndarray) -> np.ndarray:
        return self.matrix.rank(SINGLE, at) + self.matrix.rank(FIRST, at)

    def characters(self, at: np.ndarray) -> np.ndarray:
        return at - self.matrix.rank(CONTINUED, at)

    def locate(self, begin: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Where the unit number `units` of each text begins, or the text's end after its last unit."""
        goal = self.begun(begin) + units
        low, high = begin.copy(), end.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            beyond = self.begun(np.minimum(middle + 1, end)) > goal
            high = np.where(beyond, middle, high)
            low = np.where(beyond, low, np.minimum(middle + 1, high))
        return low


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)
    a = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > a and total + size > SLICE_BYTES:
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += size
    if a < batch.num_rows:
        yield batch.slice(a)


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins, and the end."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def _arrange(batch: pa.RecordBatch) -> tuple[list, ...]:
    """(n, form, prefix_chars, middle_chars, output) of each row of (text, plain, spm, first, second)."""
    data, bounds = _flat(batch["text"])
    begin, end = bounds[:-1], bounds[1:]
    units = Units(WaveletMatrix(classes(data, bounds)))
    n = units.begun(end) - units.begun(begin)
    draws = [batch[c].to_numpy(zero_copy_only=False) % (n + 1) for c in ("first", "second")]
    cut = [units.locate(begin, end, draw) for draw in (np.minimum(*draws), np.maximum(*draws))]
    chars = [units.characters(at) for at in (begin, *cut)]
    raw, forms, outputs = data.tobytes(), [], []
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    plain = batch["plain"].to_pylist()
    for i, (a, b, c, d, spm) in enumerate(zip(begin.tolist(), *(x.tolist() for x in cut), end.tolist(), batch["spm"].to_pylist(), strict=True)):
        text = raw[a:d]
        plain[i] = plain[i] or not text or p in text or s in text or m in text
        forms.append("plain" if plain[i] else "spm" if spm else "psm")
        if plain[i]:
            outputs.append(text)
        elif spm:
            outputs.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
        else:
            outputs.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
    off = np.array(plain, bool)
    columns = (pa.array(chars[1] - chars[0], mask=off), pa.array(chars[2] - chars[1], mask=off))
    return pa.array(n), pa.array(forms, pa.string()), *columns, pa.array(outputs, pa.binary()).cast(pa.string())


def transform(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, salt: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row (doc_id, text).

    The text's n units are cut at two places drawn by the sha256 of salt and id. `form` is `psm` (marked prefix,
    suffix, middle), `spm` (suffix, prefix, middle) or `plain`, where the text stays as it is: empty texts, texts that
    contain a mark, and a hash-drawn share. `output` is the text in that form. Null texts count as empty; a
    null id is hashed as if it were empty. Rows are independent, ids may repeat, and other columns are ignored.
    """
    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), h[0].alias("first"), h[1].alias("second"),
        (h[2] % 100 >= 100 - plain_percent).alias("plain"), (h[3] % 100 < spm_percent).alias("spm"))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays([part["doc_id"], *_arrange(part)], names)

    return rows.mapInArrow(arrange, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _between(text: Column, *marks: str) -> Column:
    """The three parts of a text that follow three marks, the first of which it begins with.

    No part holds a mark, and a mark can't arise where a part and a mark meet, so the first place is the right one.
    """
    second, third = F.instr(text, marks[1]), F.instr(text, marks[2])
    size, end = len(marks[0]), F.length(text)
    parts = (
        F.substr(text, F.lit(size + 1), second - size - 1), F.substr(text, second + size, third - second - size),
        F.substr(text, third + size, end - third - size + 1))
    return F.struct(*(p.alias(f"part{i}") for i, p in enumerate(parts)))


def restored(output: Column, form: Column) -> Column:
    """The text that `transform` made an output from."""
    psm = let(_between(output, PREFIX, SUFFIX, MIDDLE), lambda p: F.concat(p["part0"], p["part2"], p["part1"]))
    spm = let(_between(output, SUFFIX, PREFIX, MIDDLE), lambda p: F.concat(p["part1"], p["part2"], p["part0"]))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
