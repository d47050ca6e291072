"""Packing tokenized documents into sequences by bulk-synchronous best fit.

A document is its token ids and an end token. Longer ones are cut into full sequences and one shorter
first piece, so only pieces below the sequence length need packing. Pieces are range-sorted by
length and numbered within their length; open sequences are numbered within their gap. In each
superstep, for the pieces of a range of lengths, a sweep from the longest length down gives
each length the smallest gaps that still hold it: its successors. Piece k of a length meets gap
k of the run, so ranks settle all conflicts, and pieces and gaps are joined on gap and rank. Then gaps are
updated, and the next superstep starts. Pieces of a range that no gap holds open new sequences. The
sweep itself looks only at how many pieces and gaps of each size there are: at most twice
the sequence length in numbers, however many documents there are.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import ordinal
from eigenpool.session import cut_lineage

LENGTH = 2048
END_ID = 0
#: Chunks of text remembered in one worker with their ids.
CHUNK_CACHE = 150_000
#: Each range of lengths starts at this share of the one before.
RANGE_SHARE = 0.7
#: Pieces of at most this length are one range.
LAST_RANGE = 16
# The blanks of Unicode, as the tokenizer's pattern knows them.
_BLANK = "\t-\r \x85\xa0  -     　"
# Fixed value: the tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The tokenizer never joins what a blank parts, but for one space before a word.
_CHUNK = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that a tokenizer file adds to its vocabulary, with their ids."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    odd = [t["content"] for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if odd:
        raise ValueError(f"added tokens that take blanks or word bounds along: {odd}")
    return {t["content"]: t["id"] for t in added}


def encoder(path: str):
    """The byte-level vocabulary of a tokenizer file, its ids being the ranks of its merges.

    The library that the file is made for gives the same ids at a fifth of the speed.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    added = added_tokens(path)
    # byte-level tokens are written in printable characters, the unprintable bytes in those from 256 on
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
    ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in added}  # no merge makes an added token
    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Chunks(dict):
    """Token ids of chunks as little-endian bytes, of those used lately, so memory stays bounded."""

    def __init__(self, path: str):
        super().__init__()
        self.ids, self.before = encoder(path).encode_ordinary, {}
        added = added_tokens(path)
        self.added = {t: i.to_bytes(4, "little") for t, i in added.items()}
        # the longest of those that begin at a place comes first
        self.bounds = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CHUNK_CACHE:  # what was used since the last time stays one more time
            self.before = dict(self)
            self.clear()
        got = self.before.get(chunk)
        if got is None:
            got = array("I", self.ids(chunk)).tobytes()
        self[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a text without added tokens; where they are written, they are ordinary text."""
        return b"".join(map(self.__getitem__, _CHUNK.findall(text)))

    def encode_document(self, text: str) -> bytes:
        """Ids of a text as the tokenizer file gives them: its added tokens first, then what stands between."""
        if self.bounds is None or not self.bounds.search(text):
            return self.encode(text)
        parts = self.bounds.split(text)  # added tokens are at the odd places
        return b"".join(self.added[part] if i % 2 else self.encode(part) for i, part in enumerate(parts))


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32) for every row (doc_id, text), written."""
    path = vocabulary or default_vocabulary()
    end, width = END_ID.to_bytes(4, "little"), 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            ids = batch["doc_id"].to_pylist()
            for i, (doc_id, row, text) in enumerate(zip(ids, batch["row"].to_pylist(), batch["text"], strict=True)):
                data = chunks.encode_document(text.as_py() or "") + end
                first = (len(data) - 4) % width + 4
                bounds = [0, *range(first, len(data) + 1, width)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    for column, value in zip(out, (doc_id, row, piece, a // 4, (b - a) // 4, zlib.crc32(data[a:b])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([
                pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(cut, "doc_id long, row long, piece int, start long, length long, ids_crc32 long"), "pieces")


class Sizes:
    """Ranks in use for each size: those from `head` up to `tail` are free."""

    def __init__(self, size: int):
        self.head, self.tail = [0] * (size + 1), [0] * (size + 1)

    def free(self, size: int) -> int:
        return self.tail[size] - self.head[size]


def sweep(items: Sizes, gaps: Sizes, longest: int, shortest: int) -> list[tuple[int, ...]]:
    """Runs (length, first piece, pieces, gap, first gap, gaps, pieces a gap) of one superstep.

    From the longest length down, each takes the smallest gaps that hold it. Gaps used are gone
    for this superstep; a gap takes as many pieces of the length as it holds.
    """
    runs, there = [], [g for g in range(1, len(gaps.head)) if gaps.free(g)]
    for length in range(longest, shortest - 1, -1):
        at = bisect_left(there, length)
        while items.free(length) and at < len(there):
            gap = there[at]
            each = gap // length
            used = min(gaps.free(gap), -(-items.free(length) // each))
            n = min(items.free(length), used * each)
            runs.append((length, items.head[length], n, gap, gaps.head[gap], used, each))
            items.head[length] += n
            gaps.head[gap] += used
            if not gaps.free(gap):
                there.pop(at)
    return runs


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, piece, sequence_id, offset) for written rows (row, piece, length)."""
    spark = cut.sparkSession
    full = cut.where(F.col("length") == length).select(
        "row", "piece", (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = cut.where(F.col("length") < length).select("row", "piece", F.col("length").cast("int").alias("length"))
    ranked = cut_lineage(ordinal(part, [F.col("length").desc(), F.xxhash64("row", "piece"), F.col("row"), F.col("piece")], "by-length", ["length"]), "ranked")
    items, gaps = Sizes(length), Sizes(length)
    for r in ranked.groupBy("length").count().collect():  # at most one row for each length
        items.tail[r["length"]] = r["count"]
    opened, placed, open_gaps, upper = 0, [full], None, length - 1
    while upper >= 1:
        lower = int(upper * RANGE_SHARE) + 1 if upper > LAST_RANGE else 1
        while True:
            runs = sweep(items, gaps, upper, lower) if open_gaps is not None else []
            if not runs:
                break
            open_gaps, put = _apply(spark, ranked, open_gaps, gaps, runs)
            placed.append(put)
        fresh = []
        for size in range(upper, lower - 1, -1):
            wanted, each = items.free(size), length // size
            if wanted:
                fresh.append((size, items.head[size], wanted, each, opened))
                opened += -(-wanted // each)
                items.head[size] += wanted
        if fresh:
            made, put = _open(spark, ranked, gaps, fresh, length)
            open_gaps = made if open_gaps is None else cut_lineage(open_gaps.unionByName(made), "gaps")
            placed.append(put)
        upper = lower - 1
    return reduce(DataFrame.unionByName, placed)


def _rows_of(spark, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))  # at most some thousand runs, bounded by the sequence length


def _apply(spark, ranked: DataFrame, open_gaps: DataFrame, gaps: Sizes, runs: list[tuple[int, ...]]) -> tuple[DataFrame, DataFrame]:
    """One superstep: joins pieces and gaps of the runs on gap and rank, and updates the gaps."""
    table, moves = [], []
    for length, first, n, gap, first_gap, used, each in runs:
        table.append((length, first, first + n, gap, first_gap, each))
        whole, rest = n // each, n % each
        for a, b, k in ((first_gap, first_gap + whole, each), (first_gap + whole, first_gap + used, rest)):
            if a < b:
                left = gap - k * length
                moves.append((gap, a, b, left, gaps.tail[left] - a))
                gaps.tail[left] += b - a
    run = _rows_of(spark, table, "r_length int, r_from long, r_to long, gap int, r_gap long, r_each int")
    at = ranked.join(run, (F.col("length") == F.col("r_length")) & (F.col("ord") >= F.col("r_from")) & (F.col("ord") < F.col("r_to")))
    at = at.withColumn("k", F.col("ord") - F.col("r_from")).select(
        "row", "piece", "length", "gap", (F.col("r_gap") + F.floor(F.col("k") / F.col("r_each"))).alias("rank"), (F.col("k") % F.col("r_each")).alias("nth"))
    met = at.join(open_gaps, ["gap", "rank"])
    size = F.lit(len(gaps.head) - 1)
    put = met.select("row", "piece", "sequence_id", (size - F.col("gap") + F.col("nth") * F.col("length")).cast("long").alias("offset"))
    move = _rows_of(spark, moves, "m_gap int, m_from long, m_to long, m_left int, m_shift long")
    moved = open_gaps.join(move, (F.col("gap") == F.col("m_gap")) & (F.col("rank") >= F.col("m_from")) & (F.col("rank") < F.col("m_to")), "left")
    moved = moved.select(
        "sequence_id", F.coalesce("m_left", "gap").alias("gap"), (F.col("rank") + F.coalesce("m_shift", F.lit(0))).alias("rank")).where("gap > 0")
    return cut_lineage(moved, "gaps"), cut_lineage(put, "placed")


def _open(spark, ranked: DataFrame, gaps: Sizes, fresh: list[tuple[int, ...]], length: int) -> tuple[DataFrame, DataFrame]:
    """New sequences for pieces that no gap holds, as many pieces of a length in each as it holds."""
    table = []
    for size, first, n, each, opened in fresh:
        whole, rest = n // each, n % each
        left, last_left = length - each * size, length - rest * size
        rank, last_rank = gaps.tail[left], gaps.tail[last_left] + (whole if left == last_left else 0)
        gaps.tail[left] += whole
        gaps.tail[last_left] += bool(rest)
        table.append((size, first, first + n, each, opened, whole, left, rank, last_left, last_rank))
    gaps.head[0] = gaps.tail[0]  # full sequences are no gaps
    run = _rows_of(spark, table, "r_length int, r_from long, r_to long, r_each int, r_open long, r_whole long, r_left int, r_rank long, r_last_left int, r_last_rank long")
    at = ranked.join(run, (F.col("length") == F.col("r_length")) & (F.col("ord") >= F.col("r_from")) & (F.col("ord") < F.col("r_to")))
    k = F.col("ord") - F.col("r_from")
    at = at.withColumn("own", F.floor(k / F.col("r_each"))).withColumn("nth", k % F.col("r_each")).withColumn("sequence_id", 2 * (F.col("r_open") + F.col("own")))
    put = at.select("row", "piece", "sequence_id", (F.col("nth") * F.col("length")).cast("long").alias("offset"))
    is_whole = F.col("own") < F.col("r_whole")
    new = at.where("nth = 0").select(
        "sequence_id", F.when(is_whole, F.col("r_left")).otherwise(F.col("r_last_left")).alias("gap"),
        F.when(is_whole, F.col("r_rank") + F.col("own")).otherwise(F.col("r_last_rank")).alias("rank")).where("gap > 0")
    return cut_lineage(new, "new-gaps"), cut_lineage(put, "opened")


def packed(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row (doc_id, text).

    Null and empty texts are the end token alone. Each repeated row is packed for itself; ids may
    be null. Every sequence is filled from 0 without a gap up to its last piece. No rows, no pieces.
    """
    cut = pieces(docs, vocabulary, length)
    put = pack(cut, length).select(F.col("row").alias("p_row"), F.col("piece").alias("p_piece"), "sequence_id", "offset")
    both = cut.join(put, (F.col("row") == F.col("p_row")) & (F.col("piece") == F.col("p_piece")))
    return both.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
