"""Near-duplicates of word-shingle sets by min-max hashing.

Each permutation of a document's shingle hashes gives two values of the signature, its minimum and
its maximum, so half as many hashes are computed. Bands of values are the keys of buckets. Documents
with equal sets are one node from the start. Nodes are compared on their full sets, first each with
the smallest node of its buckets. Buckets that still hold several components then are either small,
and all their pairs across components are compared, or their nodes go through an exact prefix join:
two sets that are similar enough share one of their rarest shingles, at places that leave room for
enough others. So no bucket's pairs are written out however many similar texts it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.linking import link_nodes
from eigenpool.session import cut_lineage

SHINGLE = 5
PERCENT = 85
#: A pair at the wanted similarity shares no bucket with at most this probability; bands follow from it.
MISS = 2e-5
#: Permutations of all bands; as many values a band as fit, since more of them let in fewer pairs below.
PERMUTATIONS = 100
#: Words remembered in one worker, to hash each only once.
WORD_CACHE = 200_000
SLICE = 1 << 14
#: Buckets with more nodes go through the prefix join; its counters of shingles.
SMALL_BUCKET = 16
COUNTER_BITS = 20
#: Words of the bitmap of documents met in buckets: 2^24 bits. Once it fills, more texts are read for nothing.
BITMAP_WORDS = 1 << 18

_rng = np.random.default_rng(8)
_MULTIPLY = _rng.integers(1, 1 << 63, size=PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, size=PERMUTATIONS, dtype=np.uint64)


class Words(dict):
    """Eight bytes of hash per word; forgets when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORD_CACHE:
            self.clear()
        got = self[word] = xxhash.xxh3_64_digest(word)
        return got


def shingles(text: str | None, words: Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; with fewer words, of the whole sequence."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(words.__getitem__, found)), dtype=np.uint64)
    width = min(size, len(h))
    mixed = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i:len(h) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def meets(percent: int, values: int) -> float:
    """Least probability that a band of so many values is equal for two sets of that similarity or more.

    One permutation's minimum and maximum are both equal with probability i (i - 1) / (u (u - 1)) for
    i of u shingles in common, so small sets meet least.
    """
    pair = 1.0
    for u in range(2, 1_001):
        i = -(-percent * u // 100)
        pair = min(pair, i * (i - 1) / (u * (u - 1)))
    return pair ** (values // 2) * (percent / 100) ** (values % 2)


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, values a band) for a similarity: 24 of 6 at 85 percent, 32 of 5 at 80."""
    best = None
    for values in range(1, 21):
        chance = meets(percent, values)
        bands = 1 if chance >= 1 else ceil(log(MISS) / log(1 - chance)) if chance > 0 else PERMUTATIONS + 1
        if bands * -(-values // 2) <= PERMUTATIONS:
            best = bands, values
    if best is None:
        raise ValueError(f"{PERMUTATIONS} permutations are too few for {percent} percent")
    return best


def signature(found: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum of the set under each permutation."""
    low = np.full(permutations, ~np.uint64(0))
    high = np.zeros(permutations, dtype=np.uint64)
    multiply, add = _MULTIPLY[:permutations, None], _ADD[:permutations, None]
    for at in range(0, len(found), SLICE):
        hashed = found[None, at:at + SLICE] * multiply + add
        hashed ^= hashed >> np.uint64(32)
        np.minimum(low, hashed.min(axis=1), out=low)
        np.maximum(high, hashed.max(axis=1), out=high)
    return np.stack([low, high], axis=1).reshape(-1)


def band_keys(found: np.ndarray, n_bands: int, values: int) -> np.ndarray:
    """One 64-bit key for each band of the signature; no two bands share a permutation."""
    bands = signature(found, n_bands * -(-values // 2)).reshape(n_bands, -1)
    keys = np.arange(1, n_bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for i in range(values):
        keys = (keys ^ bands[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _describe(n_bands: int, values: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch["text"]:
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(found, n_bands, values) if len(found) else None)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["text_hash"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
            ], names=["doc_id", "text_hash", "n_shingles", "digest", "keys"])

    return describe


def _slots(first_id):
    """The place of an id in the bitmap; null ids share one."""
    return F.pmod(F.xxhash64(F.lit("met"), F.col(first_id)), F.lit(BITMAP_WORDS * 64))


def bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of the ids (first_id): those it lacks are surely not among them."""
    words = ids.select(_slots("first_id").alias("s")).groupBy(F.floor(F.col("s") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits")).toPandas()
    out = np.zeros(BITMAP_WORDS, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _sets(bits: np.ndarray):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            slot = batch["slot"].to_numpy()
            hit = np.flatnonzero(bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1))
            found = [shingles(batch["text"][i].as_py(), words).tobytes() for i in hit]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].take(pa.array(hit)), pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.binary())],
                names=["doc_id", "digest", "shingles"])

    return sets


def _linked(percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["set_a"], batch["set_b"], strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return links


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; `sets` is (nid, n, shingles)."""
    full = sets.select("nid", "n", "shingles")
    with_b = pairs.join(full.toDF("b", "n_b", "set_b"), "b")
    right = full.toDF("own", "n_a", "set_a")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    both = with_b.join(right, (F.col("a") == F.col("own")) & fits).select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_linked(percent), "a long, b long")


def _slot(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for batch in batches:
        for found in batch["shingles"]:
            np.add.at(total, _slot(np.frombuffer(found.as_buffer(), dtype=np.uint64)), 1)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])


def _prefixes(counts: np.ndarray, percent: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch["shingles"]:
                found = np.frombuffer(found.as_buffer(), dtype=np.uint64)
                order = np.lexsort((found, counts[_slot(found)]))
                out.append(found[order[:len(found) - -(-percent * len(found) // 100) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["nid"], batch["n"], batch["root"], pa.array(out, pa.list_(pa.int64()))], names=["nid", "n", "root", "prefix"])

    return prefixes


def prefix_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) across components among rows (nid, n, root, shingles); no link is missed.

    Shingles are ordered by a count of how often they occur among these nodes, rarest first; the
    counters are shared by shingles of one slot, which costs no link, as any fixed order will do. If a is the
    larger set, b the smaller, a link has a first common shingle among the first n_a - t n_a + 1 of a and
    n_b - 2t / (1 + t) n_b + 1 of b. What stands before it in either set is in one set only, so the
    places add up to at most the difference that a link may have, and what follows must hold the rest.
    """
    found = nodes.select("shingles").mapInArrow(_count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    rows = nodes.select("nid", "n", "root", "shingles").mapInArrow(_prefixes(counts, percent), "nid long, n long, root long, prefix array<long>")
    rows = cut_lineage(rows.select("nid", "n", "root", F.posexplode("prefix").alias("at", "x")), "prefixes")
    indexed = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    large = rows.select("x", *(F.col(c).alias(f"{c}_a") for c in ("nid", "n", "root", "at")))
    less = rows.where(F.col("at") < indexed).select("x", *(F.col(c).alias(f"{c}_b") for c in ("nid", "n", "root", "at")))
    room = F.floor((100 - percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    fits = (F.col("root_a") != F.col("root_b")) & (F.struct("n_b", "nid_b") < F.struct("n_a", "nid_a")) & (
        100 * F.col("n_b") >= percent * F.col("n_a")) & (F.col("at_a") + F.col("at_b") <= room)
    shared = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    fits = fits & (F.col("n_a") - F.col("at_a") >= shared) & (F.col("n_b") - F.col("at_b") >= shared)
    return large.join(less, (large["x"] == less["x"]) & fits).select(F.col("nid_a").alias("a"), F.col("nid_b").alias("b"))


def bucket_pairs(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs across components in rows (key, nid, root): all of small buckets, prefix pairs of the others."""
    sized = cut_lineage(mixed.join(mixed.groupBy("key").agg(F.count("*").alias("members")), "key"), "sized")
    few = sized.where(F.col("members") <= SMALL_BUCKET)
    left, right = few.select("key", F.col("nid").alias("a"), F.col("root").alias("root_a")), few.select("key", F.col("nid").alias("b"), F.col("root").alias("root_b"))
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))).select("a", "b")
    many = sized.where(F.col("members") > SMALL_BUCKET).select("nid", "root").distinct()
    nodes = cut_lineage(many.join(sets, "nid"), "prefix-nodes")
    if not nodes.limit(1).count():
        return pairs
    return pairs.unionAll(prefix_pairs(nodes, percent))


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group, component_id) for every row (doc_id, text).

    Documents are linked where 100 * intersection >= percent * union of their shingle sets. `group` is a
    number of the component, null without shingles; `component_id` is its smallest doc_id. `text_hash` is
    xxhash64 of the text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    told = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _describe(*bands_for(percent)), "doc_id long, text_hash long, n_shingles long, digest binary, keys array<long>")
    told = cut_lineage(told, "described")
    # Equal sets are one node. Groups are partly aggregated before the shuffle.
    nodes = told.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    nodes = cut_lineage(cut_lineage(nodes, "nodes").withColumn("nid", F.monotonically_increasing_id()), "numbered")
    first = told.join(nodes, (told["digest"] == nodes["digest"]) & told["doc_id"].eqNullSafe(nodes["first_id"]))
    keyed = cut_lineage(first.select(F.explode("keys").alias("key"), "nid"), "keyed")
    shared = keyed.groupBy("key").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi")).where("lo < hi").select("key")
    buckets = cut_lineage(keyed.join(shared, "key"), "buckets")
    met = cut_lineage(buckets.select("nid").distinct().join(nodes, "nid"), "met")
    # Only texts that may be met are turned into sets again, so the others' texts cross no shuffle.
    placed = docs.select("doc_id", _slots("doc_id").alias("slot"), "text")
    again = placed.mapInArrow(_sets(bitmap(met)), "doc_id long, digest binary, shingles binary")
    again = again.join(met, (again["digest"] == met["digest"]) & again["doc_id"].eqNullSafe(met["first_id"])).select("nid", "n", "shingles")
    sets = cut_lineage(again.dropDuplicates(["nid"]), "sets")
    roots = link_nodes(buckets, lambda pairs: confirm(pairs, sets, percent), lambda mixed: bucket_pairs(mixed, sets, percent))
    if roots is None:
        named = nodes.select("digest", F.col("nid").alias("group"), F.col("first_id").alias("component_id"))
    else:
        rooted = nodes.join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
        names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = rooted.join(names, "root").select("digest", F.col("root").alias("group"), "component_id")
    out = told.join(cut_lineage(named, "named"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", "group", component.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row (doc_id, text).

    Documents are linked where 100 * intersection >= percent * union of their shingle sets;
    `component_id` is the smallest doc_id reachable. Null, empty and wordless texts have no
    shingles and are linked with nothing, each a component of its own. Null ids never name a
    component unless all its ids are null; then component_id is null and its rows are kept. A
    repeated row gets its document's values. Other columns are ignored; no rows give no rows.
    """
    return groups(docs, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
