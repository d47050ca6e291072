"""Document fingerprints by SimHash.

The terms of a text are its runs of five words, as often as they occur. Each term's 64-bit hash
votes on 64 signed bits with the term's weight; the signs of the sums are the fingerprint. All
fingerprints within a Hamming radius are found over permuted block tables: 64 bits are cut into
radius + 3 blocks, any three of which are equal for such a pair, so every choice of three blocks
is a table's key. Votes for two bits are summed in one number, so a text needs 32 sums.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import BLANK, ordinal
from eigenpool.llm.linking import link_nodes
from eigenpool.session import cut_lineage

TERM_WORDS = 5
BITS = 64
RADIUS = 3
KEY_BLOCKS = 3


def terms(text: Column) -> Column:
    """Array of structs of five words; with fewer words, of the whole sequence and nulls."""
    words = F.array_remove(F.split(text, BLANK), "")

    def runs(w: Column) -> Column:
        n = F.size(w) - (TERM_WORDS - 1)
        names = [f"w{i}" for i in range(TERM_WORDS)]
        short = F.array(F.struct(*(F.get(w, F.lit(i)).alias(c) for i, c in enumerate(names))))
        zipped = F.arrays_zip(*(F.slice(w, F.lit(i + 1), F.greatest(n, F.lit(0))).alias(c) for i, c in enumerate(names)))
        return F.when(n > 0, zipped).when(F.size(w) > 0, short)

    return F.transform(F.array(words), runs)[0]


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, fp) for rows (*keys, text); texts without a word get 0. Equal texts get equal values."""
    words = [f"w{i}" for i in range(TERM_WORDS)]
    hashed = rows.select(*keys, F.inline_outer(terms(F.col("text")))).select(
        *keys, F.when(F.col("w0").isNotNull(), F.xxhash64(*words)).alias("h"))
    half = BITS // 2
    both = F.lit((1 << half) + 1)
    votes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(both)).alias(f"v{j}") for j in range(half)]
    summed = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *votes)
    low = F.lit((1 << half) - 1)
    fp = F.lit(0).cast("long")
    for j in range(half):
        for bit, ones in ((j, F.col(f"v{j}").bitwiseAND(low)), (j + half, F.shiftrightunsigned(f"v{j}", half))):
            mask = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(2 * ones > F.col("n"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(nid, root) for the distinct fingerprints (nid) with another one within the radius.

    `root` is the smallest fingerprint reachable by steps within the radius.
    """
    blocks = radius + KEY_BLOCKS
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    cut = [F.shiftrightunsigned("nid", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    tables = [F.xxhash64(F.lit(t), *(cut[i] for i in chosen)) for t, chosen in enumerate(combinations(range(blocks), KEY_BLOCKS))]
    keyed = cut_lineage(prints.select("nid", F.explode(F.array(*tables)).alias("key")), "block-tables")
    shared = keyed.groupBy("key").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi")).where("lo < hi").select("key")
    buckets = cut_lineage(keyed.join(shared, "key"), "block-buckets")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius

    def candidates(mixed: DataFrame) -> DataFrame:
        # the distance is part of the join's condition, so only links leave it
        left = mixed.select("key", F.col("nid").alias("a"), F.col("root").alias("root_a"))
        right = mixed.select("key", F.col("nid").alias("b"), F.col("root").alias("root_b"))
        return left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & near).select("a", "b")

    roots = link_nodes(buckets, lambda pairs: pairs.where(near), candidates)
    return prints.sparkSession.createDataFrame([], "nid long, root long") if roots is None else roots


def with_edited(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, next_id, next_hash, n_chars, text, edited), one row a distinct document.

    `edited` is the text whose last floor(n / 2) code points are replaced by the first as many, or
    all, of the next document's by descending id (null last, equal ids by hash of the text; after the
    last comes the first). Rows equal in id and text are one document.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    ids = cut_lineage(rows.groupBy("doc_id", "text_hash", F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("times")), "ids")
    placed = cut_lineage(ordinal(ids, [F.col("doc_id").desc_nulls_last(), F.col("text_hash")], "descending"), "placed")
    size = placed.agg(F.count("*").alias("n"), F.max("times").alias("times")).first()
    # each document's predecessor, which wants the beginning of its text
    before = placed.select(
        ((F.col("ord") + 1) % F.lit(max(1, size["n"]))).alias("b_ord"), F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"),
        F.floor(F.col("n_chars") / 2).alias("b_need"))
    chain = placed.join(before, F.col("ord") == F.col("b_ord")).select(
        F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "n_chars", "b_id", "b_hash", "b_need")
    # a null id joins as an empty key beside the hash
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    chain = cut_lineage(chain.withColumn("c_key", key("c_id")).withColumn("b_key", key("b_id")), "chain")
    rows = rows.withColumn("key", key("doc_id"))
    if (size["times"] or 0) > 1:
        rows = rows.dropDuplicates(["key", "text_hash"])
    texts = rows.join(chain, (F.col("key") == F.col("c_key")) & (F.col("text_hash") == F.col("c_hash")))
    starts = texts.select(
        F.col("b_key"), F.col("b_hash"), F.col("doc_id").alias("next_id"), F.col("text_hash").alias("next_hash"),
        F.substr(F.col("text"), F.lit(1), F.col("b_need").cast("int")).alias("start"))
    kept = texts.select("key", "doc_id", "text_hash", "n_chars", "text")
    both = kept.join(starts, (F.col("key") == F.col("b_key")) & (F.col("text_hash") == F.col("b_hash")))
    head = F.substr(F.col("text"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    return both.select("doc_id", "text_hash", "next_id", "next_hash", "n_chars", "text", F.concat(head, "start").alias("edited"))


def fingerprint(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for every row (doc_id, text): its fingerprint, its edited text's, and likenesses.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex digits), near_edited,
    near_next (share of equal bits with the edited text's and the next document's fingerprint), near_class
    (fingerprint that stands for all reachable in steps within the radius). Null texts are
    empty, and fingerprint 0. A single document is its own next. Repeated rows get equal rows; ids may
    be null; other columns are ignored; no rows give no rows.
    """
    pairs = with_edited(docs)
    keys = ["doc_id", "text_hash", "next_id", "next_hash", "n_chars", "sha", "which"]
    sha = F.sha2("edited", 256).alias("sha")
    variants = pairs.select(*keys[:5], sha, F.inline(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))))
    voted = cut_lineage(fingerprints(variants, keys), "fingerprints")
    own = voted.where("which = 0").drop("which")
    edited = voted.where("which = 1").select(F.col("doc_id").alias("e_id"), F.col("text_hash").alias("e_hash"), F.col("fp").alias("edited_fp"))
    nexts = voted.where("which = 0").select(F.col("doc_id").alias("x_id"), F.col("text_hash").alias("x_hash"), F.col("fp").alias("next_fp"))
    roots = near_classes(voted.where("which = 0").select(F.col("fp").alias("nid")).distinct(), radius)
    roots = cut_lineage(roots, "near-classes").select(F.col("nid").alias("r_fp"), "root")
    out = own.join(edited, F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("text_hash") == F.col("e_hash")))
    out = out.join(nexts, F.col("next_id").eqNullSafe(F.col("x_id")) & (F.col("next_hash") == F.col("x_hash")))
    out = out.join(roots, F.col("fp") == F.col("r_fp"), "left")
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    out = out.select(
        "doc_id", "text_hash", "n_chars", F.col("sha").alias("edited_sha256"), digits("fp").alias("fingerprint"), digits("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        digits(F.coalesce("root", "fp")).alias("near_class"))
    out = cut_lineage(out, "likenesses")
    # back to every row, so that repeated rows get their values
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("d_id"), text_hash.alias("d_hash"))
    rows = rows.join(out, F.col("d_id").eqNullSafe(F.col("doc_id")) & (F.col("d_hash") == F.col("text_hash")))
    return rows.drop("d_id", "d_hash", "text_hash")
