"""The corpus pipeline: stages over `documents`, each written and read again before the next.

Languages are identified, missing ones filled in, and texts in none of them go; one document of each group of near-duplicates
stays; secrets are masked; sources are mixed to target weights, documents left out or repeated; and
what the mix takes is packed into token sequences. All but the last stage return the columns of
`documents`, whatever others the input has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.llm import langid, minmax, mixing, packing, secret_scan
from eigenpool.llm.common import documents
from eigenpool.session import cut_lineage

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}

#: Share of common shingles from which two documents are near-duplicates.
NEAR_PERCENT = 80


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language, and writes the language found where `lang` is null.

    Null texts and texts without a letter go, and so do texts whose decoding is ambiguous or whose best codeword
    loses more than `langid.LOSS_LIMIT`. A language near which more than a hundredth of the held-out texts would go
    that way can't be told, and takes no text with it; each language is judged on its own. Where fewer than two
    languages can be learned, there is nothing to tell apart: all documents stay as they are.
    """
    docs = _columns(docs)
    model = langid.fit(docs)
    return langid.decided(docs, model, langid.trusted(docs)) if len(model.languages) > 1 else docs


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates, linked from `NEAR_PERCENT` on.

    Null ids come last; of different texts with that id in one group, the one with the smallest hash stays.
    Rows are told apart by id and text, and of rows equal in both, one stays. Documents without words are
    in no group and stay.
    """
    docs = _columns(docs)
    found = cut_lineage(minmax.groups(docs, NEAR_PERCENT).select("doc_id", "text_hash", "group"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    chosen = found.where("group is not null").groupBy("group").agg(first).select("first.doc_id", "first.text_hash")
    chosen = chosen.unionByName(found.where("group is null").select("doc_id", "text_hash").distinct())
    chosen = cut_lineage(chosen.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash")), "kept")
    stay = docs.withColumn("own_hash", F.xxhash64("text")).join(chosen, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("own_hash") == F.col("k_hash")), "left_semi")
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        stay = stay.dropDuplicates(["doc_id", "own_hash"])
    return stay.select(*COLUMNS)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks all secrets; every document stays, `n_chars` follows the text."""
    clean = secret_scan.masked(_columns(docs), secret_scan.ledger_path(spark))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    docs = _columns(docs)
    found = mixing.mix(docs).where("copies > 0").groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    found = cut_lineage(found, "copies")
    repeated = found.where("rows > 1").limit(1).count()
    found = found.select(F.col("doc_id").alias("c_id"), F.col("source").alias("c_source"), "text_hash", "copies")
    rows = docs.withColumn("own_hash", F.xxhash64("text"))
    if repeated:
        rows = rows.dropDuplicates(["doc_id", "source", "own_hash"])
    taken = rows.join(found, F.col("doc_id").eqNullSafe(F.col("c_id")) & F.col("source").eqNullSafe(F.col("c_source")) & (F.col("own_hash") == F.col("text_hash")))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences."""
    return packing.packed(docs)


STAGES = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("secrets", mask),
    ("mixing", mix),
    ("packing", pack),
]

#: Mixing and language models have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
