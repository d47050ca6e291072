"""Secret scans over an incremental ledger of blobs.

Every version of a document is addressed by the SHA-256 of its text. The ledger, a Parquet table,
holds for each blob the rules it was scanned with, each with its version, and the spans found. Only
pairs of blob and rule version that the ledger lacks are scanned, each blob once however many
paths share it, and the findings are joined back to all paths. `ledger_path` is the ledger of a
session: where `spark.eigenpool.secrets.ledger` names one, it lasts from run to run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.session import cut_lineage, scratch_path

LEDGER_SETTING = "spark.eigenpool.secrets.ledger"
LEDGER = "blob string, rules array<string>, spans array<struct<rule: string, start: bigint, stop: bigint>>"


@dataclass(frozen=True)
class Rule:
    """A pattern; of its matches those count whose `group` has at least `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: Column) -> Column:
        """Code point spans (rule, start, stop) of the leftmost matches that don't overlap."""
        step = F.arrays_zip(F.split(text, self.pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0)).alias("hit"))

        def add(state: Column, x: Column) -> Column:
            start = state["at"] + F.length(x["gap"])
            stop = start + F.coalesce(F.length(x["hit"]), F.lit(0))
            inner = x["hit"] if self.group == 0 else F.regexp_extract(x["hit"], self.pattern, self.group)
            found = F.struct(F.lit(self.name).alias("rule"), start.cast("long").alias("start"), stop.cast("long").alias("stop"))
            counts = x["hit"].isNotNull() & (F.length(inner) >= self.least)
            return F.struct(stop.cast("long").alias("at"), F.when(counts, F.concat(state["spans"], F.array(found))).otherwise(state["spans"]).alias("spans"))

        none = F.array().cast("array<struct<rule: string, start: bigint, stop: bigint>>")
        walked = F.aggregate(step, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add, lambda s: s["spans"])
        return F.when(text.rlike(self.pattern), walked).otherwise(none)


# The base rules, in the order in which equal starts are listed.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
# Published prefixes and shapes of further credentials.
MORE = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", 1, r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE + MORE


def ledger_path(spark: SparkSession) -> str:
    """The folder that LEDGER_SETTING names; a new one beside the other written tables where it is unset."""
    return spark.conf.get(LEDGER_SETTING, None) or scratch_path(spark, "blob-ledger")


def read_ledger(spark, path: str) -> DataFrame | None:
    """(blob, rules, spans), one row a blob; None where nothing was written yet."""
    try:
        rows = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # a blob has one row for each scan that found it lacking a rule, at most one a rule version
    return rows.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("rules"), F.flatten(F.collect_list("spans")).alias("spans"))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row (doc_id, text); spans are (kind, start, stop), sorted.

    Sorted by start, then by the order of `rules`. Null texts are empty and have no spans. Rows that
    repeat an id or a text are versions and paths of their own. Ids may be null; other columns are
    ignored. Scans are added to the ledger at the path; findings of other versions of a rule stay there but aren't
    returned.
    """
    spark, names = versions.sparkSession, [r.name for r in rules]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    versions = versions.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    address = F.sha2(F.col("text"), 256)
    paths = cut_lineage(versions.select("doc_id", address.alias("blob")), "paths")
    # the path whose text is scanned, and how many rows it has
    counted = paths.groupBy("blob", "doc_id").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rows")).alias("first")
    blobs = counted.groupBy("blob").agg(first).select("blob", F.col("first.doc_id").alias("first_id"), "first.rows")
    known = read_ledger(spark, ledger)
    wanted = F.array(*map(F.lit, names))
    if known is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        lacking = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
        todo = blobs.join(known.select("blob", "rules"), "blob", "left").withColumn("todo", lacking).where(F.size("todo") > 0).drop("rules")
    # One row of each blob is scanned; a blob whose ids are all null is found by its address.
    todo = cut_lineage(todo.select("blob", "todo", "rows", F.coalesce(F.col("first_id").cast("string"), "blob").alias("key")), "unseen")
    repeated = todo.where("rows > 1").limit(1).count()
    todo = todo.drop("rows")
    keyed = versions.select(F.coalesce(F.col("doc_id").cast("string"), address).alias("key"), "text")
    if repeated:
        # rows equal in path and text become one inside the map tasks already, so a text with very many rows is no hot key
        unseen = keyed.withColumn("blob", address).dropDuplicates(["key", "blob"]).join(todo, ["key", "blob"])
    else:
        unseen = keyed.join(todo, "key").where(address == F.col("blob"))
    found = F.flatten(F.array(*(
        F.when(F.array_contains("todo", r.name), r.spans(F.col("text"))).otherwise(F.array().cast("array<struct<rule: string, start: bigint, stop: bigint>>"))
        for r in rules)))
    scanned = unseen.select("blob", F.col("todo").alias("rules"), found.alias("spans"))
    scanned.write.mode("append").parquet(ledger)
    order = F.create_map(*(F.lit(x) for i, n in enumerate(names) for x in (n, i)))
    hits = read_ledger(spark, ledger).where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).where(F.col("s.rule").isin(names))
    hits = hits.select("blob", F.struct(F.col("s.start").alias("start"), order[F.col("s.rule")].alias("place"), F.split("s.rule", "@")[0].alias("kind"), F.col("s.stop").alias("stop")).alias("s"))
    hits = hits.groupBy("blob").agg(F.array_sort(F.collect_set("s")).alias("s"))
    hits = cut_lineage(hits.select("blob", F.transform("s", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))).alias("spans")), "findings")
    none = F.array().cast("array<struct<kind: string, start: bigint, stop: bigint>>")
    return paths.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:stop of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def masked(docs: DataFrame, ledger: str, mask: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs with every span of their text replaced by the mask; columns and rows stay, whatever the columns' names."""
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so the names below are new
    address, blob, spans = free + "address", free + "blob", free + "spans"
    found = scan(docs, ledger, rules).where(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    rows = docs.withColumn(address, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    rows = rows.join(found, F.col(address) == F.col(blob), "left")

    def add(state: Column, s: Column) -> Column:
        # spans of several kinds may overlap: what lies before `at` is gone already
        fresh = F.concat(state["out"], F.substr(F.col("text"), (state["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - state["at"]).cast("int")), F.lit(mask))
        inside = s["start"] < state["at"]
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.when(inside, state["out"]).otherwise(fresh).alias("out"))

    walked = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), add,
                         lambda s: F.concat(s["out"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(walked)
    return rows.select(*((clean.alias(c) if c == "text" else F.col(f"`{c}`")) for c in docs.columns))
