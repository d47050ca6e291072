"""Mixing sources to target weights by pivotal rounding of copy counts.

A document of a source with rate `target / size` gets the whole part of the rate as copies, and
one more with the fractional part as its probability. Pivotal rounding pairs two documents of a
source and moves mass between them, keeping the sum of words, until one probability is 0 or 1; the
other goes on. Documents are paired in bounded runs, the one rest of each run is paired again one
level up, and so on: a tree with as many levels as the logarithm of the rows. At the root one
document a source remains and is rounded by its own probability, so a source misses its target by
less than the words of one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import WORD, let, ordinal, small, unit
from eigenpool.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SHARE = 1.0
#: Documents in one run of the tree.
RUN = 128
SEED = 20_25


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: float = CAP, share: float = SHARE) -> tuple[DataFrame, int]:
    """(source, source_size, weight, target) and the number of sources, from rows (source, size).

    Weights go round the sources in code point order, null last. No target passes `cap` times its
    source's size; the excess is shared by weight among the others until none is above.
    """
    sources = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = ordinal(sources, [F.col("source").asc_nulls_last()], "source-order")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("ord") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.select("source", "source_size", weight.alias("weight"), "ord"), "source-weights")
    first = ranked.agg(F.count("*").alias("n"), F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = share * (first["size"] or 0)
    full = F.col("source_size") * F.lit(cap)
    level = wanted / first["weight"] if first["n"] else 0.0
    stuck = -1
    while True:
        above = full <= F.lit(level) * F.col("weight")
        got = ranked.agg(
            F.sum(F.when(above, full)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("free"),
            F.count(F.when(above, 1)).alias("stuck")).first()
        if got["stuck"] == stuck or not got["free"]:
            break
        stuck = got["stuck"]
        level = max(level, (wanted - (got["full"] or 0.0)) / got["free"])
    target = F.when(full <= F.lit(level) * F.col("weight"), full).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target")), first["n"]


def _move(state: Column, x: Column, seed: int, level: int) -> Column:
    """One pivotal step: the rest so far against the next document."""
    r = state["rest"]
    r_words, r_need = r["p"] * r["size"], (1 - r["p"]) * r["size"]
    x_words, x_need = x["p"] * x["size"], (1 - x["p"]) * x["size"]

    def settled(item, p):
        return F.struct(item["ord"].alias("ord"), (p >= 1).cast("int").alias("up"))

    def left(item, p):
        return F.struct(item["ord"].alias("ord"), item["size"].alias("size"), p.alias("p"))

    def after(ab):
        rise = ab["u"] * (ab["a"] + ab["b"]) < ab["b"]  # the rest rises by a with probability b / (a + b)
        # what reaches 0 or 1 first is set to it exactly
        p_r = F.when(rise, F.when(r_need <= x_words, F.lit(1.0)).otherwise(r["p"] + ab["a"] / r["size"])).otherwise(
            F.when(r_words <= x_need, F.lit(0.0)).otherwise(r["p"] - ab["b"] / r["size"]))
        p_x = F.when(rise, F.when(x_words <= r_need, F.lit(0.0)).otherwise(x["p"] - ab["a"] / x["size"])).otherwise(
            F.when(x_need <= r_words, F.lit(1.0)).otherwise(x["p"] + ab["b"] / x["size"]))
        return let(F.struct(F.least(F.lit(1.0), F.greatest(F.lit(0.0), p_r)).alias("r"),
                            F.least(F.lit(1.0), F.greatest(F.lit(0.0), p_x)).alias("x")), ended)

    def ended(p):
        r_done, x_done = (p["r"] <= 0) | (p["r"] >= 1), (p["x"] <= 0) | (p["x"] >= 1)
        rest = F.when(r_done & x_done, F.lit(None)).when(r_done, left(x, p["x"])).otherwise(left(r, p["r"]))
        new = F.when(r_done & x_done, F.array(settled(r, p["r"]), settled(x, p["x"]))).when(
            r_done, F.array(settled(r, p["r"]))).otherwise(F.array(settled(x, p["x"])))
        return F.struct(rest.alias("rest"), F.concat(state["done"], new).alias("done"))

    pair = F.struct(
        F.least(r_need, x_words).alias("a"), F.least(r_words, x_need).alias("b"),
        unit(F.lit(seed), F.lit(level), r["ord"], x["ord"]).alias("u"))
    return F.when(r.isNull(), F.struct(left(x, x["p"]).alias("rest"), state["done"].alias("done"))).otherwise(let(pair, after))


def _step(seed: int, level: int, kind: str):
    return lambda state, x: _move(state, x, seed, level).cast(kind)


def round_pivotal(items: DataFrame, n_rows: int, seed: int = SEED, run: int = RUN) -> DataFrame:
    """(ord, up) for rows (source_no, ord, size, p), 0 < p < 1, size > 0 and `ord` from 0 below n_rows."""
    kind = "struct<rest: struct<ord: bigint, size: double, p: double>, done: array<struct<ord: bigint, up: int>>>"
    start = F.from_json(F.lit('{"done": []}'), kind)
    rest, found, level, width = items.select("source_no", "ord", F.col("size").cast("double").alias("size"), "p"), [], 0, 1
    while True:
        width *= run
        # A run holds `run` rows at most: ordinals below, and one rest of each lower run above. The
        # longest come first, so that what is left at the end is short.
        runs = rest.groupBy("source_no", F.floor(F.col("ord") / F.lit(width)).alias("run_no")).agg(
            F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("last"), "ord", "size", "p"))).alias("xs"))
        folded = F.aggregate("xs", start, _step(seed, level, kind))
        runs = cut_lineage(runs.select("source_no", folded.alias("s")), f"pivotal-{level}")
        found.append(runs.select(F.inline("s.done")))
        rest = runs.where("s.rest is not null").select("source_no", "s.rest.*")
        level += 1
        if width >= n_rows:
            break
    found.append(rest.select("ord", (unit(F.lit(seed), F.lit(level), F.col("ord")) < F.col("p")).cast("int").alias("up")))
    return reduce(DataFrame.unionAll, found)


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, copies, taken) for rows (doc_id, text, source).

    `size` is the number of words, `copies` how often the mix takes the document, `taken` their words.
    Null text has size 0, null source is a source of its own after all others, a null doc_id is kept.
    Documents without words are taken 0 times. Repeated rows are documents of their own; which of two
    equal rows gets a copy more is left open. Other columns are ignored. No rows give no rows.
    Equal input, seed and shuffle width give equal results.
    """
    sized = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_hash"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")), "sized")
    targets, n_sources = source_targets(sized, weights, cap, share)
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    targets = targets.select(F.col("source").alias("t_source"), "source_size", "target", rate.alias("rate"),
                             F.xxhash64("source").alias("source_no"))
    rows = sized.join(small(targets, n_sources), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = rows.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    key = unit(F.lit(seed), F.col("doc_id"), F.col("text_hash"))
    rows = rows.withColumn("key", key)
    rows = cut_lineage(ordinal(rows, [F.col(c) for c in ("source_no", "key", "doc_id", "text_hash", "size")], "mix-order"), "mix-rows")
    n_rows = rows.count()
    ups = round_pivotal(rows.where("p > 0 and size > 0"), n_rows, seed)
    ups = ups.withColumnRenamed("ord", "u_ord")
    out = rows.join(ups, F.col("ord") == F.col("u_ord"), "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))).otherwise(0).cast("long")
    return out.withColumn("copies", copies).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
