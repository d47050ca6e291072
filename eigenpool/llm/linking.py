"""Components of items that meet in buckets, without writing out a bucket's pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import partitions
from eigenpool.session import cut_lineage as write


#: Nodes of a bucket with which all its nodes are compared, in each of the first rounds.
PIVOTS = (1, 4)
#: Tables of linked nodes are a small share of the corpus and written by this share of its tasks.
NODE_SHARE = 8


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    return write(df.coalesce(max(2, partitions(df.sparkSession) // NODE_SHARE)), name)


def components(links: DataFrame) -> DataFrame:
    """(nid, root): the smallest node reachable, for every node in links (a, b).

    Each round every node takes the smallest root around it, old roots learn of it, and roots then
    point at their own roots, until nothing changes. Tables stay distributed; each round is written.
    """
    both = cut_lineage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = both.groupBy(F.col("a").alias("nid")).agg(F.min("b").alias("m")).select("nid", F.least("nid", "m").alias("root"))
    roots = cut_lineage(roots, "roots")
    while True:
        near = both.join(roots.select(F.col("nid").alias("b"), "root"), "b").groupBy(F.col("a").alias("nid")).agg(F.min("root").alias("m"))
        told = cut_lineage(roots.join(near, "nid"), "told")
        hooks = told.groupBy(F.col("root").alias("nid")).agg(F.min("m").alias("h"))
        step = told.join(hooks, "nid", "left").select("nid", "root", F.least("root", "m", "h").alias("new"))
        step = cut_lineage(step, "hooked")
        parents = step.select(F.col("nid").alias("new"), F.col("new").alias("up"))
        step = cut_lineage(step.join(parents, "new").select("nid", "root", F.least("new", "up").alias("new")), "jumped")
        changed = step.where("new <> root").limit(1).count()
        roots = step.select("nid", F.col("new").alias("root"))
        if not changed:
            return roots


def _across(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows (key, nid, root) of the buckets that hold more than one component."""
    if roots is None:
        labelled = buckets.withColumn("root", F.col("nid"))
    else:
        labelled = buckets.join(roots, "nid", "left").select("key", "nid", F.coalesce("root", "nid").alias("root"))
    labelled = write(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    return write(labelled.join(mixed, "key"), "mixed")


def link_nodes(
    buckets: DataFrame, confirm: Callable[[DataFrame], DataFrame], candidates: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """(nid, root) of all linked nodes, or None where there are no links; `buckets` is (key, nid).

    First every node of a bucket is compared with one node of it, then, where components are left,
    with a few. Most buckets of similar nodes are one component then, and need no more. `candidates`
    gets the rows (key, nid, root) of the buckets that still hold several and returns the pairs (a, b)
    across components that may be links. `confirm` keeps those of the pairs that are.
    """
    links, roots = None, None
    for pivots in PIVOTS:
        mixed = _across(buckets, roots)
        if not mixed.limit(1).count():
            return roots
        part = F.pmod(F.xxhash64("nid"), F.lit(pivots))
        chosen = mixed.groupBy("key", part.alias("part")).agg(F.min(F.struct("nid", "root")).alias("p"))
        chosen = chosen.select("key", F.col("p.nid").alias("a"), F.col("p.root").alias("root_a"))
        pairs = mixed.join(chosen, "key").where("root <> root_a").select(F.least("a", "nid").alias("a"), F.greatest("a", "nid").alias("b"))
        found = write(confirm(write(pairs.distinct(), "pairs")), "linked")
        links = found if links is None else links.unionAll(found)
        roots = components(links) if links.limit(1).count() else None
    mixed = _across(buckets, roots)
    if not mixed.limit(1).count():
        return roots
    more = write(confirm(write(candidates(mixed).distinct(), "pairs")), "linked")
    return components(links.unionAll(more)) if more.limit(1).count() else roots
