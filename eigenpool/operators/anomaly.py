"""Outlier scores and their use on cluster labels: local outlier factor and isolation forest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eigenpool.functions.uniform import TWO_32
from eigenpool.operators.joins import first_per_group, join_groups
from eigenpool.operators.pairs import knn_groups
from eigenpool.operators.quantiles import exact_quantiles
from eigenpool.operators.tiles import fold_copies, list_matrix
from eigenpool.session import cut_lineage

# Neighbours of the local factor, trees and rows per tree of the forest,
# and the limits of the contamination share.
LOF_NEIGHBOURS = 20
FOREST_TREES = 100
TREE_ROWS = 256
LEAST_SHARE, MOST_SHARE = 0.01, 0.5
EULER_GAMMA = 0.5772156649015329
TINY = 1e-10
# Draws of sampled rows: modulus, its primitive root, and how many times the wanted rows pass the first cut.
DRAW_PRIME, DRAW_ROOT = 2_147_483_647, 48_271
SPARE_DRAWS = 3.0
#: Path lengths are whole numbers of this fraction.
LENGTH_UNITS = 1_000_000_000


def clamp_contamination(share: float) -> float:
    return min(max(share, LEAST_SHARE), MOST_SHARE)


def lof(points: DataFrame, neighbours: int = LOF_NEIGHBOURS, block_rows: int | None = None) -> DataFrame:
    """(id, severity): local outlier factor with min(neighbours, n-1) neighbours.

    Copies of a row have the same neighbour distances (each leaves one copy, itself,
    out), so densities are computed per folded row and only scores reach the rows.
    """
    copies = fold_copies(points)
    k = min(neighbours, copies.n_rows - 1)
    near = knn_groups(copies, points, k + 1, block_rows)
    w = Window.partitionBy("gid")
    own = F.min(F.when(F.col("nid") == F.col("gid"), F.col("rank"))).over(w)
    others = cut_lineage(
        near.withColumn("own", own).where(F.col("rank") != F.coalesce("own", F.lit(k + 1))).select("gid", "nid", "d"),
        "neighbours",
    )
    # A row may be the neighbour of very many others, so these joins know how often it is.
    asked = others.groupBy("nid").agg(F.count(F.lit(1)).alias("asked"))
    reach = others.groupBy(F.col("gid").alias("nid")).agg(F.max("d").alias("kd")).join(asked, "nid")
    density = (
        join_groups(others, reach, ["nid"], "asked")
        .groupBy("gid")
        .agg((F.lit(1.0) / (F.avg(F.greatest("d", "kd")) + F.lit(TINY))).alias("lrd"))
    )
    density = cut_lineage(density, "density")
    around = density.select(F.col("gid").alias("nid"), F.col("lrd").alias("near_lrd")).join(asked, "nid")
    scores = (
        join_groups(others, around, ["nid"], "asked")
        .groupBy("gid").agg(F.avg("near_lrd").alias("near_lrd"))
        .join(density, "gid")
        .select("gid", (F.col("near_lrd") / F.col("lrd")).alias("severity"))
    )
    shared = copies.groups.select("gid", "f", "m").join(scores, "gid").drop("gid")
    return join_groups(points.select("id", "f"), shared, ["f"], "m").select("id", "severity")


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _hashed(*parts) -> float:
    """The draw `uniform` gives for the same parts, outside Spark."""
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / TWO_32


def grow_tree(x: np.ndarray, seed, tree: int) -> list[tuple[int, int, float, int]]:
    """A random isolation tree as (node, feature, cut, length), parents first; feature -1 is a leaf.

    Children of node v are 2v and 2v + 1. Feature and cut of a node are hashes of seed, tree and node, so the tree
    depends on the sampled values alone. Lengths count 1 / LENGTH_UNITS.
    """
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, level = [], [(1, x)]
    for depth in range(limit + 1):
        below = []
        for node, rows in level:
            low, high = rows.min(0), rows.max(0)
            open_features = np.nonzero(high > low)[0]
            if depth == limit or not len(open_features):
                nodes.append((node, -1, 0.0, round((depth + float(_average_path(np.array([len(rows)]))[0])) * LENGTH_UNITS)))
                continue
            j = int(open_features[int(_hashed(seed, tree, node, "feature") * len(open_features))])
            cut = float(low[j] + _hashed(seed, tree, node, "cut") * (high[j] - low[j]))
            if cut >= high[j]:  # rounding; the right side must not be empty
                cut = float(low[j])
            nodes.append((node, j, cut, 0))
            goes_left = rows[:, j] <= cut
            below += [(2 * node, rows[goes_left]), (2 * node + 1, rows[~goes_left])]
        level = below
    return nodes


def tree_multipliers(trees: int) -> list[tuple[int, int]]:
    """Two factors a tree: powers of a primitive root of DRAW_PRIME."""
    powers = list(accumulate([DRAW_ROOT] * (2 * trees), lambda a, b: a * b % DRAW_PRIME))
    return list(zip(powers[::2], powers[1::2]))


def tree_samples(points: DataFrame, trees: int, size: int, n: int, seed) -> DataFrame:
    """(tree, id, f): for each tree the `size` rows with the smallest draws among n.

    A row's id is hashed once; its draw in a tree is a linear form of two parts of the hash modulo a prime, with the
    tree's factors. Draws above a few times the wanted share are dropped in the scan, so the shuffle holds a number of rows
    that doesn't grow with n.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 7), 16, 10).cast("long")
    factors = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                        for t, (a, b) in enumerate(tree_multipliers(trees))])
    most = int(min(1.0, SPARE_DRAWS * size / n) * DRAW_PRIME)
    draws = F.transform(factors, lambda t: F.struct(t["tree"].alias("tree"), ((F.col("_a") * t["a"] + F.col("_b") * t["b"]) % DRAW_PRIME).alias("draw")))
    low = F.filter(draws, lambda d: d["draw"] <= most)
    drawn = points.select("id", "f", part(1).alias("_a"), part(8).alias("_b")).select("id", "f", F.inline(low))
    return first_per_group(drawn, ["tree"], ["draw", "id"], size).select("tree", "id", "f")


def iforest(points: DataFrame, trees: int = FOREST_TREES, tree_rows: int = TREE_ROWS, seed: int = 42) -> DataFrame:
    """(id, severity): isolation forest score, higher is more anomalous.

    Samples, features and cuts are hashes, whatever the partitioning, and path lengths are summed as whole numbers, so
    equal rows get equal scores. The forest has a fixed size, so it is sent to the scoring tasks.
    """
    n = points.count()
    if not n:
        raise ValueError("no rows to score")
    size = min(tree_rows, n)

    def grow(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        node, feature, cut, length = zip(*grow_tree(list_matrix(table.column("f")), seed, tree))
        return pa.table({
            "tree": pa.array([tree] * len(node), pa.int32()), "node": pa.array(node, pa.int32()), "feature": pa.array(feature, pa.int32()),
            "cut": pa.array(cut, pa.float64()), "length": pa.array(length, pa.int64())})

    forest = tree_samples(points, trees, size, n, seed).groupBy("tree").applyInArrow(
        grow, "tree int, node int, feature int, cut double, length bigint").toPandas()
    packed = []
    for _, tree in forest.groupby("tree"):
        slots = int(tree["node"].max()) + 1
        feature, cut, length = np.full(slots, -1), np.zeros(slots), np.zeros(slots, dtype=np.int64)
        at = tree["node"].to_numpy()
        feature[at], cut[at], length[at] = tree["feature"], tree["cut"], tree["length"]
        packed.append((feature, cut, length))
    scale = (float(_average_path(np.array([size]))[0]) or 1.0) * LENGTH_UNITS

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = list_matrix(batch.column("f"))
            rows, total = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
            for feature, cut, length in packed:
                at = np.ones(len(x), dtype=np.int64)
                while True:
                    j = feature[at]
                    inner = j >= 0
                    if not inner.any():
                        break
                    goes_right = x[rows, np.maximum(j, 0)] > cut[at]
                    at = np.where(inner, 2 * at + goes_right, at)
                total += length[at]
            severity = np.exp2(-(total / len(packed)) / scale)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(severity)], ["id", "severity"])

    return points.select("id", "f").mapInArrow(score, "id bigint, severity double")


def contamination_cut(scores: DataFrame, contamination: float) -> DataFrame:
    """Adds `outlier`: the negated severity lies strictly below its 100*c-th percentile."""
    share = clamp_contamination(contamination)
    scores = scores.persist()
    cut = exact_quantiles(scores.select((-F.col("severity")).alias("v")), ["v"], [share])["v"][0]
    return scores.withColumn("outlier", -F.col("severity") < F.lit(cut))


def detect_outliers(points: DataFrame, method: str = "lof", contamination: float = 0.1, **options) -> DataFrame:
    """(id, severity, outlier) by 'lof' or 'iforest'."""
    if method == "lof":
        scores = lof(points, **options)
    elif method == "iforest":
        scores = iforest(points, **options)
    else:
        raise ValueError(f"Unknown method: {method}")
    return contamination_cut(scores, contamination)


def mark_outliers(labels: DataFrame, outliers: DataFrame, label: str = "cluster") -> DataFrame:
    """Labels with flagged rows set to -1; the first label stays in `original`."""
    flags = outliers.select("id", "outlier")
    return (
        labels.join(flags, "id", "left")
        .withColumn("original", F.col(label))
        .withColumn(label, F.when(F.coalesce("outlier", F.lit(False)), F.lit(-1)).otherwise(F.col(label)))
        .drop("outlier")
    )


def outlier_distribution(marked: DataFrame, label: str = "cluster") -> DataFrame:
    """(original, n_outliers): every original cluster is listed, also with none."""
    return marked.groupBy("original").agg(F.count_if(F.col(label) == -1).alias("n_outliers"))


def outlier_info(marked: DataFrame, method: str, contamination: float, label: str = "cluster") -> DataFrame:
    """One row (n_outliers, outlier_percentage, detection_method, contamination).

    The flagged ids are the rows with label -1, a DataFrame of their own.
    """
    return marked.agg(
        F.count_if(F.col(label) == -1).alias("n_outliers"),
        (F.count_if(F.col(label) == -1) / F.count(F.lit(1)) * 100).alias("outlier_percentage"),
    ).select(
        "*", F.lit(method).alias("detection_method"), F.lit(clamp_contamination(contamination)).alias("contamination")
    )


def cluster_with_anomalies(
    labels: DataFrame, points: DataFrame, enable: bool = True, method: str = "lof", contamination: float = 0.1
) -> tuple[DataFrame, DataFrame | None]:
    """Final labels and the info row; switched off, labels pass unchanged and info is None."""
    if not enable:
        return labels, None
    marked = mark_outliers(labels, detect_outliers(points, method, contamination)).persist()
    return marked, outlier_info(marked, method, contamination)


def cluster_summary(labels: DataFrame, label: str = "cluster") -> DataFrame:
    """(name, size, n_clusters, has_outliers): sizes keyed cluster_i or outliers."""
    sizes = labels.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("size")).persist()
    facts = sizes.agg(
        F.count_if(F.col("c") >= 0).alias("n_clusters"), F.coalesce(F.bool_or(F.col("c") == -1), F.lit(False)).alias("o")
    ).first()
    name = F.when(F.col("c") == -1, "outliers").otherwise(F.concat(F.lit("cluster_"), F.col("c").cast("string")))
    return sizes.select(
        name.alias("name"), "size", F.lit(facts["n_clusters"]).alias("n_clusters"), F.lit(facts["o"]).alias("has_outliers")
    )
