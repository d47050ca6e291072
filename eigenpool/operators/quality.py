"""Cluster quality: Euclidean silhouette, Davies-Bouldin, adjusted Rand, choice of k."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.vectors import sq_distance, width
from eigenpool.operators.distance_sums import silhouette_by_boxes
from eigenpool.operators.joins import join_groups
from eigenpool.operators.kmeans import kmeans_sweep
from eigenpool.operators.tiles import (
    BLOCK_ROWS, Copies, build_blocks, fold_copies, run_tiles, sq_distances,
)

SILHOUETTE, DAVIES_BOULDIN, ARI = "Silhouette Score", "Davies-Bouldin Index", "Adjusted Rand Index (ARI)"


def _coded(points: DataFrame, labels: list[str]) -> DataFrame:
    """(id, f, codes): one 64-bit code per label column, so labels of any type travel as numbers."""
    codes = F.array(*[F.xxhash64(F.col(label).cast("string")) for label in labels])
    return points.select("id", F.col("f").alias("f", metadata=points.schema["f"].metadata), codes.alias("codes"))


def _silhouette_groups(copies: Copies, labelings: int, block_rows: int) -> DataFrame:
    """(gid, t, m, s): silhouette of every folded row under labeling t of `codes`.

    Many narrow rows are summed by boxes. Otherwise tiles sum distances per row and label; those sums are all that is shuffled.
    """
    found = silhouette_by_boxes(copies, labelings)
    if found is not None:
        return found
    blocks = build_blocks(copies.groups.select("gid", "f", "codes", "m"), copies.n_groups, block_rows=block_rows)

    def sums(side, other, d):
        out = []
        for t in range(labelings):
            codes, place = np.unique(other["codes"][:, t], return_inverse=True)
            pick = np.zeros((len(other), len(codes)))
            pick[np.arange(len(other)), place] = other["m"]
            total = d @ pick
            n, c = total.shape
            out.append((np.repeat(side["gid"], c), np.full(n * c, t), np.tile(codes, n), total.ravel()))
        return out

    def tile(a, b, same):
        d = np.sqrt(sq_distances(a.x, b.x))
        if same:
            np.fill_diagonal(d, 0.0)
        parts = sums(a, b, d) + ([] if same else sums(b, a, d.T))
        return dict(zip(["gid", "t", "code", "s"], [np.concatenate(c) for c in zip(*parts)]))

    parts = run_tiles(blocks, tile, "gid bigint, t bigint, code bigint, s double", total={"s": "sum"})
    totals = parts.groupBy("gid", "t", "code").agg(F.sum("s").alias("s"))
    exploded = copies.groups.select("gid", "m", F.posexplode("codes").alias("t", "own"))
    sizes = exploded.groupBy("t", F.col("own").alias("code")).agg(F.sum("m").alias("size"), F.count(F.lit(1)).alias("n"))
    own = exploded.select("gid", F.col("t").cast("bigint").alias("t"), "own", "m")
    paired = join_groups(totals.join(own, ["gid", "t"]), sizes, ["t", "code"], "n")
    inside = F.col("code") == F.col("own")
    per_row = paired.groupBy("gid", "t").agg(
        F.max("m").alias("m"),
        F.max(F.when(inside, F.col("size"))).alias("size"),
        F.max(F.when(inside, F.col("s"))).alias("inner"),
        F.min(F.when(~inside, F.col("s") / F.col("size"))).alias("b"),
    )
    a = F.col("inner") / F.nullif(F.col("size") - 1, F.lit(0))
    score = F.coalesce((F.col("b") - a) / F.nullif(F.greatest(a, F.col("b")), F.lit(0.0)), F.lit(0.0))
    return per_row.select("gid", "t", "m", F.when(F.col("b").isNotNull(), score).alias("s"))


def silhouette_samples(points: DataFrame, label: str = "cluster", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, silhouette) with Euclidean distances; a row alone in its cluster scores 0."""
    coded = _coded(points, [label])
    copies = fold_copies(coded, ["codes"])
    scores = _silhouette_groups(copies, 1, block_rows).select("gid", F.col("s").alias("silhouette"))
    shared = copies.groups.select("gid", "f", "codes", "m").join(scores, "gid").drop("gid")
    return join_groups(coded, shared, ["f", "codes"], "m").select("id", "silhouette")


def mean_silhouette(points: DataFrame, label: str = "cluster", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (silhouette); no row when there is only one label."""
    copies = fold_copies(_coded(points, [label]), ["codes"])
    return _silhouette_groups(copies, 1, block_rows).agg(
        (F.sum(F.col("s") * F.col("m")) / F.sum("m")).alias("silhouette")
    ).where(F.col("silhouette").isNotNull())


def silhouette_sampled(points: DataFrame, anchors: int = 1000, label: str = "cluster", seed="42") -> DataFrame:
    """One row (silhouette_sampled): the mean over hash-chosen anchor rows, each against all rows.

    An estimate under its own name, for data where the exact mean costs too much.
    """
    from eigenpool.functions.uniform import uniform
    from eigenpool.operators.tiles import list_matrix
    import pyarrow as pa

    coded = _coded(points, [label]).select("id", "f", F.col("codes")[0].alias("code")).persist()
    chosen = coded.orderBy(uniform(seed, F.col("id")), "id").limit(anchors).collect()
    x = np.array([r["f"] for r in chosen], dtype=float)
    own = np.array([r["code"] for r in chosen])

    def part(batches):
        total: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            d = np.sqrt(sq_distances(list_matrix(batch.column("f")), x))
            codes = batch.column("code").to_numpy()
            for c in np.unique(codes):
                rows = codes == c
                s, n = total.get(int(c), (np.zeros(len(x)), 0))
                total[int(c)] = (s + d[rows].sum(0), n + int(rows.sum()))
        for c, (s, n) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(x))), pa.array(np.full(len(x), c)), pa.array(s), pa.array(np.full(len(x), n))],
                ["anchor", "code", "s", "n"],
            )

    sums = (
        coded.select("f", "code").mapInArrow(part, "anchor bigint, code bigint, s double, n bigint")
        .groupBy("anchor", "code").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    truth = points.sparkSession.createDataFrame([(i, int(c)) for i, c in enumerate(own)], "anchor bigint, own bigint")
    inside = F.col("code") == F.col("own")
    per = sums.join(F.broadcast(truth), "anchor").groupBy("anchor").agg(
        F.max(F.when(inside, F.col("s") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~inside, F.col("s") / F.col("n"))).alias("b"),
    )
    score = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))
    return per.agg(F.avg(F.when(F.col("b").isNotNull(), score)).alias("silhouette_sampled"))


def centroids(points: DataFrame, label: str = "cluster") -> DataFrame:
    """(cluster, n, centre): mean features per label, pre-aggregated per task."""
    d = width(points)
    means = [F.avg(F.col("f")[i]).alias(f"c{i}") for i in range(d)]
    return points.groupBy(F.col(label).alias("cluster")).agg(F.count(F.lit(1)).alias("n"), *means).select(
        "cluster", "n", F.array(*[F.col(f"c{i}") for i in range(d)]).alias("centre")
    )


def davies_bouldin(points: DataFrame, label: str = "cluster", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (davies_bouldin): mean over clusters of the worst (s_i + s_j) / d_ij."""
    centres = centroids(points, label).persist()
    rows = join_groups(points.withColumn("cluster", F.col(label)), centres, ["cluster"], "n")
    spread = rows.groupBy("cluster").agg(F.avg(F.sqrt(sq_distance(F.col("f"), F.col("centre")))).alias("s"))
    clusters = centres.join(spread, "cluster").select(
        F.xxhash64(F.col("cluster").cast("string")).alias("gid"),
        F.col("centre").alias("f", metadata=points.schema["f"].metadata), "s",
    ).persist()
    count = clusters.count()
    if count < 2:
        return points.sparkSession.createDataFrame([], "davies_bouldin double")
    blocks = build_blocks(clusters, count, block_rows=block_rows)

    def worst(a, b, d, same):
        ratio = np.zeros_like(d)
        total = a["s"][:, None] + b["s"][None, :]
        np.divide(total, d, out=ratio, where=d > 0)
        if same:
            np.fill_diagonal(ratio, 0.0)
        return ratio

    def tile(a, b, same):
        ratio = worst(a, b, np.sqrt(sq_distances(a.x, b.x)), same)
        ids, top = [a["gid"]], [ratio.max(1)]
        if not same:
            ids.append(b["gid"])
            top.append(ratio.max(0))
        return {"gid": np.concatenate(ids), "worst": np.concatenate(top)}

    per = run_tiles(blocks, tile, "gid bigint, worst double", total={"worst": "max"}).groupBy("gid").agg(F.max("worst").alias("worst"))
    return per.agg(F.avg("worst").alias("davies_bouldin"))


def _pairs(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def adjusted_rand(rows: DataFrame, label: str = "cluster", truth: str = "owner") -> DataFrame:
    """One row (ari) from the contingency counts; identical trivial partitions score 1."""
    cells = rows.groupBy(F.col(label).alias("l"), F.col(truth).alias("t")).agg(F.count(F.lit(1)).alias("n")).persist()
    both = cells.agg(F.sum(_pairs(F.col("n"))).alias("v"), F.sum("n").alias("total")).first()
    left = cells.groupBy("l").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("v")).first()["v"] or 0.0
    right = cells.groupBy("t").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("v")).first()["v"] or 0.0
    total = float(both["total"] or 0)
    every, same = total * (total - 1) / 2, both["v"] or 0.0
    expected = left * right / every if every else 0.0
    most = (left + right) / 2
    value = 1.0 if most == expected else (same - expected) / (most - expected)
    return rows.sparkSession.createDataFrame([(float(value),)], "ari double")


def quality(points: DataFrame, label: str = "cluster", truth: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(metric, value): inner scores only with more than one label, ARI only with a truth.

    When the inner scores cannot be taken (as many labels as rows) both are NaN.
    """
    spark = points.sparkSession
    labels = points.select(label).distinct().count()
    parts = []
    if labels > 1:
        if labels < points.count():
            parts.append(mean_silhouette(points, label, block_rows).select(F.lit(SILHOUETTE).alias("metric"), F.col("silhouette").alias("value")))
            parts.append(davies_bouldin(points, label, block_rows).select(F.lit(DAVIES_BOULDIN).alias("metric"), F.col("davies_bouldin").alias("value")))
        else:
            nan = [(SILHOUETTE, float("nan")), (DAVIES_BOULDIN, float("nan"))]
            parts.append(spark.createDataFrame(nan, "metric string, value double"))
    if truth is not None:
        parts.append(adjusted_rand(points, label, truth).select(F.lit(ARI).alias("metric"), F.col("ari").alias("value")))
    if not parts:
        return spark.createDataFrame([], "metric string, value double")
    return reduce(DataFrame.unionByName, parts)


def tune_k(points: DataFrame, max_k: int = 10, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(k, distortion, silhouette, best) for k = 2..max_k by k-means on the features.

    Fits run on folded rows weighted by their copies; the distances behind all the
    silhouettes are computed once. `best` marks the first highest silhouette.
    """
    copies = fold_copies(points)
    ks = list(range(2, max_k + 1))
    rows, cost = kmeans_sweep(copies.groups, ks, seed=seed, weight="m")
    codes = F.array(*[F.col(f"k{k}").cast("bigint") for k in ks])
    meta = points.schema["f"].metadata
    labelled = rows.select("gid", F.col("f").alias("f", metadata=meta), "m", codes.alias("codes")).persist()
    scored = _silhouette_groups(
        Copies(labelled, ["f"], copies.n_rows, copies.n_groups, copies.top), len(ks), block_rows
    )
    means = scored.groupBy("t").agg((F.sum(F.col("s") * F.col("m")) / F.sum("m")).alias("v")).collect()
    found = {row["t"]: row["v"] for row in means}
    scores = [found.get(i) for i in range(len(ks))]
    best = max(range(len(ks)), key=lambda i: (-np.inf if scores[i] is None else scores[i], -i))
    rows = [(k, float(cost[k]), scores[i], i == best) for i, k in enumerate(ks)]
    return points.sparkSession.createDataFrame(rows, "k int, distortion double, silhouette double, best boolean")
