"""Spectral clustering jobs over pooled points."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.vectors import width
from eigenpool.operators.eigen import entries_eigen, list_array, top_eigen
from eigenpool.operators.joins import join_groups
from eigenpool.operators.kmeans import kmeans
from eigenpool.operators.matrix import degree_scale, laplace_noise, row_normalize
from eigenpool.operators.pairs import EPS, kernel, knn_groups
from eigenpool.operators.quality import quality
from eigenpool.operators.tiles import BLOCK_ROWS, Copies, build_blocks, fold_copies, list_matrix, sq_distances
from eigenpool.session import cut_lineage, passing_files

MODES = ("exact", "nystrom", "knn")


@dataclass(frozen=True)
class Embedding:
    """rows(id, owner, f, y) with unit rows, the leading eigenvalues, and the solver's residual."""

    rows: DataFrame
    values: list[float]
    residual: float


@dataclass(frozen=True)
class SpectralRun:
    """labels(id, owner, f, y, cluster); metrics(metric, value); the leading eigenvalues."""

    labels: DataFrame
    metrics: DataFrame | None
    values: list[float]
    residual: float


def _to_rows(points: DataFrame, copies: Copies, vectors: DataFrame) -> DataFrame:
    shared = copies.groups.select("gid", "f", "m").join(vectors.select("gid", "y"), "gid")
    shared = row_normalize(shared).select("f", "m", "y")
    return join_groups(points, shared, ["f"], "m").select("id", "owner", "f", "y")


def exact_embedding(points: DataFrame, k: int, sigma: float, block_rows: int = BLOCK_ROWS) -> Embedding:
    """All pairs count; work grows with the square of the distinct rows within reach."""
    copies = fold_copies(points)
    solved = top_eigen(copies, sigma, k, block_rows=block_rows)
    return Embedding(_to_rows(points, copies, solved.vectors), solved.values, solved.residual)


def knn_embedding(points: DataFrame, k: int, sigma: float, neighbours: int = 10, block_rows: int = BLOCK_ROWS, tol: float = 1e-6) -> Embedding:
    """Gaussian weights on the symmetrised graph of nearest distinct rows; linear storage.

    Where the graph falls into at least k components, the k with the most weight span the embedding, and rows of others are zero.
    """
    copies = fold_copies(points)
    distinct = copies.groups.select(F.col("gid").alias("id"), F.col("f").alias("f", metadata=points.schema["f"].metadata))
    apart = Copies(
        copies.groups.withColumn("m", F.lit(1).cast("bigint")), copies.keys, copies.n_groups, copies.n_groups, 1
    )
    near = knn_groups(apart, distinct, min(neighbours + 1, copies.n_groups))
    arcs = near.select(F.col("gid").alias("i"), F.col("nid").alias("j"), "d")
    both = arcs.unionByName(arcs.select(F.col("j").alias("i"), F.col("i").alias("j"), "d"))
    scale = -1.0 / (2.0 * sigma * sigma)
    w = both.groupBy("i", "j").agg(F.exp(F.min("d") * F.min("d") * F.lit(scale)).alias("w"))
    counts = copies.groups.select(F.col("gid").alias("i"), F.col("m").alias("mi"))
    w = cut_lineage(w.join(counts, "i").join(counts.toDF("j", "mj"), "j"), "arcs")
    degrees = w.groupBy("i").agg(
        F.greatest(F.sum(F.col("w") * F.col("mj")), F.lit(1e-9)).alias("degree"), F.count(F.lit(1)).alias("n"), F.first("mi").alias("mi")
    )
    weighted = degree_scale(w, degrees.select("i", "degree", "n"), -0.5).withColumn("m", F.col("m") * F.sqrt(F.col("mi") * F.col("mj")))
    masses = degrees.select(F.col("i").alias("key"), (F.col("degree") * F.col("mi")).alias("mass"))
    blocks = build_blocks(copies.groups.select("gid", "f"), copies.n_groups, block_rows=block_rows)
    homes = blocks.rows.select(F.col("gid").alias("key"), F.col("block").alias("strip"))
    vectors, values, residual = entries_eigen(weighted.select("i", "j", "m"), copies.n_groups, k, masses, homes, block_rows, tol)
    vectors = (
        vectors.join(copies.groups.select(F.col("gid").alias("key"), F.col("m").alias("copies")), "key")
        .select(F.col("key").alias("gid"), F.transform("y", lambda v: v / F.sqrt("copies")).alias("y"))
    )
    return Embedding(_to_rows(points, copies, vectors), values, residual)


SUM_TASKS = 64
#: A task embeds and clusters about so many rows, however few files they come from.
SPREAD_ROWS = 1 << 17


def _row_sum(rows: DataFrame, fn, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all rows of fn(features), a matrix of fixed shape, in two levels.

    Every task hands on one line per matrix row; a fixed number of tasks adds those up,
    so the driver receives the same amount however many input partitions there are.
    """

    def emit(total: dict):
        if total:
            keys = sorted(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), list_array(np.stack([total[c] for c in keys]))], ["line", "v"]
            )

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(list_matrix(batch.column("f"))).reshape(shape)
                total = part if total is None else total + part
        yield from emit({} if total is None else dict(enumerate(total)))

    def merge(batches):
        total: dict = {}
        for batch in batches:
            lines, values = batch.column("line").to_pylist(), list_matrix(batch.column("v"))
            for line, value in zip(lines, values):
                total[line] = total[line] + value if line in total else value.copy()
        yield from emit(total)

    kinds = "line int, v array<double>"
    parts = rows.select("f").mapInArrow(partial, kinds)
    tasks = min(SUM_TASKS, rows.sparkSession.sparkContext.defaultParallelism)
    out = np.zeros(shape)
    for row in parts.repartition(tasks).mapInArrow(merge, kinds).collect():
        out[row["line"]] += np.array(row["v"])
    return out


def landmark_rows(points: DataFrame, count: int) -> np.ndarray:
    """Up to `count` distinct rows by hash order: the fixed-size sketch of the Nystrom mode.

    A sketch of the number of distinct rows gives a hash limit that leaves a small
    multiple of `count`, so only that many rows are shuffled; copies share one hash.
    """
    hashed = points.select("f", F.xxhash64("f").alias("h"))
    distinct = hashed.agg(F.approx_count_distinct("h", 0.02).alias("n")).first()["n"]
    if not distinct:
        raise ValueError("no rows to cluster")
    share = min(1.0, 4.0 * (count + 16) / distinct)
    limit = int(-(1 << 63) + share * ((1 << 64) - 1))
    near = hashed.where(F.col("h") <= F.lit(min(limit, (1 << 63) - 1)))
    best = near.groupBy("f").agg(F.min("h").alias("h")).orderBy("h", "f").limit(count)
    return np.array([r["f"] for r in best.collect()], dtype=float)


def nystrom_embedding(points: DataFrame, k: int, sigma: float, landmarks: int = 256) -> Embedding:
    """Affinity approximated through a fixed number of landmark rows; linear in the rows.

    Two passes sum a landmark vector and a landmark matrix, a third maps every row to
    its embedding. Rows are shuffled at most once, to spread many of them over enough tasks. With as many landmarks as distinct rows the
    result is the exact one.
    """
    marks = landmark_rows(points, landmarks)
    inner, vecs = np.linalg.eigh(kernel(sq_distances(marks, marks), sigma, True))
    # Weaker directions carry less than the rounding their inverse would add.
    keep = inner > inner.max() * math.sqrt(EPS)
    inverse = (vecs[:, keep] / inner[keep]) @ vecs[:, keep].T
    half = vecs[:, keep] / np.sqrt(inner[keep])

    def weights(x: np.ndarray) -> np.ndarray:
        return np.exp(sq_distances(x, marks) / (-2.0 * sigma * sigma))

    column = _row_sum(points, lambda x: weights(x).sum(0), (1, len(marks)))[0]
    lift = inverse @ column

    def scaled(x: np.ndarray) -> np.ndarray:
        c = weights(x)
        return (c @ half) / np.sqrt(np.maximum(c @ lift, 1e-9))[:, None]

    def second(x: np.ndarray) -> np.ndarray:
        s = scaled(x)
        return s.T @ s

    size = int(keep.sum())
    values, turn = np.linalg.eigh(_row_sum(points, second, (size, size)))
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    turn = turn * np.where(turn[np.abs(turn).argmax(0), np.arange(turn.shape[1])] < 0, -1.0, 1.0)
    project = turn / np.sqrt(np.maximum(values, 1e-300))
    loss = float(1.0 - values[0]) if len(values) else 0.0

    def embed(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            y = scaled(list_matrix(batch.column("f"))) @ project
            norm = np.linalg.norm(y, axis=1, keepdims=True)
            y = y / np.where(norm == 0, 1.0, norm)
            yield pa.RecordBatch.from_arrays([*batch.columns, list_array(y)], [*batch.schema.names, "y"])

    rows, n = points.select("id", "owner", "f"), points.count()
    if n > SPREAD_ROWS:
        rows = rows.repartition(max(math.ceil(n / SPREAD_ROWS), rows.sparkSession.sparkContext.defaultParallelism), "id", "f")
    rows = rows.mapInArrow(
        embed, "id bigint, owner string, f array<double>, y array<double>"
    )
    return Embedding(rows, [float(v) for v in values], abs(loss))


def spectral_embedding(points: DataFrame, k: int, sigma: float, mode: str = "exact", **options) -> Embedding:
    if mode not in MODES:
        raise ValueError(f"Unknown mode: {mode}")
    build = {"exact": exact_embedding, "nystrom": nystrom_embedding, "knn": knn_embedding}[mode]
    return build(points, k, sigma, **options)


def spectral_cluster(
    points: DataFrame, k: int, sigma: float, epsilon: float | None = None, mode: str = "exact",
    seed: int = 42, noise_seed=None, metrics: bool = True, **options,
) -> SpectralRun:
    """Pooled points(id, owner, f) to clusters.

    Gaussian affinity, degree normalisation, leading eigenvectors, unit rows, optional
    Laplace perturbation, k-means; scores are taken on the clustered (possibly noised)
    rows, with the owner as the truth of the adjusted Rand index.
    """
    width(points)
    embedding = spectral_embedding(points, k, sigma, mode, **options)
    noised = laplace_noise(embedding.rows, epsilon, noise_seed)
    fitted = kmeans(noised, k, seed=seed)
    labels = fitted.rows.persist()
    scores = None
    if metrics:
        scored = labels.select("id", "owner", F.col("y").alias("f"), "cluster")
        scores = quality(scored, truth="owner")
    return SpectralRun(labels, scores, embedding.values, embedding.residual)


# Privacy budgets of the trade-off curve.
CURVE_EPSILONS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
CURVE_JOBS = 3


def privacy_utility_curve(
    points: DataFrame, k: int, sigma: float, mode: str = "exact", noise_seed=None, epsilons=CURVE_EPSILONS, **options
) -> DataFrame:
    """(epsilon, silhouette): the embedding is solved once, then perturbed, clustered and scored per budget.

    All rows count as one owner. A score that cannot be taken counts as 0. Budgets are clustered side by side and scored one
    after the other, and what a step wrote is deleted once it is over, so the disk holds the files of one score at a time.
    """
    from eigenpool.operators.quality import mean_silhouette

    spark = points.sparkSession
    with passing_files(spark):
        base = cut_lineage(spectral_embedding(points, k, sigma, mode, **options).rows, "embedding", keep=True)
    alone = Lock()

    def score(epsilon: float) -> float:
        noised = laplace_noise(base, epsilon, noise_seed)
        fitted = kmeans(noised, k)
        labels = fitted.rows.select("id", F.col("y").alias("f"), "cluster")
        with alone, passing_files(spark):
            row = mean_silhouette(labels).first()
        fitted.vectors.unpersist()
        return 0.0 if row is None or np.isnan(row["silhouette"]) else float(row["silhouette"])

    with ThreadPoolExecutor(CURVE_JOBS) as pool:
        out = list(zip(map(float, epsilons), pool.map(score, epsilons)))
    return points.sparkSession.createDataFrame(out, "epsilon double, silhouette double")
