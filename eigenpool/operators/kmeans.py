"""Euclidean k-means on an array column, by the Spark ML estimator."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOBS = 4
# Iteration limit and tolerance of one fit.
ITERATIONS, TOLERANCE = 300, 1e-4


@dataclass(frozen=True)
class Clustered:
    """`vectors` are the rows behind the fit, held in the cache until they are unpersisted."""

    rows: DataFrame
    centers: list[list[float]]
    inertia: float
    vectors: DataFrame


def _fit(vectors: DataFrame, k: int, seed: int, out: str, weight: str | None):
    spec = KMeans(k=k, seed=seed, maxIter=ITERATIONS, tol=TOLERANCE, featuresCol="__v", predictionCol=out)
    return (spec.setWeightCol(weight) if weight else spec).fit(vectors)


def kmeans(
    rows: DataFrame, k: int, seed: int = 42, column: str = "y", out: str = "cluster",
    weight: str | None = None, starts: int = 1,
) -> Clustered:
    """Adds the cluster number; the best of `starts` seeded starts by within-cluster sum of squares.

    With a weight column, folded rows stand for their copies.
    """
    vectors = rows.withColumn("__v", array_to_vector(column)).persist()
    with ThreadPoolExecutor(JOBS) as pool:
        models = list(pool.map(lambda s: _fit(vectors, k, seed + s, out, weight), range(starts)))
    best = min(models, key=lambda m: m.summary.trainingCost)
    labelled = best.transform(vectors).drop("__v").withColumn(out, F.col(out).cast("int"))
    return Clustered(labelled, [c.tolist() for c in best.clusterCenters()], float(best.summary.trainingCost), vectors)


def kmeans_sweep(
    rows: DataFrame, ks: Sequence[int], seed: int = 42, column: str = "f", weight: str | None = None
) -> tuple[DataFrame, dict[int, float]]:
    """Adds one column `k<k>` per number of clusters, and the within-cluster sum of squares per k.

    The fits are independent jobs over the same cached rows and run side by side.
    """
    vectors = rows.withColumn("__v", array_to_vector(column)).persist()
    with ThreadPoolExecutor(JOBS) as pool:
        models = list(pool.map(lambda k: _fit(vectors, k, seed, f"k{k}", weight), ks))
    out = vectors
    for model in models:
        out = model.transform(out)
    return out.drop("__v"), {k: float(m.summary.trainingCost) for k, m in zip(ks, models)}
