import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool import session
from eigenpool.functions.uniform import laplace, normal, uniform
from eigenpool.functions.vectors import feature_array
from eigenpool.operators import anomaly, matrix, quality
from eigenpool.operators.eigen import entries_eigen
from eigenpool.plans import cluster
from helpers import distances, frame, with_copies


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(40, 2)) * 0.3 + c for c in ((0, 0), (5, 0), (0, 5))])
    x[3:25] = x[0]
    return frame(spark, x, owners=np.repeat(["a", "b", "c"], 40)).persist()


@pytest.mark.parametrize("mode,options", [
    ("exact", {}), ("exact", {"block_rows": 25}), ("nystrom", {"landmarks": 40}), ("knn", {"neighbours": 6}),
])
def test_modes_find_the_blobs(blobs, mode, options):
    run = cluster.spectral_cluster(blobs, 3, 1.0, mode=mode, **options)
    scores = {r["metric"]: r["value"] for r in run.metrics.collect()}
    assert scores[quality.ARI] == 1.0
    assert run.labels.count() == 120
    norms = run.labels.select(F.aggregate("y", F.lit(0.0), lambda a, v: a + v * v).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert norms[0] == pytest.approx(1.0) and norms[1] == pytest.approx(1.0)


def test_nystrom_with_all_landmarks_is_exact(spark):
    points = frame(spark, with_copies(n=90, hot=30))
    exact = cluster.exact_embedding(points, 3, 1.0)
    near = cluster.nystrom_embedding(points, 3, 1.0, landmarks=1000)
    assert near.values == pytest.approx(exact.values, abs=1e-6)
    a = np.array([r["y"] for r in exact.rows.orderBy("id").collect()])
    b = np.array([r["y"] for r in near.rows.orderBy("id").collect()])
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-4)


def test_one_and_many_partitions_agree(spark):
    points = frame(spark, with_copies(n=90, hot=30))
    one = cluster.exact_embedding(points.coalesce(1), 3, 1.0).rows.orderBy("id").collect()
    many = cluster.exact_embedding(points.repartition(8), 3, 1.0).rows.orderBy("id").collect()
    assert np.allclose([r["y"] for r in one], [r["y"] for r in many], atol=1e-8)


def test_sparse_solver_matches_dense(spark):
    x = with_copies(n=60, hot=1)
    d = distances(x)
    w = np.where(d < np.quantile(d, 0.2), np.exp(-d ** 2), 0.0)
    m = w / np.sqrt(np.outer(w.sum(1), w.sum(1)))
    rows = [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    table = spark.createDataFrame(rows, "i bigint, j bigint, m double")
    want = np.linalg.eigvalsh(m)[::-1][:3]
    for block_rows in (2048, 10):
        vectors, values, _ = entries_eigen(table, len(x), 3, block_rows=block_rows)
        assert values == pytest.approx(list(want), abs=1e-7)
        y = np.array([r["y"] for r in vectors.orderBy("key").collect()])
        assert np.abs(m @ y - y * values).max() < 1e-4


def test_errors(spark, blobs):
    with pytest.raises(ValueError):
        cluster.spectral_cluster(blobs, 3, 1.0, mode="other")
    with pytest.raises(ValueError):
        cluster.spectral_cluster(frame(spark, np.zeros((1, 2))).where("id < 0"), 2, 1.0)
    with pytest.raises(ValueError, match="Unknown method"):
        anomaly.detect_outliers(blobs, "other")


def test_noise_moments_and_partitioning(spark):
    draws = spark.range(40000).select(
        uniform("s", F.col("id")).alias("u"), normal("s", F.col("id")).alias("n"), laplace("s", 0.25, F.col("id")).alias("l")
    )
    row = draws.agg(F.avg("u"), F.avg("n"), F.stddev("n"), F.avg("l"), F.avg(F.abs("l"))).first()
    assert list(row) == pytest.approx([0.5, 0.0, 1.0, 0.0, 0.25], abs=0.02)
    assert draws.repartition(7).agg(F.sum("u")).first()[0] == pytest.approx(draws.agg(F.sum("u")).first()[0])


def test_noise_scale_and_switch(blobs):
    y = blobs.select("id", F.col("f").alias("y"))
    assert matrix.laplace_noise(y, None) is y and matrix.laplace_noise(y, 0.0) is y
    moved = matrix.laplace_noise(y, 5.0, seed="1").join(y.withColumnRenamed("y", "o"), "id")
    gaps = moved.select(F.explode(F.zip_with("y", "o", lambda a, b: F.abs(a - b))).alias("g")).agg(F.avg("g")).first()[0]
    assert gaps == pytest.approx(0.1, abs=0.03)
    other = matrix.laplace_noise(y, 5.0).join(matrix.laplace_noise(y, 5.0).withColumnRenamed("y", "o"), "id")
    assert other.where("y = o").count() == 0


def test_tuning_finds_two_squares(spark):
    rng = np.random.default_rng(4)
    points = frame(spark, np.concatenate([rng.random((10, 2)), rng.random((10, 2)) + 5]))
    table = quality.tune_k(points, max_k=5).orderBy("k").collect()
    assert [r["k"] for r in table if r["best"]] == [2]
    assert table[0]["distortion"] > table[-1]["distortion"]


def test_quality_keys_appear_conditionally(spark):
    points = frame(spark, [[0.0, 0], [0, 1], [5, 5]], owners=["a", "a", "b"]).withColumn("cluster", F.lit(1))
    assert quality.quality(points).count() == 0
    assert [r["metric"] for r in quality.quality(points, truth="owner").collect()] == [quality.ARI]
    alone = points.withColumn("cluster", F.col("id"))
    values = {r["metric"]: r["value"] for r in quality.quality(alone).collect()}
    assert all(np.isnan(v) for v in values.values()) and len(values) == 2


def test_curve_has_every_budget(blobs):
    curve = cluster.privacy_utility_curve(blobs, 3, 1.0, mode="nystrom", landmarks=30, noise_seed="2").orderBy("epsilon").collect()
    assert [r["epsilon"] for r in curve] == [0.1, 0.5, 1.0, 2.0, 5.0, 10.0]
    assert curve[-1]["silhouette"] > curve[0]["silhouette"]


def test_forest_ranks_far_rows_first_whatever_the_partitions(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(600, 3)), np.full((3, 3), 9.0) + rng.normal(size=(3, 3))])
    points = frame(spark, x)
    one = {r["id"]: r["severity"] for r in anomaly.iforest(points.coalesce(1)).collect()}
    many = {r["id"]: r["severity"] for r in anomaly.iforest(points.repartition(6)).collect()}
    assert one == pytest.approx(many)
    assert set(sorted(one, key=one.get)[-3:]) == {600, 601, 602}
    assert all(0 < s < 1 for s in one.values())
    flagged = anomaly.detect_outliers(points, "iforest", 0.05).where("outlier").count()
    assert 25 <= flagged <= 31


def test_forest_of_equal_few_and_hot_rows(spark):
    assert [r["severity"] for r in anomaly.iforest(frame(spark, [[1.0, 2.0]])).collect()] == [1.0]
    same = {r["severity"] for r in anomaly.iforest(frame(spark, np.ones((40, 2)))).collect()}
    assert len(same) == 1 and same.pop() == pytest.approx(0.5)
    x = np.concatenate([np.zeros((400, 2)), np.random.default_rng(3).normal(size=(400, 2))])
    scores = {r["id"]: r["severity"] for r in anomaly.iforest(frame(spark, x)).collect()}
    assert len({scores[i] for i in range(400)}) == 1 and scores[0] < min(scores[i] for i in range(400, 800))


def test_tree_samples_are_the_smallest_draws(spark):
    points = frame(spark, np.arange(5000.0)[:, None])
    drawn = anomaly.tree_samples(points, 3, 64, 5000, 7).groupBy("tree").agg(F.collect_set("id").alias("ids")).collect()
    for row in drawn:
        a, b = anomaly.tree_multipliers(3)[row["tree"]]
        digest = [hashlib.md5(f"7|{i}".encode()).hexdigest() for i in range(5000)]
        draw = [(int(d[:7], 16) * a + int(d[7:14], 16) * b) % anomaly.DRAW_PRIME for d in digest]
        assert set(row["ids"]) == set(sorted(range(5000), key=lambda i: (draw[i], i))[:64])
    assert len(drawn) == 3


def test_anomaly_switch_and_distribution(blobs):
    labels = blobs.select("id", F.when(F.col("owner") == "a", 0).when(F.col("owner") == "b", 1).otherwise(2).alias("cluster"))
    same, info = anomaly.cluster_with_anomalies(labels, blobs, enable=False)
    assert same is labels and info is None
    marked, info = anomaly.cluster_with_anomalies(labels, blobs, contamination=0.9)
    row = info.first()
    assert row["contamination"] == 0.5
    spread = {r["original"]: r["n_outliers"] for r in anomaly.outlier_distribution(marked).collect()}
    assert set(spread) == {0, 1, 2} and sum(spread.values()) == row["n_outliers"]
    sizes = {r["name"]: r["size"] for r in anomaly.cluster_summary(marked).collect()}
    assert sum(sizes.values()) == 120 and sizes.get("outliers", 0) == row["n_outliers"]


def test_landmark_mode_spreads_rows_of_few_files(spark, monkeypatch):
    monkeypatch.setattr(cluster, "SPREAD_ROWS", 100)
    points = frame(spark, np.random.default_rng(0).normal(size=(1000, 2))).coalesce(1)
    rows = cluster.nystrom_embedding(points, 3, 1.0, landmarks=32).rows
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200


def test_curve_keeps_no_files_but_the_embedding(spark, blobs, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    curve = cluster.privacy_utility_curve(blobs, 3, 1.0, noise_seed="2", epsilons=(1.0, 10.0)).collect()
    assert [r["epsilon"] for r in curve] == [1.0, 10.0] and curve[0]["silhouette"] < curve[1]["silhouette"]
    left = {name.rpartition("-")[0] for name in os.listdir(tmp_path)}
    assert left - {"layout"} == {"embedding"}  # tables of tiles, which few rows go by, stay
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
