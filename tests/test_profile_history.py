import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool.functions import bands
from eigenpool.operators import history, profile
from helpers import frame


def test_wide_and_narrow_correlation_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 40))
    x[:, 1] = x[:, 0] * 2 + 0.1 * x[:, 1]
    x[:, 2] = 3.0
    for d in (5, 40):
        got = {(r["i"], r["j"]): r["r"] for r in profile.correlation_matrix(frame(spark, x[:, :d])).collect()}
        assert len(got) == d * d and got[(2, 0)] is None
        assert got[(0, 1)] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1])
        assert got[(3, 4)] == pytest.approx(np.corrcoef(x[:, 3], x[:, 4])[0, 1])
    assert profile.correlation_matrix(frame(spark, x[:, :1])).count() == 0


def test_small_samples(spark):
    tiny = frame(spark, np.random.default_rng(0).random((9, 2)))
    assert profile.hopkins(tiny).first()["hopkins"] == 0.5
    advice = [r["message"] for r in profile.profile(tiny).recommendations.collect()]
    assert any("Small sample" in m for m in advice) and any("sigma" in m for m in advice)


def test_hopkins_separates_clusters_from_noise(spark):
    rng = np.random.default_rng(3)
    flat = frame(spark, rng.random((400, 2)))
    tight = frame(spark, np.concatenate([rng.normal(size=(200, 2)) * 0.01 + c for c in (0, 5)]))
    assert profile.hopkins(tight, "1").first()["hopkins"] > 0.9
    assert 0.35 < profile.hopkins(flat, "1").first()["hopkins"] < 0.65


def test_histogram_keeps_empty_bins(spark):
    values = spark.createDataFrame([(v,) for v in [0.0, 0.1, 10.0]], "v double")
    rows = profile.value_histogram(values, "v", 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2] + [0] * 8 + [1]
    same = profile.value_histogram(values.where("v = 0"), "v", 4).agg(F.sum("n")).first()[0]
    assert same == 1


def test_noise_does_not_hide_repeated_values(spark):
    df = spark.createDataFrame([(i, float(3 * (i % 7) + 2)) for i in range(84)], "id bigint, v double")
    rows = {r["stage"]: (r["n_distinct"], r["top_count"]) for r in profile.frequency_audit(df, "id", "v", seed="1").collect()}
    assert rows["raw"] == (7, 12) and rows["recovered"] == (7, 12) and rows["noised"][0] > 50


@pytest.fixture()
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    labels = spark.createDataFrame([(0, 0, [1.0]), (1, 1, [0.0]), (2, -1, [0.5])], "id bigint, cluster int, y array<double>")

    def add(silhouette, **config):
        scores = [("Silhouette Score", silhouette), ("Davies-Bouldin Index", 1.0 - silhouette)]
        return history.add_run(path, config, spark.createDataFrame(scores, "metric string, value double"), labels, "h")

    return path, add


def test_history_round(spark, log, tmp_path):
    path, add = log
    assert [add(0.25, k=2, epsilon=None), add(0.5, k=3, sigma=1.0)] == [0, 1]
    runs = history.read_runs(spark, path).persist()
    first = history.get_run(runs, 0).first()
    assert (first["n_samples"], first["n_clusters"]) == (3, 2)
    text = {r["id"]: r["summary"] for r in history.run_summary(runs).collect()}
    assert "k=2, σ=?, ε=None" in text[0] and "Silhouette: 0.2500" in text[0] and "σ=1.0" in text[1]
    found = history.compare_runs(runs, 0, 1)
    assert found["same_data"].first()["same_data"]
    changed = {r["key"]: (r["value_1"], r["value_2"]) for r in found["config_diff"].collect()}
    assert changed == {"k": ("2", "3"), "sigma": (None, "1.0")}
    diff = {r["metric"]: r for r in found["metric_diff"].collect()}
    assert diff["Silhouette Score"]["delta"] == 0.25 and diff["Silhouette Score"]["improvement"]
    assert not diff["Davies-Bouldin Index"]["improvement"] and diff["Davies-Bouldin Index"]["better"]
    with pytest.raises(ValueError):
        history.compare_runs(runs, 0, 5)
    history.export_history_json(runs, str(tmp_path / "json"))
    back, following = history.import_history_json(spark, str(tmp_path / "json"))
    assert following == 2 and back.count() == 2
    assert back.where("id = 0").first()["config"] == {"k": "2", "epsilon": None}
    runs.unpersist()
    history.clear_history(spark, path)
    assert history.read_runs(spark, path).count() == 0 and add(0.1, k=2) == 0


def test_nan_scores_never_improve_and_numbers_compare_by_value(spark, log):
    path, add = log
    add(0.5, k=1, sigma=2, backend="mock")
    add(float("nan"), k=1.0, sigma=3, backend="mock")
    found = history.compare_runs(history.read_runs(spark, path), 0, 1)
    assert [r["key"] for r in found["config_diff"].collect()] == ["sigma"]
    assert not any(r["improvement"] or r["better"] for r in found["metric_diff"].collect())


def test_rows_go_with_their_runs(spark, log):
    path, add = log
    for _ in range(history.KEPT_RUNS + 2):
        add(0.5, k=2)
    kept = {r["run_id"] for r in history.read_run_rows(spark, path).select("run_id").distinct().collect()}
    assert kept == set(range(2, history.KEPT_RUNS + 2))
    for table, column in (("runs", "id"), ("rows", "run_id")):
        folders = {name for name in os.listdir(f"{path}/{table}") if "=" in name}
        assert folders == {f"{column}={i}" for i in kept}
    assert add(0.5, k=2) == history.KEPT_RUNS + 2


def test_missing_cells_are_no_outliers(spark):
    x = [[float(i % 4), 1.0 * (i % 3)] for i in range(40)] + [[float("nan"), 1.0], [500.0, 1.0]]
    flags = {r["id"]: r for r in profile.outlier_flags(frame(spark, x)).collect()}
    assert not flags[40]["combined"] and flags[41]["iqr"]
    cells = spark.createDataFrame([(float("nan"),), (0.9,)], "h double").select(bands.hopkins_band(F.col("h")).alias("b"))
    assert [r["b"][:3] for r in cells.collect()] == ["Low", "Str"]


def test_record_holds_every_part_of_a_profile(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    x[:, 2] = 2 * x[:, 0]
    x[7] = [40.0, 0.0, 80.0]
    found = profile.profile(frame(spark, x), seed="1")
    rows = {(r["section"], r["item"]): r for r in profile.profile_record(found).collect()}
    assert rows["basic", "n_samples"]["value"] == 60 and rows["basic", "has_missing"]["value"] == 0
    assert rows["basic", "mean_1"]["value"] == pytest.approx(x[:, 1].mean())
    assert rows["high_correlation", "r_0_2"]["value"] == pytest.approx(1) and ("high_correlation", "r_0_1") not in rows
    assert rows["outliers", "zscore_0"]["value"] == 7 and rows["density", "density_variation"]["text"] in ("High variation", "Uniform density")
    assert rows["components", "n_components"]["value"] == 1 and rows["advice", "tip"]["text"].startswith("Suggested")
    assert sum(s == "correlation" for s, _ in rows) == 9
    narrow = profile.profile_record(profile.profile(frame(spark, x[:, :1]), seed="1")).groupBy("section").count().collect()
    assert {r["section"] for r in narrow} == {"basic", "tendency", "outliers", "density", "advice"}


def test_only_twenty_runs_are_kept(spark):
    runs = spark.range(30).select("id", (F.col("id") % 2).alias("log"))
    assert sorted(r["id"] for r in history.kept_runs(runs).collect()) == list(range(10, 30))
    assert history.kept_runs(runs, keep=3, by=["log"]).count() == 6


def test_report_rows(spark):
    metrics = spark.createDataFrame([("Purity", 0.4375)], "metric string, value double")
    config = spark.createDataFrame([("sigma", "2.5")], "key string, value string")
    rows = [(r["section"], r["line"]) for r in history.report_rows(metrics, config).collect()]
    assert rows == [("1. System Configuration", "sigma: 2.5"), ("2. Clustering Quality Metrics", "Purity: 0.4375")]
    empty = history.report_rows(metrics.where("value > 1"), config).collect()
    assert empty[1]["line"] == "No metrics available."


def test_fingerprint_sees_order_and_owner(spark):
    x = [[1.0, 2.0], [3.0, 4.0]]
    mark = lambda df: history.data_fingerprint(df).first()["fingerprint"]
    base = mark(frame(spark, x))
    assert len(base) == 12 and base == mark(frame(spark, x).repartition(3))
    assert base != mark(frame(spark, x[::-1])) and base != mark(frame(spark, x, owners=["a", "b"]))
