"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eigenpool.plans.queries import QUERIES  # noqa: E402
from eigenpool.session import local_session  # noqa: E402

HEADLINE = [
    "adapt", "owner_moments", "basic_stats", "outlier_flags", "correlation_matrix", "pca_variance", "hopkins",
    "density", "knn_join", "knn_join_with_self", "lof", "lof_severity", "iforest", "contamination_cut",
    "gaussian_affinity", "affinity_entries", "normalized_affinity", "degree_scale", "compare_tables",
    "silhouette", "davies_bouldin", "adjusted_rand", "tune_k", "spectral_cluster_nystrom",
    "spectral_cluster", "spectral_cluster_knn", "privacy_utility_curve", "report_rows", "compare_runs_metrics", "data_fingerprint",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores)
    QUERIES["basic_stats"](spark, folder).collect()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).replace("sf", ""),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
