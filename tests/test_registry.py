"""Registered queries: every SQL has its query, and results agree on the smallest tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# A spread over the operator families; every query is checked at a larger scale by the driver.
CHECKED = [
    "adapt", "drop_empty_columns", "gaussian_blobs", "split_parties", "knn_join", "gaussian_affinity", "degree_scale",
    "compare_tables", "leading_eigenvector", "eigenvalues_of_three", "spectral_partition", "spectral_partition_knn", "outlier_flags", "hopkins", "silhouette", "lof",
    "contamination_cut", "report_rows", "compare_runs_metrics", "data_fingerprint", "owner_csv_round_trip",
]


def test_sql_belongs_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark, data_dir):
    assert entry_points.entry(spark).count() > 0


def rows(frame):
    frame = frame[sorted(frame.columns)]
    show = lambda v: "" if v is None or (isinstance(v, float) and np.isnan(v)) else str(v)
    return sorted(tuple(show(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, data_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{data_dir}/{table}.parquet'")
    got = entry_points.queries()[name](spark, data_dir).toPandas()
    want = con.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
