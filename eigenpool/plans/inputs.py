"""Points and run logs drawn from the shared tables, used by the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.functions.vectors import as_points, feature_array
from eigenpool.operators.prepare import adapt


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def part_points(spark: SparkSession, folder: str) -> DataFrame:
    """Size and price of parts, owned by brand."""
    return as_points(table(spark, folder, "part"), "p_partkey", "p_brand", ["p_size", "p_retailprice"])


def part_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("owner"), F.col("p_partkey").alias("id"), "p_size", "p_retailprice"
    )


def part_standard(spark: SparkSession, folder: str) -> DataFrame:
    """The same, standardised per brand."""
    return adapt(part_rows(spark, folder)).points


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    """Balance and nation of customers, owned by market segment."""
    return as_points(table(spark, folder, "customer"), "c_custkey", "c_mktsegment", ["c_acctbal", "c_nationkey"])


def supplier_points(spark: SparkSession, folder: str) -> DataFrame:
    return as_points(table(spark, folder, "supplier"), "s_suppkey", None, ["s_acctbal", "s_nationkey"])


def order_points(spark: SparkSession, folder: str) -> DataFrame:
    """Price, customer and day of orders, owned by status."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey",
        F.datediff("o_orderdate", F.lit("1992-01-01")).alias("day"),
    )
    return as_points(orders, "o_orderkey", "o_orderstatus", ["o_totalprice", "o_custkey", "day"])


def vector_points(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as double features, owned by label."""
    rows = table(spark, folder, "embeddings")
    return rows.select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("owner"),
        F.col("embedding").cast("array<double>").alias("f"), F.col("label").alias("cluster"),
    )


def event_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as a log of runs, one log per user."""
    events = table(spark, folder, "events")
    config = F.create_map(
        F.lit("k"), F.regexp_extract("props", "([0-9]+)", 1), F.lit("backend"), F.col("event_type"),
        F.lit("epsilon"), F.when(F.col("user_id") % 2 == 1, "1.0"),
    )
    scores = F.create_map(
        F.lit("Silhouette Score"), F.when(F.col("value") > 5, F.col("value") / 500).otherwise(0.0),
        F.lit("Davies-Bouldin Index"), F.col("value"),
    )
    none = F.create_map().cast("map<string,double>")
    return events.select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
        config.alias("config"),
        F.when(F.col("event_type") == "error", none).otherwise(scores).alias("metrics"),
        F.md5(F.col("user_id").cast("string").cast("binary")).alias("data_hash"), F.lit("").alias("notes"),
        F.col("user_id").alias("n_samples"), (F.col("event_id") % 5).alias("n_clusters"),
        F.col("user_id"),
    )
