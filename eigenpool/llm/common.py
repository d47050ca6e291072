"""Helpers that several of these operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.session import cut_lineage

#: Words are runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows a broadcast side may have; its rows are a few fixed-width fields.
BROADCAST_ROWS = 200_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side whose rows have been counted, if they are few; else leave the join to the planner."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def ordinal(df: DataFrame, by: list[Column], name: str, within: list[str] | None = None) -> DataFrame:
    """Adds `ord`: the place of each row, from 0, in the order `by`, or among rows equal in `within`.

    Rows are range-sorted, numbered inside each range, and shifted by the sizes of the ranges
    before it. `by` begins with `within`. A hot value is spread over ranges by the later columns.
    """
    spark, within = df.sparkSession, within or []
    low = (1 << 33) - 1
    laid = cut_lineage(
        df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
        .withColumn("_m", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_part", F.shiftright("_m", 33)).withColumn("_at", F.col("_m").bitwiseAND(F.lit(low)))
    runs = laid.groupBy("_part", *within).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    runs = runs.select(*(F.col(c).alias(f"_w_{c}") for c in within), F.col("_part").alias("_p"), "_from", "_n")
    found = runs.collect()  # a row for each range and, where given, each class inside it
    if len(found) > BROADCAST_ROWS:
        raise ValueError(f"{len(found)} runs of {within} are too many to number")
    before: dict[tuple, int] = {}
    shifts = []
    for r in sorted(found, key=lambda r: r["_p"]):
        key = tuple(r[f"_w_{c}"] for c in within)
        shifts.append((*key, r["_p"], before.get(key, 0) - r["_from"]))
        before[key] = before.get(key, 0) + r["_n"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"_w_{c} {kinds[c]}" for c in within), "_p int", "_shift long"])
    shift = F.broadcast(spark.createDataFrame(shifts, schema))
    on = laid["_part"] == shift["_p"]
    for c in within:
        on = on & laid[c].eqNullSafe(shift[f"_w_{c}"])
    return laid.join(shift, on).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("ord"))


def unit(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11)).cast("double") / F.lit(float(1 << 53))


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, inside higher-order functions."""
    return F.transform(F.array(value), body)[0]
