"""Joining per-group results back to rows when one group may hold a third of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eigenpool.session import cut_lineage

BROADCAST_BYTES = 64 << 20
HOT_GROUPS = 1_000
HOT_ROWS = 10_000


def _row_bytes(groups: DataFrame):
    """Estimated bytes per row: fixed fields, plus the longest array or text seen."""
    total = F.lit(16)
    for field in groups.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            total = total + F.coalesce(F.max(F.size(F.col(f"`{field.name}`"))), F.lit(0)) * 32
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.max(F.octet_length(F.col(f"`{field.name}`"))), F.lit(0)) + 16
        else:
            total = total + 16
    return total


def measure(groups: DataFrame, weight: str, *more: Column) -> Row:
    """Number of groups, their rows, the largest, the bytes of a group, and `more` aggregates, in one pass."""
    return groups.agg(
        F.count(F.lit(1)).alias("n"), F.sum(weight).alias("rows"), F.max(weight).alias("top"),
        _row_bytes(groups).alias("width"), *more,
    ).first()


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    size: Row | None = None,
) -> DataFrame:
    """Inner join of rows to their group's values; `weight` is the rows per group.

    The group side is measured first, unless `size` is a measure of it or of more groups. Small
    enough: broadcast. Otherwise a shuffle join, in which the hot groups (more rows than a fixed
    share of all, so their number is bounded) go by broadcast and never meet in one task.
    """
    if size is None:
        groups = groups.persist()
        size = measure(groups, weight)
    if size["n"] * size["width"] <= broadcast_bytes:
        return rows.join(F.broadcast(groups), keys)
    hot_limit = max(hot_rows, (size["rows"] or 0) // HOT_GROUPS)
    if size["top"] <= hot_limit:
        return rows.join(groups, keys)
    hot = F.broadcast(groups.where(F.col(weight) > hot_limit))
    cold = groups.where(F.col(weight) <= hot_limit)
    direct = rows.join(hot, keys)
    spread = rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys)
    return direct.unionByName(spread)


def with_position(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based global position by a stated order ending in a unique key, not sorted in one task.

    Rows are range-partitioned and sorted; the partition sizes (one number per
    partition) give each partition its offset.
    """
    part, local = f"__{name}_part", f"__{name}_local"
    ranged = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(local, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r[part]):
        offsets.append((row[part], total))
        total += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, f"{part} int, __start bigint")
    return (
        ranged.join(F.broadcast(starts), part)
        .withColumn(name, F.col("__start") + F.col(local))
        .drop(part, local, "__start")
    )


def first_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First n rows per group; each map task keeps at most n rows of a group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
