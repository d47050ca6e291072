"""Helpers for the `f ARRAY<DOUBLE>` feature column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND_DIGITS = 4


def feature_array(columns: Sequence[str], name: str = "f") -> Column:
    """Pack columns into one array and remember their names in the schema."""
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    return cells.alias(name, metadata={"features": list(columns)})


def as_points(df: DataFrame, id_col: str, owner_col: str | None, columns: Sequence[str]) -> DataFrame:
    """points(id, owner, f) from a wide table; only the named columns are read."""
    owner = F.col(owner_col).cast("string") if owner_col else F.lit("all")
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), owner.alias("owner"), feature_array(columns)
    )


def width(points: DataFrame, column: str = "f") -> int:
    """Number of features: from the schema when known, otherwise from one row."""
    names = points.schema[column].metadata.get("features")
    if names:
        return len(names)
    row = points.select(F.size(column).alias("d")).first()
    if row is None:
        raise ValueError("no rows to cluster")
    return row["d"]


def sq_norm(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)


def sq_distance(a: Column, b: Column) -> Column:
    return sq_norm(F.zip_with(a, b, lambda x, y: x - y))


def no_nan(value: Column) -> Column:
    """Missing is NULL inside the library; NaN is turned into it on the way in."""
    return F.nullif(value, F.lit(float("nan")))


def rounded(value: Column, digits: int = ROUND_DIGITS) -> Column:
    """Rounded double without negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def rounded_entry(value: Column, digits: int = ROUND_DIGITS) -> Column:
    """The same as `rounded`, for columns of very many values: only values near a half are rounded as decimals, which is slow."""
    scale = F.lit(10.0 ** digits)
    scaled = value * scale
    near = F.rint(scaled)
    clear = (F.abs(scaled) < 1e9) & (F.abs(F.abs(scaled - near) - 0.5) > 1e-6)
    return F.when(clear, near / scale).otherwise(F.round(value, digits)) + F.lit(0.0)
