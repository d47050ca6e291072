"""Seeded test data derived from the keys of an existing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.uniform import normal, uniform
from eigenpool.operators.joins import with_position


def gaussian_blobs(
    ids: DataFrame, n_features: int, centers: int, std: float = 1.0, seed="42", box: float = 10.0,
    shift: float = 0.0,
) -> DataFrame:
    """Isotropic blobs, one row per id; centres lie in [-box, box]."""
    center = F.pmod(F.col("id"), F.lit(centers)).cast("int")
    cells = F.array(
        *[
            F.lit(-box) + F.lit(2 * box) * uniform(seed, "center", center, j)
            + F.lit(float(std)) * normal(seed, F.col("id"), j) + F.lit(float(shift))
            for j in range(n_features)
        ]
    )
    names = [f"feature_{j + 1}" for j in range(n_features)]
    return ids.select("id", center.alias("center"), cells.alias("f", metadata={"features": names}))


def uniform_points(ids: DataFrame, n_features: int, seed="42") -> DataFrame:
    """U(0,1) features, one row per id."""
    cells = F.array(*[uniform(seed, F.col("id"), j) for j in range(n_features)])
    names = [f"feature_{j + 1}" for j in range(n_features)]
    return ids.select("id", cells.alias("f", metadata={"features": names}))


def split_parties(df: DataFrame, parties: int, order: Sequence[str]) -> DataFrame:
    """Contiguous shares by position; the last party also takes the remainder."""
    placed = with_position(df, list(order))
    share = placed.count() // parties
    if share == 0:
        return placed.withColumn("party", F.lit(parties - 1))
    party = F.least(F.floor(F.col("pos") / share), F.lit(parties - 1)).cast("int")
    return placed.withColumn("party", party)


def drop_label(df: DataFrame, column: str) -> DataFrame:
    """Remove the target column before clustering."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return df.drop(column)
