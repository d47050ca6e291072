"""Symmetric matrices as long tables (i, j, value), and row operations on embeddings.

Indices may stand for several equal rows; `mi` and `mj` are then their counts. Matrices that tiles list
(`TiledEntries`) are summed and scaled there: only values of rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.bands import label_name
from eigenpool.functions.uniform import laplace, secret_seed
from eigenpool.functions.vectors import sq_norm
from eigenpool.operators.entries import TiledEntries
from eigenpool.operators.joins import join_groups

DEGREE_FLOOR = 1e-9


def degree(w: DataFrame | TiledEntries, value: str = "w", copies: str | None = None) -> DataFrame:
    """(i, degree, n): row sums with the diagonal, floored; n is the entries per row."""
    if isinstance(w, TiledEntries):
        return w.row_sums(value, copies).select("i", F.greatest("total", F.lit(DEGREE_FLOOR)).alias("degree"), "n")
    cell = F.col(value) * F.col(copies) if copies else F.col(value)
    return w.groupBy("i").agg(
        F.greatest(F.sum(cell), F.lit(DEGREE_FLOOR)).alias("degree"), F.count(F.lit(1)).alias("n")
    )


def degree_scale(
    w: DataFrame | TiledEntries, degrees: DataFrame, power: float, value: str = "w", out: str = "m"
) -> DataFrame | TiledEntries:
    """value_ij * degree_i^power * degree_j^power; degrees are (i, degree, n)."""
    if isinstance(w, TiledEntries):
        return w.scaled(value, degrees.select("i", F.pow("degree", F.lit(power)).alias("factor")), out)
    factor = degrees.select("i", F.pow("degree", F.lit(power)).alias("fi"), "n")
    half = join_groups(w, factor, ["i"], "n").drop("n")
    other = factor.select(F.col("i").alias("j"), F.col("fi").alias("fj"), "n")
    full = join_groups(half, other, ["j"], "n").drop("n")
    return full.withColumn(out, F.col(value) * F.col("fi") * F.col("fj")).drop("fi", "fj")


def normalized_affinity(w: DataFrame | TiledEntries, copies: str | None = None) -> DataFrame | TiledEntries:
    """M = D^-1/2 W D^-1/2 beside W: (i, j, w, m)."""
    return degree_scale(w, degree(w, copies=copies), -0.5)


def laplacian(m: DataFrame | TiledEntries) -> DataFrame:
    """I - M beside M: (i, j, m, l)."""
    return m.withColumn("l", F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0) - F.col("m"))


def reconstruct_affinity(m: DataFrame | TiledEntries, degrees: DataFrame) -> DataFrame | TiledEntries:
    """W = D^1/2 M D^1/2 when the degrees are known: adds column `w_back`."""
    return degree_scale(m, degrees, 0.5, value="m", out="w_back")


def row_normalize(y: DataFrame, column: str = "y") -> DataFrame:
    """Rows of unit length; zero rows stay as they are."""
    norm = F.sqrt(sq_norm(F.col(column)))
    return y.withColumn(
        column, F.when(norm > 0, F.transform(column, lambda v: v / F.nullif(norm, F.lit(0.0)))).otherwise(F.col(column))
    )


def laplace_noise(
    y: DataFrame, epsilon: float | Column | None, seed=None, column: str = "y", key: str = "id"
) -> DataFrame:
    """Laplace perturbation of scale 0.5/epsilon per cell; none for a missing or non-positive epsilon.

    The seed is secret and fresh unless one is given for a test: with a known seed the
    noise can be taken off again. No privacy guarantee is claimed for the scale.
    """
    if epsilon is None or (not isinstance(epsilon, Column) and epsilon <= 0):
        return y
    seed = secret_seed() if seed is None else seed
    scale = F.lit(0.5) / (epsilon if isinstance(epsilon, Column) else F.lit(float(epsilon)))
    return y.withColumn(
        column, F.transform(column, lambda v, i: v + laplace(seed, scale, F.col(key), i))
    )


def value_columns(df: DataFrame, column: str, prefix: str, n: int) -> DataFrame:
    """Array cells as columns prefix_0 .. prefix_{n-1}."""
    cells = [F.col(column)[i].alias(f"{prefix}_{i}") for i in range(n)]
    return df.select(*[c for c in df.columns if c != column], *cells)


def display_table(df: DataFrame, column: str, prefix: str, n: int, label: str = "cluster") -> DataFrame:
    """`value_columns` with the label as its display name in `Cluster`; rows without a label have none."""
    return value_columns(df.withColumn(label, label_name(F.col(label))).withColumnRenamed(label, "Cluster"), column, prefix, n)


def tween_frames(y: DataFrame, frames: int = 20, seed="42", column: str = "y", label: str | None = None) -> DataFrame:
    """(frame, id, x, y): eased path from a hashed N(0,1)*2 start to the first two coordinates.

    With a label, every row also holds it as text in `Cluster`.
    """
    from eigenpool.functions.uniform import normal

    share = F.col("frame") / F.lit(float(max(frames - 1, 1)))
    ease = F.lit(0.5) * (F.lit(1.0) - F.cos(F.lit(3.141592653589793) * share))
    shown = [F.col(label).cast("string").alias("Cluster")] if label else []
    start = y.select(
        "id", *shown, F.col(column)[0].alias("x1"), F.col(column)[1].alias("y1"),
        (normal(seed, F.col("id"), 0) * 2).alias("x0"), (normal(seed, F.col("id"), 1) * 2).alias("y0"),
    )
    moves = start.select("*", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("frame")).withColumn("e", ease)
    return moves.select(
        "frame", "id",
        ((1 - F.col("e")) * F.col("x0") + F.col("e") * F.col("x1")).alias("x"),
        ((1 - F.col("e")) * F.col("y0") + F.col("e") * F.col("y1")).alias("y"), *(["Cluster"] if label else []),
    )


def axis_ranges(frames: DataFrame) -> DataFrame:
    """One row with the plot range: one unit beyond the extremes on both axes."""
    return frames.agg(
        (F.min("x") - 1).alias("x_from"), (F.max("x") + 1).alias("x_to"),
        (F.min("y") - 1).alias("y_from"), (F.max("y") + 1).alias("y_to"),
    )
