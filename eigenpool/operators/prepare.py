"""Turning raw owner tables into standardised points, fitted per owner."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eigenpool.functions.vectors import no_nan
from eigenpool.operators.joins import join_groups, measure

NO_NUMERIC = "No numeric data found in dataset."


@dataclass(frozen=True)
class Prepared:
    """points(id, owner, f); columns kept per owner; status per owner."""

    points: DataFrame
    columns: DataFrame
    status: DataFrame


def _source_columns(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keep]


def _value(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    cell = F.col(f"`{name}`")
    return no_nan(cell.cast("double")) if isinstance(kind, (T.DoubleType, T.FloatType)) else cell


def drop_empty_rows(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> DataFrame:
    """Drop rows whose source columns are all missing; text counts as a value."""
    cells = [_value(df, c) for c in _source_columns(df, keys)]
    return df.where(F.coalesce(*[c.cast("string") for c in cells]).isNotNull())


def kept_columns(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> DataFrame:
    """(owner, column, n_values, kept): a column without values in an owner is dropped there."""
    names = _source_columns(df, keys)
    counts = df.groupBy("owner").agg(*[F.count(_value(df, c)).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_values")) for c in names])
    return (
        counts.select("owner", F.explode(pairs).alias("p"))
        .select("owner", "p.column", "p.n_values")
        .withColumn("kept", F.col("n_values") > 0)
    )


def drop_empty_columns(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> DataFrame:
    """Drop columns without any value, found in one pass over all columns."""
    names = _source_columns(df, keys)
    found = df.agg(*[F.count(_value(df, c)).alias(c) for c in names]).first()
    return df.drop(*[c for c in names if found[c] == 0])


def numeric_columns(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> list[str]:
    """Names of numeric columns (booleans are not numeric); none is an error."""
    names = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys
    ]
    if not names:
        raise ValueError(NO_NUMERIC)
    return names


def select_numeric(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> DataFrame:
    names = numeric_columns(df, keys)
    return df.select(*[k for k in keys if k in df.columns], *[F.col(f"`{c}`") for c in names])


def owner_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One aggregate per owner: rows, and values, mean, variance, infinities per column.

    Filling gaps with the mean leaves the mean alone and shrinks the population
    variance by the share of present values, so both steps need this one pass.
    """
    stats = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        x = no_nan(F.col(f"`{c}`").cast("double"))
        finite = F.when(F.abs(x) != F.lit(float("inf")), x)
        stats += [
            F.count(x).alias(f"n_{i}"),
            F.avg(finite).alias(f"mean_{i}"),
            F.var_pop(finite).alias(f"var_{i}"),
            F.count_if(F.abs(x) == F.lit(float("inf"))).alias(f"inf_{i}"),
        ]
    return df.groupBy("owner").agg(*stats)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing values with the owner's column mean."""
    stats = owner_moments(df, columns).select(
        "owner", "n_rows", *[f"mean_{i}" for i in range(len(columns))]
    )
    joined = join_groups(df, stats, ["owner"], "n_rows")
    filled = {
        c: F.coalesce(no_nan(F.col(f"`{c}`").cast("double")), F.col(f"mean_{i}"))
        for i, c in enumerate(columns)
    }
    return joined.withColumns(filled).select(*[F.col(f"`{c}`") for c in df.columns])


def _zscore(name: str, i: int):
    x = no_nan(F.col(f"`{name}`").cast("double"))
    mean = F.col(f"mean_{i}")
    spread = F.sqrt(F.col(f"var_{i}") * F.col(f"n_{i}") / F.col("n_rows"))
    gap = F.coalesce(x, mean) - mean
    return F.when(mean.isNotNull(), F.coalesce(gap / F.nullif(spread, F.lit(0.0)), F.lit(0.0)))


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population z-score per owner; a constant column becomes zeros."""
    stats = owner_moments(df, columns)
    joined = join_groups(df, stats, ["owner"], "n_rows")
    return joined.withColumns({c: _zscore(c, i) for i, c in enumerate(columns)}).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )


def with_status(stats: DataFrame, n_columns: int) -> DataFrame:
    """Adds to an owner's moments whether it is usable (ok, error) and the columns it has values in (n_used)."""
    present = sum((F.when(F.col(f"n_{i}") > 0, 1).otherwise(0) for i in range(n_columns)), F.lit(0))
    infinite = sum((F.col(f"inf_{i}") for i in range(n_columns)), F.lit(0))
    error = F.when(present == 0, F.lit(NO_NUMERIC)).when(
        infinite > 0, F.lit("Numeric data holds infinite values.")
    )
    return stats.select("*", error.isNull().alias("ok"), error.alias("error"), present.alias("n_used"))


def adapt(df: DataFrame, keys: Sequence[str] = ("owner", "id")) -> Prepared:
    """Raw rows (owner, id, columns...) to standardised points, owner by owner.

    Empty rows go first, then columns without values in an owner, then text columns;
    gaps are filled and every column is standardised with the owner's own moments.
    Owners without usable numbers are reported in `status` and left out. The others
    must end up with the same number of columns.
    """
    names = numeric_columns(df, keys)
    rows = drop_empty_rows(df, keys).select(*keys, *[F.col(f"`{c}`") for c in names])
    stats = with_status(owner_moments(rows, names), len(names)).persist()
    usable = F.when(F.col("ok"), F.col("n_used"))
    size = measure(stats, "n_rows", F.min(usable).alias("least"), F.max(usable).alias("most"))
    if size["most"] is None:
        raise ValueError(NO_NUMERIC)
    if size["least"] < size["most"]:
        raise ValueError("owners differ in the number of numeric columns")
    joined = join_groups(rows, stats.where("ok"), ["owner"], "n_rows", size=size)
    cells = F.filter(F.array(*[_zscore(c, i) for i, c in enumerate(names)]), lambda z: z.isNotNull())
    features = names if size["most"] == len(names) else [f"feature_{i}" for i in range(size["most"])]
    points = joined.select("id", "owner", cells.alias("f", metadata={"features": features}))
    kept = stats.select(
        "owner",
        F.filter(
            F.array(*[F.when(F.col(f"n_{i}") > 0, F.lit(c)) for i, c in enumerate(names)]),
            lambda c: c.isNotNull(),
        ).alias("columns"),
    )
    status = stats.select("owner", "ok", "error", F.col("n_used").alias("width"))
    return Prepared(points=points, columns=kept, status=status)
