"""Owner tables: one headered CSV per owner in, one folder per owner out."""

from __future__ import annotations

import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eigenpool.operators.joins import first_per_group, join_groups, with_position
from eigenpool.operators.prepare import NO_NUMERIC

# Texts read as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
]
# Fixed value: what counts as a number; a cast alone takes suffixes such as 12d.
NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"

HEADER_READS = 16
PLACE = ["__file", "__block", "__line"]
ROWS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class OwnerTables:
    """rows(owner, id, columns...) of the readable owners, and status(owner, ok, error)."""

    rows: DataFrame
    status: DataFrame


def _header(spark: SparkSession, path: str) -> tuple[list[str] | None, str | None]:
    try:
        columns = spark.read.csv(path, header=True).columns
    except AnalysisException as problem:
        return None, str(problem).splitlines()[0]
    return (columns, None) if columns else (None, "No columns to parse from file")


def _scan(spark: SparkSession, paths: dict[str, str], columns: list[str]) -> DataFrame:
    """All files sharing one header in a single scan, every cell as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    extra = T.StructField("__extra", T.StringType())
    files = spark.read.csv(
        list(paths.values()), header=True, enforceSchema=True, schema=schema.add(extra)
    )
    cells = [
        F.when(~F.trim(F.col(f"`{c}`")).isin(MISSING), F.trim(F.col(f"`{c}`"))).alias(c) for c in columns
    ]
    parent = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    folder = F.when(parent.startswith("owner="), F.url_decode(F.url_decode(F.substring(parent, 7, 1_000_000))))
    owner = F.coalesce(folder, F.url_decode(F.col("_metadata.file_name")))
    return files.select(
        owner.alias("owner"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"),
        *cells, F.col("__extra").isNotNull().alias("__long"),
    )


def read_owner_csvs(spark: SparkSession, paths: Sequence[str]) -> OwnerTables:
    """Read one CSV per owner; an unreadable owner is reported and the others go on.

    Headers differ between owners, and a CSV scan matches by position, so files are
    scanned together only when their headers agree. A column is numeric in an owner
    when every present value parses as a number; elsewhere it counts as text. `id` is the
    position in the stack of all owners: owners in the given order, rows as in the file.
    """
    by_header: dict[tuple[str, ...], dict[str, str]] = {}
    failed: list[tuple[str, bool, str]] = []
    names: list[str] = []
    with ThreadPoolExecutor(HEADER_READS) as pool:
        headers = list(pool.map(lambda path: _header(spark, path), paths))
    for path, (columns, error) in zip(paths, headers):
        base = os.path.basename(path.rstrip("/"))
        owner = unquote(base[len("owner="):]) if base.startswith("owner=") else base
        names.append(owner)
        if error:
            failed.append((owner, False, error))
        else:
            by_header.setdefault(tuple(columns), {})[owner] = path
    if not by_header:
        raise ValueError(NO_NUMERIC)

    numeric_parts, status_parts = [], []
    for header, group in by_header.items():
        columns = list(header)
        cells = _scan(spark, group, columns)
        number = {c: F.when(F.col(f"`{c}`").rlike(NUMBER), F.col(f"`{c}`").try_cast("double")) for c in columns}
        facts = cells.groupBy("owner").agg(
            F.max("__long").alias("long_row"),
            *[
                ((F.count(F.col(f"`{c}`")) == F.count(number[c])) & (F.count(number[c]) > 0)).alias(f"ok_{i}")
                for i, c in enumerate(columns)
            ],
        ).persist()
        any_number = reduce(lambda a, b: a | b, [F.col(f"ok_{i}") for i in range(len(columns))])
        error = F.when(F.col("long_row"), F.lit("a row has more fields than the header")).when(
            ~any_number, F.lit(NO_NUMERIC)
        )
        status_parts.append(facts.select("owner", error.isNull().alias("ok"), error.alias("error")))
        good = facts.where(~F.col("long_row") & any_number).drop("long_row")
        present = cells.where(F.coalesce(*[F.col(f"`{c}`") for c in columns]).isNotNull())
        values = [F.when(F.col(f"ok_{i}"), number[c]).alias(c) for i, c in enumerate(columns)]
        numeric_parts.append(present.join(F.broadcast(good), "owner").select("owner", *PLACE, *values))
    turns = spark.createDataFrame([(o, i) for i, o in enumerate(names)], "owner string, __turn int")
    pooled = pool_owners(numeric_parts).join(F.broadcast(turns), "owner")
    placed = with_position(pooled, ["__turn", *PLACE], "id").drop("__turn", *PLACE)
    rows = placed.select("owner", "id", *[F.col(f"`{c}`") for c in placed.columns if c not in ("owner", "id")])
    status = reduce(DataFrame.unionByName, status_parts)
    if failed:
        status = status.unionByName(
            spark.createDataFrame(failed, "owner string, ok boolean, error string")
        )
    return OwnerTables(rows=rows, status=status)


def pool_owners(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union of owner tables; a column one owner lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def pool_points(tables: dict[str, DataFrame] | Sequence[DataFrame]) -> DataFrame:
    """Stack points of several owners; widths must agree. A list is named User_0, User_1, ..."""
    named = tables if isinstance(tables, dict) else {f"User_{i}": t for i, t in enumerate(tables)}
    from eigenpool.functions.vectors import width

    if len({width(t) for t in named.values()}) > 1:
        raise ValueError("owners differ in the number of features")
    parts = [t.select("id", F.lit(o).alias("owner"), "f") for o, t in named.items()]
    return reduce(DataFrame.unionByName, parts)


def write_owner_csvs(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder of headered CSV per owner, in as many files as its rows call for."""
    counts = df.groupBy("owner").agg(F.count(F.lit(1)).alias("__n"))
    sized = join_groups(df, counts, ["owner"], "__n")
    files = F.ceil(F.col("__n") / rows_per_file)
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), files)
    sized.repartition("owner", share).drop("__n").write.partitionBy("owner").option("header", True).csv(path)


def owner_folders(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder of owner tables, on any file system Spark can reach."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = [f.getPath().getName() for f in files]
    return [f"{path}/{n}" for n in sorted(names) if not n.startswith(("_", "."))]


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First n rows per owner with the owner's row count and the number of columns."""
    shape = df.groupBy("owner").agg(F.count(F.lit(1)).alias("n_rows"))
    columns = len([c for c in df.columns if c not in ("owner", "id")])
    top = first_per_group(df, ["owner"], ["id"], n)
    return top.join(shape, "owner").withColumn("n_columns", F.lit(columns))
