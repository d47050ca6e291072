"""Blocked pair work: Spark places and prunes block pairs, numpy fills each tile.

Points are grouped around pivots into blocks of bounded size. A tile is a pair of
blocks; it is scheduled only if the triangle inequality leaves room for a pair
within the caller's reach. Tiles are worked off in cells, pairs of strips of blocks, of
which there is a bounded number, so a row is sent a bounded number of times. Each cell
hands back partial results per point; pairs themselves are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.vectors import width
from eigenpool.session import cut_lineage

BLOCK_ROWS = 2048
#: Small inputs are cut into this many blocks too: there is one path for all sizes.
MIN_BLOCKS = 8
#: With at most this many blocks the plan has half a million rows of two numbers and may be broadcast.
BROADCAST_BLOCKS = 1000
MAX_PIVOTS = 2048
#: Blocks are cut into this many strips, so a row is sent to at most as many cells; strips hold at most so many bytes, though.
STRIPS, STRIP_BYTES = 16, 64 << 20
#: Partial results that a cell holds before it adds them up.
HELD_ROWS = 1 << 20
DIRECT_WIDTH = 24


@dataclass(frozen=True)
class Copies:
    """Equal rows folded into one: groups(gid, f, ..., m), with their counts."""

    groups: DataFrame
    keys: list[str]
    n_rows: int
    n_groups: int
    top: int


def fold_copies(points: DataFrame, extra: list[str] | None = None) -> Copies:
    """Fold rows with equal features (and extra keys); `m` counts them, `gid` is the least id.

    The count is pre-aggregated before the shuffle, so a hot group of copies costs
    one row per map task.
    """
    keys = ["f", *(extra or [])]
    meta = points.schema["f"].metadata
    groups = cut_lineage(
        points.groupBy(*keys)
        .agg(F.min("id").alias("gid"), F.count(F.lit(1)).alias("m"))
        .withColumn("f", F.col("f").alias("f", metadata=meta)),
        "copies",
    )
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("rows"), F.max("m").alias("top")).first()
    if not size["n"]:
        raise ValueError("no rows to cluster")
    return Copies(groups, keys, size["rows"], size["n"], size["top"])


@dataclass(frozen=True)
class Blocks:
    """rows(block, ...) and, per block, its pivot and radius (driver arrays)."""

    rows: DataFrame
    pivots: np.ndarray
    pivot_of: np.ndarray
    radius: np.ndarray
    block_rows: int = BLOCK_ROWS

    @property
    def count(self) -> int:
        return len(self.radius)


@dataclass
class Side:
    """One block inside a task, as numpy columns."""

    x: np.ndarray
    cols: dict[str, np.ndarray]

    def __getitem__(self, name: str) -> np.ndarray:
        return self.cols[name]

    def __len__(self) -> int:
        return len(self.x)


def list_matrix(column) -> np.ndarray:
    """Arrow list column of equal lengths to a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def direct_sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by differences, feature by feature, whatever the width."""
    out = None
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        np.multiply(gap, gap, out=gap)
        out = gap if out is None else np.add(out, gap, out=out)
    return np.zeros((len(a), len(b))) if out is None else out


def sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances; narrow data by differences, wide data by a centred product."""
    if a.shape[1] <= DIRECT_WIDTH:
        return direct_sq_distances(a, b)
    centre = a.mean(axis=0)
    a, b = a - centre, b - centre
    out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(out, 0.0)


def _nearest_pivot(pivots: np.ndarray) -> Callable:
    def assign(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = list_matrix(batch.column("f"))
            cell = np.empty(len(x), dtype=np.int32)
            dist = np.empty(len(x))
            for s in range(0, len(x), 1024):
                d2 = sq_distances(x[s:s + 1024], pivots)
                best = d2.argmin(axis=1)
                cell[s:s + 1024] = best
                dist[s:s + 1024] = np.sqrt(((x[s:s + 1024] - pivots[best]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(dist)], [*batch.schema.names, "cell", "dist"]
            )

    return assign


def build_blocks(points: DataFrame, n: int, key: str = "gid", block_rows: int = BLOCK_ROWS) -> Blocks:
    """Group points(key, f, ...) around pivots into blocks of about block_rows rows.

    Pivots are a hash-ordered sample, so dense regions get more of them; a cell that
    is still too large is split by hash. At most MAX_PIVOTS pivots leave the cluster.
    """
    d = width(points)
    wanted = max(math.ceil(n / block_rows), min(MIN_BLOCKS, n))
    if wanted <= 1:  # one row
        return Blocks(points.withColumn("block", F.lit(0)), np.zeros((1, d)), np.zeros(1, int), np.array([np.inf]), block_rows)
    chosen = points.select("f", F.xxhash64(key).alias("h"), key).orderBy("h", key).limit(min(wanted, MAX_PIVOTS))
    pivots = np.array([r["f"] for r in chosen.select("f").collect()], dtype=float)
    columns = [c for c in points.columns if c not in ("cell", "dist", "block")]
    kinds = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in columns)
    placed = cut_lineage(
        points.select(*columns).mapInArrow(_nearest_pivot(pivots), f"{kinds}, cell int, dist double"), "blocks"
    )
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
    base, layout = 0, []
    for row in cells:
        parts = math.ceil(row["n"] / block_rows)
        layout.append((row["cell"], base, parts))
        base += parts
    frame = points.sparkSession.createDataFrame(layout, "cell int, base int, parts int")
    rows = (
        placed.join(F.broadcast(frame), "cell")
        .withColumn("block", (F.col("base") + F.pmod(F.xxhash64(F.lit("part"), key), F.col("parts"))).cast("int"))
        .drop("base", "parts")
    )
    pivot_of = np.concatenate([np.full(parts, cell) for cell, _, parts in layout])
    radius = np.zeros(base)
    for row in rows.groupBy("block").agg(F.max("dist").alias("r")).collect():
        radius[row["block"]] = row["r"]
    return Blocks(rows.drop("cell", "dist"), pivots, pivot_of, radius, block_rows)


def _nearby(blocks: Blocks, reach: np.ndarray | float) -> Callable:
    """near(b, others): which of the other blocks may hold a pair with block b within reach of either block."""
    limits = np.broadcast_to(np.asarray(reach, dtype=float), (blocks.count,))
    pivots, pivot_of, radius = blocks.pivots, blocks.pivot_of, blocks.radius
    slack = 1e-9 * (1.0 + float(np.abs(pivots).max()))

    def near(b: int, others: np.ndarray) -> np.ndarray:
        gap = np.sqrt(((pivots - pivots[pivot_of[b]]) ** 2).sum(1))[pivot_of[others]]
        room = gap - radius[b] - radius[others] - slack
        return others[room <= np.maximum(limits[b], limits[others])]

    return near


def tile_plan(blocks: Blocks, reach: np.ndarray | float = math.inf) -> DataFrame:
    """(b, c) with b <= c for block pairs that may hold a pair within reach of either block."""
    count, near = blocks.count, _nearby(blocks, reach)

    def partners(batches):
        for batch in batches:
            for b in batch.column("id").to_numpy():
                found = near(b, np.arange(b, count))
                if len(found):
                    pair = [np.full(len(found), b, dtype=np.int32), found.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(side) for side in pair], ["b", "c"])

    return blocks.rows.sparkSession.range(count).mapInArrow(partners, "b int, c int")


def side_of(table: pa.Table) -> Side:
    cols = {}
    for name in table.schema.names:
        column = table.column(name)
        if pa.types.is_list(column.type) and name != "ids":
            cols[name] = list_matrix(column)
        elif pa.types.is_list(column.type):
            cols[name] = column.combine_chunks()
        else:
            cols[name] = column.to_numpy()
    return Side(cols["f"], cols)


def _blocks_of(table: pa.Table) -> dict[int, Side]:
    """The rows of each block of a cell."""
    table = table.combine_chunks()
    table = table.take(pa.array(np.argsort(table.column("block").to_numpy(), kind="stable")))
    found, first = np.unique(table.column("block").to_numpy(), return_index=True)
    ends = [*first[1:], table.num_rows]
    return {int(b): side_of(table.slice(i, j - i).combine_chunks()) for b, i, j in zip(found, first, ends)}


def run_cells(
    blocks: Blocks, work: Callable, schema: str, reach: np.ndarray | float = math.inf, inside: bool = True, across: bool = True,
) -> DataFrame:
    """work(tiles) -> tables, once per cell; tiles are (b, c, left, right) with b <= c for blocks within reach.

    `inside` takes the tiles of a block with itself, `across` those of two blocks. A block is sent only to cells where it has a tile.
    """
    rows, count, near = blocks.rows, blocks.count, _nearby(blocks, reach)
    spark = rows.sparkSession
    strip_rows = max(1, STRIP_BYTES // (8 * blocks.pivots.shape[1] + 64))
    size = max(1, min(math.ceil(count / STRIPS), strip_rows // blocks.block_rows))
    strips = -(-count // size)

    def tiles_of(b: int, others: np.ndarray) -> np.ndarray:
        found = near(b, others) if across else others[others == b]
        return found if inside else found[found != b]

    def cells(batches):
        for batch in batches:
            for b in batch.column("id").to_numpy():
                other = np.unique(tiles_of(b, np.arange(count)) // size)
                own = b // size
                at = np.minimum(own, other).astype(np.int64) * strips + np.maximum(own, other)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(other), b, dtype=np.int32)), pa.array(at), pa.array((own > other).astype(np.int32))], ["_block", "cell", "side"])

    members = spark.range(count).mapInArrow(cells, "_block int, cell bigint, side int")
    members = F.broadcast(members) if count <= BROADCAST_BLOCKS else members.hint("merge")
    tasks = min(strips * (strips + 1) // 2, max(4 * spark.sparkContext.defaultParallelism, STRIPS * (STRIPS + 1) // 2, strips))
    sent = rows.join(members, F.col("block") == F.col("_block")).drop("_block").repartition(tasks, "cell")

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        first = table.column("side").to_numpy() == 0
        left = _blocks_of(table.filter(pa.array(first)))
        alone = first.all()
        right = left if alone else _blocks_of(table.filter(pa.array(~first)))
        del table

        def tiles():
            others = np.array(sorted(right))
            for b in sorted(left):
                for c in tiles_of(b, others[others >= b] if alone else others):
                    yield b, int(c), left[b], right[int(c)]

        for out in work(tiles()):
            yield from out.to_batches(max_chunksize=1 << 16)

    return sent.groupBy("cell").applyInArrow(cell, schema)


def run_tiles(
    blocks: Blocks, fn: Callable, schema: str, reach: np.ndarray | float = math.inf, inside: bool = True, across: bool = True,
    total: dict[str, str] | None = None,
) -> DataFrame:
    """fn(left, right, same) -> dict of columns, or a list of them, called once per tile within reach.

    With `total`, columns and how they add up ("sum", "min", "max"), a cell hands on one line for each value of the others.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    keys = [n for n in names if n not in (total or {})]

    def add_up(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by(keys, use_threads=False).aggregate(list(total.items()))
        return sums.select([n if n in keys else f"{n}_{total[n]}" for n in names]).rename_columns(names)

    def work(tiles):
        held, size = [], 0
        for b, c, left, right in tiles:
            out = fn(left, right, b == c)
            if total is None:
                yield from (pa.table({name: one[name] for name in names}) for one in (out if isinstance(out, list) else [out]))
                continue
            out = pa.table({name: out[name] for name in names})
            held.append(out)
            size += out.num_rows
            if size > HELD_ROWS:
                held = [add_up(held)]
                size = held[0].num_rows // 2  # adding up pays when as many have come again
        if held:
            yield add_up(held)

    return run_cells(blocks, work, schema, reach, inside, across)
