"""Static layouts: large operands stay where they lie, and only vectors are sent to them.

Rows are packed by part, a block or a strip of them: one table row holds the keys of a part and matrices with a line for
each, as binary columns. A layout is a table of packed operands, bucketed by the cell that uses them and written once. Each
pass sends a cell the packed vectors of its parts, computes there, and hands back packed results. As the layout is read
by bucket, a pass shuffles vectors only, in as many rows as there are parts in cells; a lost executor rereads its buckets.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.operators.tiles import Blocks, list_matrix, tile_plan
from eigenpool.session import cut_lineage, scratch_path

#: A strip of cells has at most this many blocks.
STRIP_BLOCKS = 8
MAX_BUCKETS = 4096
#: Products between two exchanges on a graph, and how many times their own rows strips may hold for that.
MAX_HOPS, HALO = 8, 2.5


def packed(matrix: np.ndarray, kind=np.float64) -> bytes:
    return np.ascontiguousarray(matrix, dtype=kind).tobytes()


def unpacked(cell, lines: int) -> np.ndarray:
    """The matrix with so many lines of a binary cell."""
    return np.frombuffer(cell.as_buffer(), np.float64).reshape(lines, -1)


def keys_of(cell, kind=np.int64) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def pack_rows(rows: DataFrame, part: str, matrices: list[str]) -> DataFrame:
    """(part, n, keys, <matrices>) of rows (key, part, <matrices as arrays or numbers>), keys ascending in each part."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        out = {"part": [table.column("part")[0].as_py()], "n": [table.num_rows], "keys": [packed(table.column("key").to_numpy(), np.int64)]}
        for name in matrices:
            column = table.column(name)
            out[name] = [packed(list_matrix(column) if pa.types.is_list(column.type) else column.to_numpy())]
        return pa.table(out, schema=schema)

    schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), *((m, pa.binary()) for m in matrices)])
    named = rows.select("key", F.col(part).cast("int").alias("part"), *matrices)
    return named.groupBy("part").applyInArrow(pack, "part int, n int, keys binary, " + ", ".join(f"{m} binary" for m in matrices))


def unpack_rows(parts: DataFrame, matrices: list[str]) -> DataFrame:
    """(key, <matrices as arrays>) of packed parts."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch["n"][i].as_py()
                lists = []
                for name in matrices:
                    matrix = unpacked(batch[name][i], n)
                    lists.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel())))
                yield pa.RecordBatch.from_arrays([pa.array(keys_of(batch["keys"][i])), *lists], ["key", *matrices])

    return parts.select("n", "keys", *matrices).mapInArrow(unpack, "key bigint, " + ", ".join(f"{m} array<double>" for m in matrices))


def lines_of(batches, columns: list[str]):
    """The matrices of each packed row."""
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch["n"][i].as_py()
            yield i, batch, {c: unpacked(batch[c][i], n) for c in columns}


def map_parts(parts: DataFrame, made: dict[str, tuple[list[str], Callable]]) -> DataFrame:
    """(part, n, <made>): new matrices fn(matrices of the named columns) of every packed row."""
    needed = sorted({c for columns, _ in made.values() for c in columns})

    def run(batches):
        for i, batch, matrices in lines_of(batches, needed):
            cells = [pa.array([packed(fn(*(matrices[c] for c in columns)))], pa.binary()) for columns, fn in made.values()]
            yield pa.RecordBatch.from_arrays([batch["part"].slice(i, 1), batch["n"].slice(i, 1), *cells], ["part", "n", *made])

    return parts.select("part", "n", *needed).mapInArrow(run, "part int, n int, " + ", ".join(f"{c} binary" for c in made))


def bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows written once, bucketed by key: grouping or joining on it needs no exchange of them.

    The files lie in the shared folder; the table's name lives as long as the session.
    """
    spark = rows.sparkSession
    name = f"eigenpool_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)
    writer.option("path", scratch_path(spark, "layout")).saveAsTable(name)
    return spark.table(name)


def buckets_for(df: DataFrame, cells: int) -> int:
    return max(1, min(cells, MAX_BUCKETS, max(4 * df.sparkSession.sparkContext.defaultParallelism, cells // 4)))


@dataclass(frozen=True)
class TileLayout:
    """rows(cell, side, part, n, f) bucketed by cell, members(cell, side, strip), and the packed parts(part, n, keys, f, ...)."""

    rows: DataFrame
    members: DataFrame
    parts: DataFrame
    strip_blocks: int
    reach: float

    def product(self, vectors: DataFrame, weights: Callable) -> DataFrame:
        """(part, z): a symmetric matrix, given tile by tile as weights(x, y, same), times vectors (part, v)."""
        strip = F.floor(F.col("part") / self.strip_blocks).cast("int").alias("strip")
        sent = vectors.select(strip, "part", "v").join(self.members, "strip").select("cell", "part", "v")
        reach = self.reach

        def cell(here: pa.Table, there: pa.Table) -> pa.Table:
            v = dict(zip(there.column("part").to_pylist(), there.column("v").combine_chunks()))
            sides: list[list] = [[], []]
            for side, part, n, f in zip(here.column("side").to_pylist(), here.column("part").to_pylist(), here.column("n").to_pylist(), here.column("f").combine_chunks()):
                x = unpacked(f, n)
                centre = x.mean(0)
                sides[side].append((part, x, unpacked(v[part], n), centre, math.sqrt(float(((x - centre) ** 2).sum(1).max()))))
            sums: dict[int, np.ndarray] = {}
            for (a, x, va, ca, ra), (b, y, vb, cb, rb) in _pairs(*sides):
                gap = math.sqrt(float(((ca - cb) ** 2).sum()))
                if a != b and gap - ra - rb > reach * (1 + 1e-9) + 1e-9 * (1 + gap):
                    continue
                w = weights(x, y, a == b)
                sums[a] = sums.get(a, 0.0) + w @ vb
                if a != b:
                    sums[b] = sums.get(b, 0.0) + w.T @ va
            return pa.table({"part": pa.array(list(sums), pa.int32()), "p": pa.array([packed(s) for s in sums.values()], pa.binary())})

        def total(table: pa.Table) -> pa.Table:
            z = sum(np.frombuffer(p.as_buffer(), np.float64) for p in table.column("p").combine_chunks())
            return pa.table({"part": table.column("part").slice(0, 1), "z": pa.array([packed(z)], pa.binary())})

        some = self.rows.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(cell, "part int, p binary")
        return some.groupBy("part").applyInArrow(total, "part int, z binary")


def _pairs(one: list, other: list) -> Iterator[tuple]:
    if other:
        yield from ((a, b) for a in one for b in other)
    else:
        yield from ((a, b) for i, a in enumerate(one) for b in one[i:])


def lay_out(blocks: Blocks, reach: float, extra: list[str], key: str = "gid") -> TileLayout:
    """Packs the blocks with the named columns, and lays out their features in cells of two strips of neighbouring numbers.

    There are four times as many cells as tasks where the blocks allow it; beyond that, strips grow up to
    `STRIP_BLOCKS` blocks. A block is written once for each cell of its strip.
    """
    spark = blocks.rows.sparkSession
    wanted = math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism))
    size = min(max(blocks.count // wanted, 1), STRIP_BLOCKS)
    count = -(-blocks.count // size)
    strip = lambda name: F.floor(F.col(name) / size).cast("int")
    near = tile_plan(blocks, reach).select(strip("b").alias("r"), strip("c").alias("c")).distinct()
    near = near.withColumn("cell", F.col("r").cast("bigint") * count + F.col("c"))
    members = cut_lineage(near.select("cell", F.lit(0).alias("side"), F.col("r").alias("strip")).unionByName(
        near.where("r < c").select("cell", F.lit(1).alias("side"), F.col("c").alias("strip"))), "members")
    cells = members.where("side = 0").count()
    parts = cut_lineage(pack_rows(blocks.rows.withColumnRenamed(key, "key"), "block", ["f", *extra]), "parts")
    rows = parts.select(strip("part").alias("strip"), "part", "n", "f").join(members, "strip")
    rows = bucketed(rows.select("cell", "side", "part", "n", "f"), "cell", buckets_for(rows, cells))
    return TileLayout(rows, members, parts, size, reach)


@dataclass(frozen=True)
class GraphLayout:
    """One row for every strip, bucketed by strip: the entries of its rows and of those within `hops` - 1 arcs of them.

    A strip that is sent the values within `hops` arcs can take that many products before values are exchanged again. Entries are
    in places of `seen`, the keys whose values the strip is sent: rows `first` on have the `columns` and values `m`. `own` are the
    strip's own keys, which `parts` (part, n, keys) lists as well, and `to` and `at` name the strips that need its values, and which of them.
    """

    rows: DataFrame
    parts: DataFrame
    hops: int

    def run(self, vectors: DataFrame, width: int, schedule: list[list[Callable]]) -> DataFrame:
        """(part, z): each list of the schedule is up to `hops` products, between which nothing is exchanged.

        A product is fn(product of the matrix, places of rows, a, b) -> values of the rows, where a are the values and b
        those of one product before. The first a are the vectors (part, v), the first b are 0.
        """
        state = self.rows.groupBy("strip").cogroup(vectors.groupBy("part")).applyInArrow(_announce(width), _SENT)
        for i, products in enumerate(schedule):
            last = i == len(schedule) - 1
            state = self.rows.groupBy("strip").cogroup(state.groupBy("strip")).applyInArrow(
                _advance(products, width, last), "part int, z binary" if last else _SENT)
        return state


_SENT = "strip int, keys binary, a binary, b binary"


def _messages(here: pa.Table, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """What a strip sends of its own values, one row for each strip that needs some."""
    to, bounds, at = (keys_of(here.column(c)[0], k) for c, k in (("to", np.int32), ("bounds", np.int64), ("at", np.int64)))
    places = [at[x:y] for x, y in zip(bounds, bounds[1:])]
    return pa.table({
        "strip": pa.array(to, pa.int32()), "keys": pa.array([packed(keys[p], np.int64) for p in places], pa.binary()),
        "a": pa.array([packed(a[p]) for p in places], pa.binary()), "b": pa.array([packed(b[p]) for p in places], pa.binary())})


def _announce(width: int) -> Callable:
    def announce(here: pa.Table, there: pa.Table) -> pa.Table:
        keys = keys_of(here.column("own")[0])
        v = unpacked(there.column("v")[0], len(keys))
        return _messages(here, keys, v, np.zeros_like(v))

    return announce


def _advance(products: list[Callable], width: int, last: bool) -> Callable:
    def advance(here: pa.Table, there: pa.Table) -> pa.Table:
        seen, own, rows, first, columns = (keys_of(here.column(c)[0]) for c in ("seen", "own", "rows", "first", "columns"))
        m = keys_of(here.column("m")[0], np.float64)[:, None]
        a, b = np.zeros((len(seen), width)), np.zeros((len(seen), width))
        for i in range(there.num_rows):
            keys = keys_of(there.column("keys")[i])
            at = np.searchsorted(seen, keys)
            a[at], b[at] = unpacked(there.column("a")[i], len(keys)), unpacked(there.column("b")[i], len(keys))
        for fn in products:  # values of rows ever nearer to the strip's own stay right
            new = a.copy()
            new[rows] = fn(lambda v: np.add.reduceat(m * v[columns], first, axis=0), rows, a, b)
            a, b = new, a
        at = np.searchsorted(seen, own)
        if last:
            return pa.table({"part": here.column("strip"), "z": pa.array([packed(a[at])], pa.binary())})
        return _messages(here, own, a[at], b[at])

    return advance


def lay_out_graph(entries: DataFrame, homes: DataFrame, n: int, strips: int, most_hops: int = MAX_HOPS) -> GraphLayout:
    """Entries (i, j, m) of a symmetric matrix of n rows that holds every (i, i), laid out by the strips of homes (key, strip).

    Strips take in the rows a further arc away as long as all together hold at most `HALO` times their own rows.
    """
    own = cut_lineage(homes.select("strip", "key"), "halo")
    arcs = entries.select(F.col("i").alias("key"), "j")
    wider = lambda reached: cut_lineage(reached.join(arcs, "key").select("strip", F.col("j").alias("key")).distinct(), "halo")
    held, seen, hops = own, wider(own), 1
    while hops < most_hops:
        next_ = wider(seen)
        if next_.count() > HALO * n:
            break
        held, seen, hops = seen, next_, hops + 1
    rows = held.join(entries.withColumnRenamed("i", "key"), "key").select("strip", F.col("key").alias("i"), "j", "m")
    need = seen.join(own.select("key", F.col("strip").alias("home")), "key")  # strip needs a key of home

    def pack(here: pa.Table, there: pa.Table) -> pa.Table:
        i, j, m = (here.column(c).to_numpy() for c in "ijm")
        order = np.lexsort((j, i))
        i, j, m = i[order], j[order], m[order]
        first = np.concatenate([[0], np.nonzero(np.diff(i))[0] + 1])
        seen_keys = np.unique(j)
        keys, to = there.column("key").to_numpy(), there.column("strip").to_numpy()
        own_keys = np.unique(keys)
        order = np.lexsort((keys, to))
        targets, start = np.unique(to[order], return_index=True)
        find = np.searchsorted
        return pa.table({
            "strip": here.column("strip").slice(0, 1), "seen": [packed(seen_keys, np.int64)], "own": [packed(own_keys, np.int64)],
            "rows": [packed(find(seen_keys, i[first]), np.int64)], "first": [packed(first, np.int64)], "columns": [packed(find(seen_keys, j), np.int64)],
            "m": [packed(m)], "to": [packed(targets, np.int32)], "bounds": [packed(np.append(start, len(to)), np.int64)],
            "at": [packed(find(own_keys, keys[order]), np.int64)]}, schema=schema)

    names = ["seen", "own", "rows", "first", "columns", "m", "to", "bounds", "at"]
    schema = pa.schema([("strip", pa.int32()), *((c, pa.binary()) for c in names)])
    laid = rows.groupBy("strip").cogroup(need.groupBy("home")).applyInArrow(pack, "strip int, " + ", ".join(f"{c} binary" for c in names))
    laid = bucketed(laid, "strip", buckets_for(entries, strips))
    return GraphLayout(laid, laid.select(F.col("strip").alias("part"), (F.octet_length("own") / 8).cast("int").alias("n"), F.col("own").alias("keys")), hops)
