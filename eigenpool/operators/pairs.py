"""Pairwise operators: distances, Gaussian affinity, neighbours, nearest centre, comparison."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eigenpool.functions.vectors import width
from eigenpool.operators.boxes import BoxLayout, lay_out_boxes
from eigenpool.operators.entries import TiledEntries
from eigenpool.operators.joins import first_per_group, join_groups
from eigenpool.operators.layout import map_parts, unpack_rows
from eigenpool.operators.neighbours import nearest_by_parts
from eigenpool.operators.tiles import (
    BLOCK_ROWS, DIRECT_WIDTH, Blocks, Copies, Side, build_blocks, direct_sq_distances, fold_copies, run_cells, run_tiles,
    sq_distances,
)
from eigenpool.session import cut_lineage

EPS = float(np.finfo(float).eps)
NARROW_WIDTH, NARROW_BLOCK_ROWS = 8, 512
#: Pairs that a task lists at a time.
PAIRS_AT_ONCE = 1 << 17


def neighbour_block_rows(points: DataFrame, n: int) -> int:
    """Few features prune well, so small blocks save work; many do not, so large ones save copies."""
    return NARROW_BLOCK_ROWS if n > BLOCK_ROWS and width(points) <= NARROW_WIDTH else BLOCK_ROWS


def block_pairs(blocks: Blocks, radius: float = math.inf, alike: bool = True) -> DataFrame:
    """(i, j, d2) for pairs of rows no farther apart than radius; `alike` keeps pairs of two blocks whose ids are the same."""
    limit = radius * radius

    def gaps(x, y):
        i, j = np.divmod(np.arange(len(x) * len(y)), len(y))
        return i, j, direct_sq_distances(x, y).ravel()

    def near(x, y):
        i, j = np.nonzero(sq_distances(x, y) <= limit + 1e-9 * (1.0 + limit))
        exact = ((x[i] - y[j]) ** 2).sum(axis=1)
        keep = exact <= limit
        return i[keep], j[keep], exact[keep]

    listed = near if math.isfinite(limit) else gaps

    def work(tiles):
        for b, c, left, right in tiles:
            step = max(1, PAIRS_AT_ONCE // len(right))
            for s in range(0, len(left), step):
                i, j, d2 = listed(left.x[s:s + step], right.x)
                ai, bj = left["id"][s:s + step][i], right["id"][j]
                if b == c or not alike:
                    keep = ai < bj if b == c else ai != bj
                    ai, bj, d2 = ai[keep], bj[keep], d2[keep]
                yield pa.table({"i": np.minimum(ai, bj), "j": np.maximum(ai, bj), "d2": d2})

    return run_cells(blocks, work, "i bigint, j bigint, d2 double", radius)


def pair_distances(points: DataFrame, radius: float = math.inf, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(i, j, d2) for unordered pairs i < j no farther apart than radius; without a radius for all of them.

    The result is the pair list itself. With a radius, blocks out of reach are never paired. Without one, pairs with a row
    that misses a feature are listed too, with a null distance. Pairs are handed on strip by strip, so a task holds a
    bounded number of them.
    """
    whole = F.coalesce(~F.exists("f", lambda v: v.isNull() | F.isnan(v)), F.lit(False))
    known = points.select("id", "f", whole.alias("whole")).where(F.col("id").isNotNull())
    full = known.where("whole").drop("whole")
    found = block_pairs(build_blocks(full, full.count(), key="id", block_rows=block_rows), radius, alike=False)
    if math.isfinite(radius * radius) or known.where("not whole").isEmpty():
        return found
    one, two = known.where("not whole").select(F.col("id").alias("a")), known.select(F.col("id").alias("b"), "whole")
    once = one.join(two, (F.col("a") < F.col("b")) | (F.col("whole") & (F.col("b") < F.col("a"))))
    return found.unionByName(once.select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"), F.lit(None).cast("double").alias("d2")))


def distance_summary(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row over all other rows: (id, n, total, least, most) of the squared distance.

    Every pair is computed, none is shuffled: a tile hands back one line per row.
    """
    blocks = build_blocks(points.select("id", "f"), points.count(), key="id", block_rows=block_rows)

    def half(d2, ids, drop):
        if drop:
            far = d2.copy()
            np.fill_diagonal(d2, 0.0)
            np.fill_diagonal(far, np.inf)
        else:
            far = d2
        n = np.full(len(ids), d2.shape[1] - int(drop))
        return ids, n, d2.sum(1), far.min(1), d2.max(1)

    def tile(a, b, same):
        d2 = sq_distances(a.x, b.x)
        parts = [half(d2, a["id"], same)] + ([] if same else [half(d2.T, b["id"], False)])
        cols = [np.concatenate(c) for c in zip(*parts)]
        return dict(zip(["id", "n", "total", "least", "most"], cols))

    parts = run_tiles(
        blocks, tile, "id bigint, n bigint, total double, least double, most double",
        total={"n": "sum", "total": "sum", "least": "min", "most": "max"},
    )
    return parts.groupBy("id").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )


def affinity_reach(sigma: float, n_rows: int, floor: float | None = None) -> float:
    """Distance beyond which a weight no longer counts.

    Without a floor: weights below eps/n; a degree is at least 1 (the diagonal), so
    leaving out all of them changes no degree by more than one rounding step.
    """
    least = floor if floor is not None else EPS / max(n_rows, 1)
    return sigma * math.sqrt(-2.0 * math.log(least)) if 0 < least < 1 else math.inf


def kernel(d2: np.ndarray, sigma: float, same: bool) -> np.ndarray:
    """Gaussian weights of a tile; the diagonal is 1 by definition."""
    w = np.exp(d2 / (-2.0 * sigma * sigma))
    if same:
        np.fill_diagonal(w, 1.0)
    return w


def _box_rows(boxes: BoxLayout, sums: dict[str, DataFrame]) -> DataFrame:
    """(gid, <sums>) of packed results (part, z), one value a row."""
    parts = boxes.parts.select("part", "n", "keys")
    for name, z in sums.items():
        parts = parts.join(z.withColumnRenamed("z", name), "part")
    return unpack_rows(parts, list(sums)).select(F.col("key").alias("gid"), *[F.col(c)[0].alias(c) for c in sums])


def _box_summary(boxes: BoxLayout) -> DataFrame:
    """`normalized_summary` of rows in boxes."""
    packed_m = boxes.parts.select("part", F.col("m").alias("v"))
    rows = cut_lineage(boxes.parts.select("part", "n", "m").join(boxes.product(packed_m).withColumnRenamed("z", "d"), "part"), "degrees")
    floored = lambda d: np.maximum(d, 1e-9)
    scaled = map_parts(rows, {
        "degree": (["d"], floored), "root": (["d"], lambda d: 1 / np.sqrt(floored(d))), "inverse": (["d"], lambda d: 1 / floored(d)),
        "by_root": (["m", "d"], lambda m, d: m / np.sqrt(floored(d))), "by_degree": (["m", "d"], lambda m, d: m / floored(d))}).drop("n")
    scaled = cut_lineage(scaled, "scaled")
    sent = lambda name: scaled.select("part", F.col(name).alias("v"))
    sums = {
        "degree": scaled.select("part", F.col("degree").alias("z")), "root": scaled.select("part", F.col("root").alias("z")),
        "total": boxes.product(sent("by_root")), "squares": boxes.product(sent("by_degree"), 2)}
    out = _box_rows(boxes, sums)
    return out.select(
        "gid", (F.col("total") * F.col("root")).alias("total"), (F.col("squares") / F.col("degree")).alias("squares"),
        "degree", (1.0 / F.col("degree")).alias("diagonal"))


def affinity_summary(copies: Copies, sigma: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per folded row of the full affinity matrix W: (gid, degree, squares).

    degree = sum of the row of W (copies counted), squares = sum of its squares. Blocks too
    far apart to add more than rounding error are not paired; narrow rows are summed by boxes.
    """
    boxes = lay_out_boxes(copies, sigma, affinity_reach(sigma, copies.n_rows), ["m"], most_power=2)
    if boxes is not None:
        ones = boxes.parts.select("part", F.col("m").alias("v"))
        sums = _box_rows(boxes, {"degree": boxes.product(ones), "squares": boxes.product(ones, 2)})
        return sums.select("gid", F.greatest("degree", F.lit(1e-9)).alias("degree"), "squares")
    blocks = build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups, block_rows=block_rows)

    def tile(a, b, same):
        w = kernel(sq_distances(a.x, b.x), sigma, same)
        parts = [(a["gid"], w @ b["m"], (w * w) @ b["m"])]
        if not same:
            parts.append((b["gid"], w.T @ a["m"], (w * w).T @ a["m"]))
        return dict(zip(["gid", "degree", "squares"], [np.concatenate(c) for c in zip(*parts)]))

    parts = run_tiles(
        blocks, tile, "gid bigint, degree double, squares double", affinity_reach(sigma, copies.n_rows),
        total={"degree": "sum", "squares": "sum"})
    return parts.groupBy("gid").agg(
        F.greatest(F.sum("degree"), F.lit(1e-9)).alias("degree"), F.sum("squares").alias("squares"))


def affinity_degrees(copies: Copies, sigma: float, blocks: Blocks | None = None) -> DataFrame:
    """(gid, degree) of W, floored at 1e-9; tiles too far to matter are skipped."""
    if blocks is None:
        blocks = build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups)

    def tile(a, b, same):
        w = kernel(sq_distances(a.x, b.x), sigma, same)
        ids, sums = [a["gid"]], [w @ b["m"]]
        if not same:
            ids.append(b["gid"])
            sums.append(w.T @ a["m"])
        return {"gid": np.concatenate(ids), "s": np.concatenate(sums)}

    parts = run_tiles(blocks, tile, "gid bigint, s double", affinity_reach(sigma, copies.n_rows), total={"s": "sum"})
    return parts.groupBy("gid").agg(F.greatest(F.sum("s"), F.lit(1e-9)).alias("degree"))


def normalized_summary(copies: Copies, sigma: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per folded row of M = D^-1/2 W D^-1/2: (gid, degree, diagonal, total, squares)."""
    boxes = lay_out_boxes(copies, sigma, affinity_reach(sigma, copies.n_rows), ["m"], most_power=2)
    if boxes is not None:
        return _box_summary(boxes)
    blocks = build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups, block_rows=block_rows)
    degrees = affinity_degrees(copies, sigma, blocks)
    scaled = replace(blocks, rows=blocks.rows.join(degrees, "gid"))

    def tile(a, b, same):
        w = kernel(sq_distances(a.x, b.x), sigma, same)
        w = w / np.sqrt(a["degree"])[:, None] / np.sqrt(b["degree"])[None, :]
        parts = [(a["gid"], w @ b["m"], (w * w) @ b["m"])]
        if not same:
            parts.append((b["gid"], w.T @ a["m"], (w * w).T @ a["m"]))
        return dict(zip(["gid", "total", "squares"], [np.concatenate(c) for c in zip(*parts)]))

    parts = run_tiles(
        scaled, tile, "gid bigint, total double, squares double", affinity_reach(sigma, copies.n_rows),
        total={"total": "sum", "squares": "sum"})
    sums = parts.groupBy("gid").agg(F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    return sums.join(degrees, "gid").withColumn("diagonal", 1.0 / F.col("degree"))


def affinity_entries(
    copies: Copies, sigma: float, floor: float, block_rows: int | None = None
) -> TiledEntries:
    """Entries (i, j, w, mi, mj) of W with w >= floor, both triangles and the diagonal.

    Indices are folded rows and mi, mj their copies, so a hot group of copies is one
    index and not a square of pairs. Every entry left out is below the floor.
    """
    if not 0 < floor <= 1:
        raise ValueError("the floor must be in (0, 1]")
    block_rows = block_rows or neighbour_block_rows(copies.groups, copies.n_groups)
    blocks = build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups, block_rows=block_rows)
    return TiledEntries(
        blocks, lambda d2: np.exp(d2 / (-2.0 * sigma * sigma)), floor, affinity_reach(sigma, copies.n_rows, floor), origin=blocks)


class _Nearest:
    """The k nearest candidates by (distance, id) of each row of a block, among the blocks it was shown."""

    def __init__(self, side: Side, k: int):
        self.side, self.k, n = side, k, len(side)
        bound = side.cols.get("bound", np.full(n, np.inf))
        self.cut = bound * bound * (1 + 1e-14)
        self.found: list[tuple] = []
        self.size = 0
        self.slack = 1e-12 * (1.0 + (side.x * side.x).sum(1).max()) if side.x.shape[1] > DIRECT_WIDTH else 0.0

    def show(self, other: _Nearest, d2: np.ndarray, axis: int) -> None:
        """d2 are the squared distances to the other block, with this block's rows along the axis."""
        cut = self.cut
        if not np.isfinite(cut).all() and d2.shape[1 - axis] > self.k:
            cut = np.minimum(cut, np.partition(d2, self.k - 1, axis=1 - axis).take(self.k - 1, axis=1 - axis))
        cut = cut + self.slack + other.slack
        i, j = np.nonzero(d2 <= (cut[:, None] if axis == 0 else cut[None, :]))
        if axis:
            i, j = j, i
        d = np.sqrt(((self.side.x[i] - other.side.x[j]) ** 2).sum(axis=1))
        ids, first, copies = other.listed
        times = copies[j]
        at = np.repeat(first[j], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        self.found.append((np.repeat(i, times), ids[at], np.repeat(other.side["gid"][j], times), np.repeat(d, times)))
        self.size += len(at)
        if self.size > 4 * self.k * len(self.side):
            self.trim()

    @cached_property
    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the block's copies, where those of a row begin, and how many there are."""
        ids = self.side["ids"]
        copies = np.diff(ids.offsets.to_numpy())
        return ids.flatten().to_numpy(), np.cumsum(copies) - copies, copies

    def trim(self) -> None:
        i, ids, nids, d = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((ids, d, i))
        i = i[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        order, i, rank = order[rank < self.k], i[rank < self.k], rank[rank < self.k]
        self.found, self.size = [(i, ids[order], nids[order], d[order])], len(i)
        last = rank == self.k - 1
        self.cut[i[last]] = np.minimum(self.cut[i[last]], d[order][last] ** 2 * (1 + 1e-14))

    def table(self) -> pa.Table:
        self.trim()
        i, ids, nids, d = self.found[0]
        return pa.table({"gid": self.side["gid"][i], "id": ids, "nid": nids, "d": d})


def knn_groups(copies: Copies, points: DataFrame, k: int, block_rows: int | None = None) -> DataFrame:
    """Exact Euclidean neighbours of every folded row: (gid, rank, id, nid, d), rank 1..k.

    `id` is the neighbour's row, `nid` its folded row; ties go to the smaller id, and a
    row is its own first neighbour unless k smaller ids are copies of it. Of a group of
    copies only the k smallest ids can ever be among k nearest by (distance, id), so no
    more are kept. Narrow rows are cut into parts by a tree. Others lie in blocks: each first
    looks inside itself, which bounds how far its rows' neighbours can be; only blocks within
    that bound are then paired.
    """
    if copies.top == 1:
        groups = copies.groups.withColumn("ids", F.array("gid"))
    else:
        many = copies.groups.where(F.col("m") > 1)
        least = (
            first_per_group(join_groups(points.select("id", "f"), many.select("f", "m"), ["f"], "m").select("id", "f"), ["f"], ["id"], k)
            .groupBy("f").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        )
        once = copies.groups.where((F.col("m") == 1) & F.col("f").isNotNull())
        groups = once.withColumn("ids", F.array_compact(F.array("gid"))).unionByName(many.join(least, "f").select(*copies.groups.columns, "ids"))
    base = groups.select("gid", F.col("f").alias("f", metadata=copies.groups.schema["f"].metadata), "ids")
    narrow = nearest_by_parts(base, copies.groups, copies.n_groups, k, block_rows)
    if narrow is not None:
        return narrow
    blocks = build_blocks(base, copies.n_groups, block_rows=block_rows or neighbour_block_rows(points, copies.n_groups))

    def work(tiles):
        seen: dict[int, _Nearest] = {}
        for b, c, left, right in tiles:
            for block, side in ((b, left), (c, right)):
                if block not in seen:
                    seen[block] = _Nearest(side, k)
            one, other = seen[b], seen[c]
            d2 = sq_distances(left.x, right.x)
            one.show(other, d2, 0)
            if b != c:
                other.show(one, d2, 1)
        yield from (near.table() for near in seen.values())

    schema = "gid bigint, id bigint, nid bigint, d double"
    found = run_cells(blocks, work, schema, across=False)
    if blocks.count > 1:
        found = cut_lineage(found, "inside")
        bounds = (
            found.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far"))
            .select("gid", F.when(F.col("n") >= k, F.col("far")).otherwise(F.lit(float("inf"))).alias("bound"))
        )
        bounded = replace(blocks, rows=cut_lineage(blocks.rows.join(bounds, "gid"), "bounded"))
        reach = np.full(blocks.count, np.inf)
        for row in bounded.rows.groupBy("block").agg(F.max("bound").alias("bound")).collect():
            reach[row["block"]] = row["bound"]
        found = found.unionByName(run_cells(bounded, work, schema, reach, inside=False))
    w = Window.partitionBy("gid").orderBy("d", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_join(points: DataFrame, k: int, include_self: bool = False, block_rows: int | None = None) -> DataFrame:
    """(id, rank, nid, d): the k nearest rows of every row, ties to the smaller id.

    The list of a group of copies is computed once and handed to each copy, which
    then leaves itself out (or drops the last entry when it is not on the list).
    """
    copies = fold_copies(points)
    k = min(k, copies.n_rows - (0 if include_self else 1))
    depth = k if include_self else k + 1
    lists = (
        knn_groups(copies, points, depth, block_rows)
        .groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("near"))
    )
    shared = copies.groups.select("gid", "f", "m").join(lists, "gid").drop("gid")
    rows = join_groups(points.select("id", "f"), shared, ["f"], "m").select("id", "near")
    if not include_self:
        others = F.filter("near", lambda n: n["id"] != F.col("id"))
        rows = rows.withColumn("near", F.slice(others, 1, k))
    return rows.select("id", F.posexplode("near").alias("pos", "n")).select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("n.id").alias("nid"), F.col("n.d").alias("d")
    )


def nearest_center(points: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Adds (cluster, d2): the closest centre, ties to the lower number."""
    columns = points.columns
    found = T.StructType([*points.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("d2", T.DoubleType())])
    centres = np.array([[float(v) for v in c] for c in centers])

    def closest(batches):
        for batch in batches:
            f = batch.column(columns.index("f"))
            x = np.asarray(f.flatten()).reshape(len(f), -1) if len(f) else np.zeros((0, centres.shape[1]))
            best, least = np.zeros(len(x), dtype=np.int32), np.full(len(x), np.inf)
            for i, c in enumerate(centres):
                d2 = ((x - c) ** 2).sum(axis=1)
                nearer = d2 < least
                best[nearer], least[nearer] = i, d2[nearer]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best), pa.array(least)], names=found.names)

    return points.mapInArrow(closest, found)


def compare_tables(
    a: DataFrame | TiledEntries, b: DataFrame | TiledEntries, keys: Sequence[str], value: str, atol: float = 1e-8, rtol: float = 1e-5
) -> DataFrame:
    """One row: (n, all_close, frobenius, identical) of two value tables with equal keys.

    A key that only one side has makes the tables differ; in the norm it counts as 0 there.
    Matrices whose entries arise in the same tiles are compared there, without a join.
    """
    if isinstance(a, TiledEntries) and list(keys) == ["i", "j"] and a.alongside(b):
        return a.gaps(b, value, atol, rtol).agg(
            F.sum("n").alias("n"), (F.min("close") == 1).alias("all_close"), F.sqrt(F.sum("squares")).alias("frobenius"),
        ).withColumn("identical", F.coalesce(F.col("frobenius") < 1e-10, F.lit(False)))
    left = a.select(*keys, F.col(value).alias("va"))
    right = b.select(*keys, F.col(value).alias("vb"))
    both = left.join(right, list(keys), "full_outer")
    gap = F.coalesce("va", F.lit(0.0)) - F.coalesce("vb", F.lit(0.0))
    close = F.abs(F.col("va") - F.col("vb")) <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("vb"))
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.coalesce(close, F.lit(False))).alias("all_close"),
        F.sqrt(F.sum(gap * gap)).alias("frobenius"),
    ).withColumn("identical", F.coalesce(F.col("frobenius") < 1e-10, F.lit(False)))
