"""Nearest neighbours of narrow rows by a tree of cuts, in time that grows with the rows.

Space is cut into parts of about equally many rows. A part, one group of a Spark task, finds the neighbours of its rows among
themselves; what they are away bounds how far any others can be, so only rows near the edge of their part are sent to the
parts within that bound. The cuts come from a bounded hash sample; every row is in a part and every neighbour is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eigenpool.functions.vectors import width
from eigenpool.operators.tiles import list_matrix, sq_distances
from eigenpool.session import cut_lineage

#: With more features most rows of a part are near its edge.
MAX_WIDTH = 3
#: Rows of a part, and rows inside it that are compared by one call: so many, or so many times the neighbours wanted.
PART_ROWS = 1 << 14
LEAF_ROWS, LEAF_DEPTHS = 48, 4
SAMPLE_PER_PART, MAX_SAMPLE = 64, 200_000
#: Room for rounding: distances that are equal, and boxes that touch.
TIE, TOUCH = 1 + 1e-14, 1 + 1e-12


def halves(x: np.ndarray) -> tuple[int, float] | None:
    """(feature, value): about half of the rows are at most there, at least one is above; None if all are equal."""
    span = x.max(0) - x.min(0)
    axis = int(span.argmax())
    if not span[axis] > 0:
        return None
    v = x[:, axis]
    cut = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
    if cut == v.max():
        cut = v[v < cut].max()
    return axis, float(cut)


@dataclass(frozen=True)
class Cuts:
    """Rows of box b go on to box first[b], or the next one if their feature axis[b] is above at[b]; 0 ends in a part."""

    axis: np.ndarray
    at: np.ndarray
    first: np.ndarray

    def part_of(self, x: np.ndarray) -> np.ndarray:
        box = np.zeros(len(x), dtype=np.int32)
        open_ = np.arange(len(x)) if self.first[0] else np.zeros(0, dtype=int)
        while len(open_):
            b = box[open_]
            box[open_] = self.first[b] + (x[open_, self.axis[b]] > self.at[b])
            open_ = open_[self.first[box[open_]] > 0]
        return box


def draw_cuts(sample: np.ndarray, most: float) -> Cuts:
    """Cuts boxes in half until none has more of the sample than `most`."""
    axis, at, first = [0], [0.0], [0]
    todo = [(0, sample)]
    while todo:
        box, rows = todo.pop()
        split = halves(rows) if len(rows) > max(most, 1) else None
        if split is None:
            continue
        axis[box], at[box], first[box] = *split, len(axis)
        low = rows[:, split[0]] <= split[1]
        todo += [(len(axis), rows[low]), (len(axis) + 1, rows[~low])]
        axis, at, first = axis + [0, 0], at + [0.0, 0.0], first + [0, 0]
    return Cuts(np.array(axis), np.array(at), np.array(first, dtype=np.int32))


def leaves_of(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers, cut in half until no piece has more than `most`."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        split = halves(x[rows]) if len(rows) > most else None
        if split is None:
            out.append(rows)
            continue
        low = x[rows, split[0]] <= split[1]
        todo += [rows[~low], rows[low]]
    return out


def box_gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances between a box and others, or between rows and a box."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0.0)
    return (gap * gap).sum(1)


class _Part:
    """The rows of a part in small leaves, and what is nearest to rows near them."""

    def __init__(self, rows: pa.Table, k: int):
        x = list_matrix(rows.column("f"))
        self.k, self.most = k, max(LEAF_ROWS, LEAF_DEPTHS * k)
        leaves = leaves_of(x, self.most)
        order = np.concatenate(leaves)
        rows = rows.take(pa.array(order)).combine_chunks()
        self.x, self.gid, ids = x[order], rows.column("gid").to_numpy(), rows.column("ids").combine_chunks()
        self.copies = np.diff(ids.offsets.to_numpy())
        self.ids, self.first_id = ids.flatten().to_numpy(), np.cumsum(self.copies) - self.copies
        self.size = np.array([len(leaf) for leaf in leaves])
        self.start = np.cumsum(self.size) - self.size
        self.low, self.high = np.minimum.reduceat(self.x, self.start), np.maximum.reduceat(self.x, self.start)

    def _rows(self, leaves: np.ndarray) -> np.ndarray:
        size = self.size[leaves]
        return np.arange(size.sum()) + np.repeat(self.start[leaves] - np.cumsum(size) + size, size)

    def _candidates(self, q: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, j): of a few rows close together, which of the part's rows may be among the k nearest within the cut."""
        gaps = box_gaps(q.min(0), q.max(0), self.low, self.high)
        if not np.isfinite(cut).all():
            closest = np.argsort(gaps, kind="stable")
            closest = closest[:np.searchsorted(np.cumsum(self.size[closest]), self.k) + 1]
            cut = self._kth(sq_distances(q, self.x[self._rows(closest)]), cut)
        at = self._rows(np.nonzero(gaps <= cut.max() * TOUCH)[0])
        d2 = sq_distances(q, self.x[at])
        i, j = np.nonzero(d2 <= self._kth(d2, cut)[:, None])
        return i, at[j]

    def _kth(self, d2: np.ndarray, cut: np.ndarray) -> np.ndarray:
        if d2.shape[1] < self.k:
            return cut
        return np.minimum(cut, np.partition(d2, self.k - 1, axis=1)[:, self.k - 1] * TIE)

    def nearest(self, q: np.ndarray, groups: list[np.ndarray], cut: np.ndarray) -> tuple[np.ndarray, ...]:
        """(i, id, nid, d) of the k nearest copies by (d, id) of each row of q within its cut, in that order."""
        found = [(rows[i], j) for rows in groups for i, j in [self._candidates(q[rows], cut[rows])]]
        i, j = (np.concatenate(side) for side in zip(*found))
        d = np.sqrt(((q[i] - self.x[j]) ** 2).sum(axis=1))
        times = self.copies[j]
        at = np.arange(times.sum()) + np.repeat(self.first_id[j] - np.cumsum(times) + times, times)
        i, ids, nid, d = np.repeat(i, times), self.ids[at], np.repeat(self.gid[j], times), np.repeat(d, times)
        order = np.lexsort((ids, d, i))
        i = i[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < self.k
        order = order[keep]
        return i[keep], ids[order], nid[order], d[order]


def _lists(sizes: np.ndarray, values: pa.Array, empty_is_null: bool = False) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    mask = pa.array(sizes == 0) if empty_is_null else None
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


def nearest_by_parts(rows: DataFrame, sample_from: DataFrame, n: int, k: int, part_rows: int | None = None) -> DataFrame | None:
    """(gid, rank, id, nid, d) of rows (gid, f, ids) with distinct features, as `knn_groups` has it; None if they aren't narrow.

    Rows with a missing feature or id have no place in a part and are left to the tiles, as are all rows beside them.
    """
    d = width(rows)
    if d > MAX_WIDTH or k < 1:
        return None
    odd = [F.col("f")[j].isNull() | F.isnan(F.col("f")[j]) | (F.abs(F.col("f")[j]) > 1e150) for j in range(d)]
    if not sample_from.where(F.array_contains(F.array(*odd, F.col("gid").isNull()), True)).isEmpty():
        return None
    spark = rows.sparkSession
    parts_wanted = math.ceil(n / (part_rows or PART_ROWS))
    drawn = min(parts_wanted * SAMPLE_PER_PART, MAX_SAMPLE)
    sample = sample_from.select("f", F.xxhash64("gid").alias("h"), "gid").orderBy("h", "gid").limit(drawn).select("f").collect()
    cuts = draw_cuts(np.array([r["f"] for r in sample], dtype=float), len(sample) / parts_wanted)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                part = cuts.part_of(list_matrix(batch.column("f")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], ["gid", "f", "ids", "part"])

    placed = cut_lineage(rows.select("gid", "f", "ids").mapInArrow(place, "gid bigint, f array<double>, ids array<bigint>, part int"), "parts")
    ends = [f(F.col("f")[j]).alias(f"{name}{j}") for name, f in (("a", F.min), ("b", F.max)) for j in range(d)]
    boxes = placed.groupBy("part").agg(*ends).orderBy("part").collect()
    numbers = np.array([r["part"] for r in boxes], dtype=np.int32)
    lows, highs = (np.array([[r[f"{name}{j}"] for j in range(d)] for r in boxes]) for name in "ab")
    tasks = min(len(numbers), max(4 * spark.sparkContext.defaultParallelism, len(numbers) // 4))

    def inside(table: pa.Table) -> pa.Table:
        own = int(np.searchsorted(numbers, table.column("part")[0].as_py()))
        part = _Part(table, k)
        m = len(part.x)
        i, ids, nid, dist = part.nearest(part.x, np.split(np.arange(m), part.start[1:]), np.full(m, np.inf))
        counts = np.bincount(i, minlength=m)
        far = np.where(counts == k, dist[np.cumsum(counts) - 1], np.inf)
        cut = far * far * TIE
        row, to = [np.zeros(0, dtype=int)], [np.zeros(0, dtype=np.int32)]
        for other in np.nonzero(box_gaps(lows[own], highs[own], lows, highs) <= cut.max() * TOUCH)[0]:
            if other != own:
                hit = np.nonzero(box_gaps(part.x, part.x, lows[other], highs[other]) <= cut * TOUCH)[0]
                row.append(hit)
                to.append(np.full(len(hit), numbers[other]))
        row, to = np.concatenate(row), np.concatenate(to)
        sent = np.bincount(row, minlength=m)
        near = pa.StructArray.from_arrays([pa.array(ids), pa.array(nid), pa.array(dist)], ["id", "nid", "d"])
        open_ = sent > 0
        return pa.table({
            "gid": part.gid, "far": far, "f": _lists(d * open_, pa.array(part.x[open_].ravel()), True),
            "sent": _lists(sent, pa.array(to[np.argsort(row, kind="stable")]), True), "near": _lists(counts, near)})

    near = "near array<struct<id: bigint, nid: bigint, d: double>>"
    first = cut_lineage(
        placed.repartition(tasks, "part").groupBy("part").applyInArrow(inside, f"gid bigint, far double, f array<double>, sent array<int>, {near}"),
        "inside")
    listed = lambda df: df.select("gid", F.posexplode("near").alias("pos", "n")).select(
        "gid", (F.col("pos") + 1).alias("rank"), "n.id", "n.nid", "n.d")
    # Groups that share their least id share one list, so none of them is done with its part.
    unique = sample_from.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if len(numbers) == 1 and unique:
        return listed(first)
    edge = first.where(F.col("sent").isNotNull())

    def across(data: pa.Table, asked: pa.Table) -> pa.Table:
        if not data.num_rows or not asked.num_rows:
            return pa.table({"gid": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "nid": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        part, q = _Part(data, k), list_matrix(asked.column("f"))
        far = asked.column("far").to_numpy()
        i, ids, nid, dist = part.nearest(q, leaves_of(q, part.most), far * far * TIE)
        return pa.table({"gid": asked.column("gid").to_numpy()[i], "id": ids, "nid": nid, "d": dist})

    asked = edge.select("gid", "far", "f", F.explode("sent").alias("part")).repartition(tasks, "part")
    found = placed.repartition(tasks, "part").groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(
        across, "gid bigint, id bigint, nid bigint, d double")
    w = Window.partitionBy("gid").orderBy("d", "id")
    merged = lambda own: listed(own).drop("rank").unionByName(found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return listed(first.where(F.col("sent").isNull())).unionByName(merged(edge)) if unique else merged(first)
