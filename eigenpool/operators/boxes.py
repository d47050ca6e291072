"""Gaussian sums over all pairs of narrow rows, in time that grows with the rows.

Rows lie in boxes of a grid about two sigma wide. Within a box a Gaussian is, to rounding error, a polynomial of small
degree, so what a box adds to another one follows from its sums of Chebyshev polynomials, a matrix of fixed size. No weight
is left out but those below rounding error; pairs of rows are never formed. Rows too wide or too far spread for that,
where boxes would hold fewer rows than polynomials, are left to the tiles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.vectors import width
from eigenpool.operators.layout import pack_rows, packed, unpacked
from eigenpool.operators.tiles import BLOCK_ROWS, Copies
from eigenpool.session import cut_lineage

#: Side of a box in units of sigma, and the error allowed in a weight.
SIDE, PRECISION = 2.0, 1e-17
MAX_WIDTH = 3
#: Sums exchanged between boxes may be this many times the rows, and boxes this many.
MOST_SENT, MAX_BOXES = 4, 10_000
#: A task adds up at most so many bytes of box sums before it hands them on.
HELD_BYTES = 64 << 20


def degree_for(side: float) -> int:
    """Polynomials for a Gaussian over a box of this side in units of sigma, by the bound of its derivatives."""
    p = 4
    while 2 * p * (side / 4) ** p / math.sqrt(math.factorial(p)) > PRECISION:
        p += 1
    return p


def chebyshev(x: np.ndarray, p: int) -> np.ndarray:
    """T_0 .. T_{p-1} at x in [-1, 1], one line per place."""
    out = np.ones((len(x), p), dtype=x.dtype)
    out[:, 1] = x
    for k in range(2, p):
        out[:, k] = 2 * x * out[:, k - 1] - out[:, k - 2]
    return out


def coefficients(gap: float, side: float, sigma: float, p: int) -> np.ndarray:
    """C with exp(-(x - y)^2 / 2 sigma^2) = T(x) C T(y)^T for x, y in boxes whose centres are `gap` apart."""
    angles = np.arccos(np.longdouble(-1)) * (np.arange(p) + np.longdouble(0.5)) / p
    nodes = np.cos(angles)
    turn = np.cos(angles[:, None] * np.arange(p)) * np.where(np.arange(p) == 0, 1, 2) / p
    d = gap + np.longdouble(side) / 2 * (nodes[:, None] - nodes[None, :])
    return (turn.T @ np.exp(d * d / (-2 * np.longdouble(sigma) ** 2)) @ turn).astype(float)


def _sums(bases: list[np.ndarray], v: np.ndarray) -> np.ndarray:
    """Sums over rows of the products of their polynomials and values, as a matrix with a column per value."""
    w = v
    for basis in reversed(bases[1:]):
        w = (basis[:, :, None] * w[:, None, :]).reshape(len(w), -1)
    return (bases[0].T @ w).reshape(-1, v.shape[1])


def _values(bases: list[np.ndarray], local: np.ndarray) -> np.ndarray:
    """The polynomials with these coefficients at the rows."""
    p = bases[0].shape[1]
    w = (bases[0] @ local.reshape(p, -1)).reshape(len(bases[0]), -1)
    for basis in bases[1:]:
        w = np.matmul(basis[:, None, :], w.reshape(len(w), p, -1))[:, 0]
    return w


@dataclass(frozen=True)
class BoxLayout:
    """Packed rows parts(part, n, keys, f, ...) in boxes: `cells` are their grid places, `box_of` the box of each part."""

    parts: DataFrame
    cells: np.ndarray
    box_of: np.ndarray
    low: np.ndarray
    side: float
    sigma: float
    reach: float

    def product(self, vectors: DataFrame, power: int = 1) -> DataFrame:
        """(part, z): the weights, each raised to a power, times vectors (part, v)."""
        cells, box_of, low, side = self.cells, self.box_of, self.low, self.side
        sigma, reach, d = self.sigma / math.sqrt(power), self.reach, self.cells.shape[1]
        p = degree_for(side / sigma)

        def bases(part: int, x: np.ndarray) -> list[np.ndarray]:
            middle = low + (cells[box_of[part]] + 0.5) * side
            at = np.clip((x - middle) / (side / 2), -1.0, 1.0)
            return [chebyshev(at[:, j], p) for j in range(d)]

        def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            size = 0

            def flush():
                return pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.int32()), pa.array([packed(s) for s in held.values()], pa.binary())], ["box", "s"])

            for batch in batches:
                for i in range(batch.num_rows):
                    part, n = batch["part"][i].as_py(), batch["n"][i].as_py()
                    box = int(box_of[part])
                    some = _sums(bases(part, unpacked(batch["f"][i], n)), unpacked(batch["v"][i], n))
                    if box in held:
                        held[box] += some
                    else:
                        held[box] = some
                        size += some.nbytes
                    if size > HELD_BYTES:
                        yield flush()
                        held, size = {}, 0
            if held:
                yield flush()

        def across(table: pa.Table) -> pa.Table:
            box = table.column("box")[0].as_py()
            sums = sum(unpacked(s, p ** d) for s in table.column("s").combine_chunks())
            steps = np.abs(cells - cells[box])
            near = np.nonzero((np.maximum(steps - 1, 0) ** 2).sum(1) * side * side <= reach * reach)[0]
            known: dict[int, np.ndarray] = {}
            out = []
            for other in near:
                w = sums.reshape((p,) * d + (-1,))
                for j, step in enumerate(map(int, cells[other] - cells[box])):
                    if step not in known:
                        known[step] = coefficients(step * side, side, sigma, p)
                    w = np.moveaxis(np.tensordot(known[step], w, (1, j)), 0, j)
                out.append(packed(w))
            return pa.table({"box": pa.array(near, pa.int32()), "s": pa.array(out, pa.binary())})

        def local(table: pa.Table) -> pa.Table:
            here = np.nonzero(box_of == table.column("box")[0].as_py())[0]
            total = packed(sum(np.frombuffer(s.as_buffer(), np.float64) for s in table.column("s").combine_chunks()))
            return pa.table({"part": pa.array(here, pa.int32()), "s": pa.array([total] * len(here), pa.binary())})

        def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    part, n = batch["part"][i].as_py(), batch["n"][i].as_py()
                    z = _values(bases(part, unpacked(batch["f"][i], n)), unpacked(batch["s"][i], p ** d))
                    yield pa.RecordBatch.from_arrays([batch["part"].slice(i, 1), pa.array([packed(z)], pa.binary())], ["part", "z"])

        rows = self.parts.select("part", "n", "f")
        sums = rows.join(vectors.select("part", "v"), "part").mapInArrow(up, "box int, s binary")
        moved = sums.groupBy("box").applyInArrow(across, "box int, s binary")
        sent = moved.groupBy("box").applyInArrow(local, "part int, s binary")
        return rows.join(sent, "part").mapInArrow(down, "part int, z binary")


def lay_out_boxes(copies: Copies, sigma: float, reach: float, extra: list[str], most_power: int = 1) -> BoxLayout | None:
    """Packs folded rows with the named columns by boxes; None where tiles cost less, or where a feature is missing.

    Sums that boxes exchange are counted first: they may be `MOST_SENT` times the rows at most, so a pass is linear in the rows.
    """
    d = width(copies.groups)
    side = SIDE * sigma
    nodes = degree_for(SIDE * math.sqrt(most_power)) ** d if d <= MAX_WIDTH else math.inf
    most = min(MAX_BOXES, MOST_SENT * copies.n_groups / nodes)
    if most < 1:
        return None
    holes = [F.count_if(F.col("f")[j].isNull() | F.isnan(F.col("f")[j])).alias(f"h{j}") for j in range(d)]
    ends = copies.groups.agg(*holes, *[f(F.col("f")[j]).alias(f"{n}{j}") for j in range(d) for n, f in (("a", F.min), ("b", F.max))]).first()
    if any(ends[f"h{j}"] for j in range(d)):
        return None  # a missing feature has no box
    low = np.array([ends[f"a{j}"] for j in range(d)])
    span = np.array([ends[f"b{j}"] for j in range(d)]) - low
    if not np.isfinite(span).all() or span.max() / side > 1e9:
        return None
    places = [F.floor((F.col("f")[j] - F.lit(float(low[j]))) / side).cast("bigint").alias(f"_c{j}") for j in range(d)]
    names = [f"_c{j}" for j in range(d)]
    placed = copies.groups.select(F.col("gid").alias("key"), "f", *extra, *places)
    found = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).limit(int(most) + 1).collect()
    if len(found) > most:
        return None
    found = sorted(found, key=lambda r: tuple(r[c] for c in names))
    cells = np.array([[r[c] for c in names] for r in found], dtype=np.int64).reshape(-1, d)
    near = sum(
        int(((np.maximum(np.abs(cells[i:i + 256, None] - cells[None]) - 1, 0) ** 2).sum(2) * side * side <= reach * reach).sum())
        for i in range(0, len(cells), 256))
    if near > most:
        return None
    counts = [math.ceil(r["n"] / BLOCK_ROWS) for r in found]
    base = [0, *itertools.accumulate(counts)][:-1]
    frame = placed.sparkSession.createDataFrame(
        [(*(int(v) for v in cell), b, c) for cell, b, c in zip(cells, base, counts)], ", ".join(f"{c} bigint" for c in names) + ", base int, parts int")
    rows = placed.join(F.broadcast(frame), names).withColumn(
        "part", (F.col("base") + F.pmod(F.xxhash64(F.lit("part"), "key"), F.col("parts"))).cast("int"))
    parts = cut_lineage(pack_rows(rows, "part", ["f", *extra]), "parts")
    return BoxLayout(parts, cells, np.repeat(np.arange(len(cells)), counts), low, side, sigma, reach)
