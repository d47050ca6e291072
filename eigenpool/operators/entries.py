"""Symmetric matrices whose entries tiles list anew whenever they are asked for: entries are neither stored nor shuffled.

Values of a row (its copies, factors of a scaling) travel with the row to the tiles, so a matrix is scaled, summed by row
and compared with another one where its entries arise. What is left is the long table (i, j, ...) itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.operators.tiles import Blocks, Side, run_tiles, sq_distances
from eigenpool.session import cut_lineage


def in_room(a: Side, b: Side, reach: float) -> tuple[Side, Side]:
    """The rows of two blocks without those that are, by a single feature, out of reach of the whole other block."""

    def near(one: Side, two: Side) -> Side:
        if not len(two):
            return taken(one, np.zeros(len(one), dtype=bool))
        low, high = np.fmin.reduce(two.x, axis=0), np.fmax.reduce(two.x, axis=0)
        room = reach * (1 + 1e-6) + 1e-9 * np.maximum(np.abs(low), np.abs(high))
        keep = ((one.x >= low - room) & (one.x <= high + room)).all(axis=1)
        return one if keep.all() else taken(one, keep)

    def taken(one: Side, keep: np.ndarray) -> Side:
        return Side(one.x[keep], {name: column[keep] for name, column in one.cols.items() if name != "f"})

    a = near(a, b)
    return a, near(b, a)


@dataclass(frozen=True)
class TiledEntries:
    """Entries (i, j, w, mi, mj) at or above a floor, and values scaled from them. Anything else asked of it is asked of its long table."""

    blocks: Blocks
    weights: Callable
    floor: float
    reach: float
    origin: object
    #: Values made from others: (made, of, factor), as of_ij * factor_i * factor_j, and the names under which values are shown.
    scales: tuple[tuple[str, str, str], ...] = ()
    shown: tuple[tuple[str, str], ...] = (("w", "w"), ("mi", "mi"), ("mj", "mj"))

    @cached_property
    def table(self) -> DataFrame:
        """The long table (i, j, <values shown>)."""
        shown, listed = self.shown, self._listed({inner for _, inner in self.shown})

        def tile(a, b, same):
            return [
                {"i": one["gid"][i], "j": two["gid"][j], **{name: values[inner] for name, inner in shown}}
                for one, i, two, j, values in listed(a, b, same)]

        kinds = "".join(f", {name} {'bigint' if inner in ('mi', 'mj') else 'double'}" for name, inner in shown)
        return run_tiles(self.blocks, tile, f"i bigint, j bigint{kinds}", self.reach)

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.table, name)

    def inner(self, name: str) -> str:
        return dict(self.shown)[name]

    def drop(self, *names: str) -> TiledEntries:
        return replace(self, shown=tuple(s for s in self.shown if s[0] not in names))

    def withColumnRenamed(self, old: str, new: str) -> TiledEntries:
        return replace(self, shown=tuple((new if name == old else name, inner) for name, inner in self.shown))

    def row_sums(self, value: str, copies: str | None) -> DataFrame:
        """(i, total, n): sums of the rows, each entry counted for its copies, and entries per row; taken once."""
        known, inner, times = self.__dict__.setdefault("_sums", {}), self.inner(value), self.inner(copies) if copies else None
        if (inner, times) in known:
            return known[inner, times]
        dense = self._dense(inner if inner not in ("mi", "mj") else None)

        reach = self.reach
        by_row, by_column = ((inner, times).count(name) for name in ("mi", "mj"))

        def sums(one: Side, two: Side, cells: np.ndarray, held: np.ndarray) -> tuple:
            n = held.sum(1)
            some = n > 0
            total = (cells @ two["m"].astype(float) ** by_column) * one["m"].astype(float) ** by_row
            return one["gid"][some], total[some], n[some]

        def tile(a, b, same):
            a, b = (a, b) if same else in_room(a, b, reach)
            cells, held = dense(a, b, same)
            cols = [sums(a, b, cells, held)] + ([] if same else [sums(b, a, cells.T, held.T)])
            return dict(zip(["i", "total", "n"], [np.concatenate(c) for c in zip(*cols)]))

        parts = run_tiles(self.blocks, tile, "i bigint, total double, n bigint", self.reach, total={"total": "sum", "n": "sum"})
        known[inner, times] = cut_lineage(parts.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")), "sums")
        return known[inner, times]

    def scaled(self, value: str, factors: DataFrame, out: str) -> TiledEntries:
        """Adds value_ij * factor_i * factor_j with factors (i, factor); rows without a factor leave the matrix."""
        factor = f"factor{len(self.scales)}"
        rows = cut_lineage(self.blocks.rows.join(factors.select(F.col("i").alias("gid"), F.col("factor").alias(factor)), "gid"), "scaled")
        made = (f"made{len(self.scales)}", self.inner(value), factor)
        shown = tuple(s for s in self.shown if s[0] != out)
        return replace(self, blocks=replace(self.blocks, rows=rows), scales=(*self.scales, made), shown=(*shown, (out, made[0])))

    def gaps(self, other: TiledEntries, value: str, atol: float, rtol: float) -> DataFrame:
        """(n, close, squares) of each cell for a matrix alongside: entries, whether all agree, and the sum of squared gaps."""
        one, two = self.inner(value), other.inner(value)
        longer = max(self, other, key=lambda e: len(e.scales))
        listed = longer._listed({one, two})

        def tile(a, b, same):
            n, close, squares = 0, 1, 0.0
            for _, i, _, _, values in listed(a, b, same):
                va, vb = values[one], values[two]
                n += len(i)
                close = min(close, int((np.abs(va - vb) <= atol + rtol * np.abs(vb)).all()))
                squares += float(((va - vb) ** 2).sum())
            return {"cell": [0], "n": [n], "close": [close], "squares": [squares]}

        total = {"n": "sum", "close": "min", "squares": "sum"}
        return run_tiles(longer.blocks, tile, "cell bigint, n bigint, close bigint, squares double", self.reach, total=total)

    def alongside(self, other) -> bool:
        """Whether the other matrix has the same entries, one for a pair of indices, with values that arise in the same tiles."""
        if not isinstance(other, TiledEntries) or other.origin is not self.origin:
            return False
        if self.blocks is not other.blocks and (self.scales and other.scales or self.blocks.rows.count() != other.blocks.rows.count()):
            return False
        # Ids may repeat in the input, and an index then stands for several rows.
        return self.blocks.rows.groupBy("gid").count().where("count > 1 or gid is null").isEmpty()

    def _needed(self, names: set) -> tuple[tuple[str, str, str], ...]:
        return self.scales if names & {made for made, _, _ in self.scales} else ()

    def _dense(self, name: str | None) -> Callable:
        """dense(a, b, same) -> (values, held) of a tile as matrices: 0 where there is no entry; without a name, 1 for each entry."""
        weights, floor, limit, scales = self.weights, self.floor, self.reach ** 2 * (1 + 1e-9), self._needed({name})

        def dense(a: Side, b: Side, same: bool) -> tuple[np.ndarray, np.ndarray]:
            d2 = sq_distances(a.x, b.x)
            if same:
                np.fill_diagonal(d2, 0.0)
            held = d2 <= limit
            w = weights(np.minimum(d2, limit, out=d2))
            held &= w >= floor
            values = {"w": w, None: held}
            for made, of, factor in scales:
                values[made] = values[of] * a[factor][:, None] * b[factor][None, :]
            return np.where(held, values[name], 0.0), held

        return dense

    def _listed(self, needed: set) -> Callable:
        """listed(a, b, same) -> (one, i, two, j, values) for a tile and, off the diagonal, its mirror image; i, j are places in the blocks."""
        weights, floor, reach, limit, scales = self.weights, self.floor, self.reach, self.reach ** 2 * (1 + 1e-9), self._needed(needed)

        def side(a: Side, b: Side, i: np.ndarray, j: np.ndarray, values: dict) -> tuple:
            return a, i, b, j, values | {name: x["m"][at] for name, x, at in (("mi", a, i), ("mj", b, j)) if name in needed}

        def listed(a: Side, b: Side, same: bool) -> list[tuple]:
            a, b = (a, b) if same else in_room(a, b, reach)
            d2 = sq_distances(a.x, b.x)
            if same:
                np.fill_diagonal(d2, 0.0)
            near = d2 <= limit
            i = np.repeat(np.arange(len(a)), near.sum(1))
            flat = np.flatnonzero(near)
            j = flat - i * len(b)
            w = weights(d2.ravel()[flat])
            keep = w >= floor
            if not keep.all():
                i, j, w = i[keep], j[keep], w[keep]
            values = {"w": w}
            for made, of, factor in scales:
                values[made] = values[of] * a[factor][i] * b[factor][j]
            return [side(a, b, i, j, values)] + ([] if same else [side(b, a, j, i, values)])

        return listed
