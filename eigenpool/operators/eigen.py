"""Largest eigenpairs of a normalised affinity.

Eigenvectors live in DataFrames; only matrices whose size depends on the number of
wanted vectors (and never on the rows) reach the driver. One solver serves all sizes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.operators.boxes import lay_out_boxes
from eigenpool.operators.components import components
from eigenpool.operators.layout import (
    GraphLayout, keys_of, lay_out, lay_out_graph, lines_of, map_parts, pack_rows, packed, unpack_rows, unpacked,
)
from eigenpool.operators.pairs import affinity_reach, kernel
from eigenpool.operators.tiles import BLOCK_ROWS, MIN_BLOCKS, Copies, build_blocks, sq_distances
from eigenpool.session import cut_lineage

#: Vectors of a block beyond those still wanted.
GUARD = 8
#: Columns of a basis; when it is full, the best of it start a new one.
BASIS = 60
#: Products in one step on a graph, the degree of its filter.
DEGREE = 24
#: Below this share of (-1, 1) a graph's eigenvalues are damped in the first cycle, before any is known.
FIRST_BOUND = 0.9
CYCLES = 40


@dataclass(frozen=True)
class Eigen:
    """vectors(gid, m, degree, y) with unit columns over all rows, values descending."""

    vectors: DataFrame
    values: list[float]
    residual: float


@dataclass(frozen=True)
class Operator:
    """A symmetric matrix with eigenvalues in [-1, 1], applied to packed vectors (part, n, v).

    `apply(vectors, width)` gives (part, z). `filter(vectors, width, degree, bound)`, where it is cheap to chain products,
    gives the Chebyshev polynomial that stays within 1 on [-1, bound] and grows beyond.
    """

    apply: Callable[[DataFrame, int], DataFrame]
    filter: Callable[[DataFrame, int, int, float], DataFrame] | None = None


def list_array(matrix: np.ndarray) -> pa.ListArray:
    matrix = np.ascontiguousarray(matrix, dtype=float)
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _total(parts: DataFrame, columns: list[str], fn: Callable, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all packed rows of fn(matrices), a matrix of fixed shape: one small sum per task, added on the cluster."""

    def part(batches):
        total = np.zeros(shape)
        for _, _, matrices in lines_of(batches, columns):
            total += fn(matrices)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["pos", "v"])

    sums = parts.select("n", *columns).mapInArrow(part, "pos bigint, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(shape[0] * shape[1])
    for row in sums:
        out[row["pos"]] = row["v"]
    return out.reshape(shape)


def _orthonormal(g: np.ndarray, scale: float = 1.0) -> np.ndarray:
    """Weights turning columns with Gram matrix g into orthonormal ones; lost directions go.

    `scale` is the square of the length that columns had before all else was taken off them.
    """
    size, vecs = np.linalg.eigh((g + g.T) / 2)
    keep = size > max(max(size.max(), 0.0) * 1e-13, scale * 1e-24)
    return vecs[:, keep] / np.sqrt(size[keep])


def _slope(value: float, degree: int, bound: float) -> float:
    """Derivative of the filter at an eigenvalue beyond the bound."""
    if degree == 1:
        return 1.0
    x = max((2 * value - (bound - 1)) / (bound + 1), 1 + 1e-12)
    return degree * math.sinh(degree * math.acosh(x)) / math.sqrt(x * x - 1) * 2 / (bound + 1)


def _filter_value(image: float, degree: int, bound: float) -> float:
    """The eigenvalue beyond the bound that the filter maps to `image`."""
    if degree == 1:
        return image
    x = math.cosh(math.acosh(max(image, 1.0)) / degree)
    return (x * (bound + 1) + (bound - 1)) / 2


class _Solve:
    """Restarted block Krylov iteration on packed parts (part, n, locked, v) with orthonormal columns in `locked` and `v` together."""

    def __init__(self, operator: Operator, n: int, tol: float):
        self.operator, self.n, self.tol, self.caution = operator, n, tol, 0.5

    def start(self, parts: DataFrame, known: int, width: int) -> tuple[DataFrame, int]:
        """A hashed block, orthogonal to the known vectors."""

        def draw(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    x = keys_of(batch["keys"][i]).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
                    x = x + np.arange(1, width + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
                    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # mixes the bits
                        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
                    drawn = (x >> np.uint64(11)).astype(float) / float(1 << 52) - 1.0
                    yield pa.RecordBatch.from_arrays(
                        [batch["part"].slice(i, 1), batch["n"].slice(i, 1), batch["known"].slice(i, 1), pa.array([packed(drawn)], pa.binary())],
                        ["part", "n", "locked", "v"])

        block = parts.select("part", "n", "keys", "known").mapInArrow(draw, "part int, n int, locked binary, v binary")
        off = _total(block, ["locked", "v"], lambda x: x["locked"].T @ x["v"], (known, width))
        keep = {"locked": (["locked"], lambda u: u)}
        block = map_parts(block, keep | {"v": (["locked", "v"], lambda u, v: v - u @ off)})
        turn = _orthonormal(_total(block, ["v"], lambda x: x["v"].T @ x["v"], (width, width)))
        return map_parts(block, keep | {"v": (["v"], lambda v: v @ turn)}), turn.shape[1]

    def cycle(self, block: DataFrame, locked: int, width: int, wanted: int, degree: int, bound: float, steps: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """(part, n, locked, v): the best vectors of the block's Krylov space, at most `width`; values and residuals.

        Every step costs one application of the operator and one written table; the new block is orthogonalised twice
        against the whole basis and the locked vectors, and the small projected matrix is solved on the driver.
        """
        basis = map_parts(block, {"v": (["v"], lambda v: v), "basis": (["locked", "v"], lambda u, v: np.concatenate([u, v], axis=1))})
        fresh = size = width
        projected = np.zeros((0, 0))
        for step in range(steps):
            vectors = basis.select("part", "n", "v")
            z = self.operator.apply(vectors, fresh) if degree == 1 else self.operator.filter(vectors, fresh, degree, bound)
            work = cut_lineage(basis.select("part", "n", "basis").join(z, "part"), "basis")
            columns = locked + size
            h = _total(work, ["basis", "z"], lambda x: x["basis"].T @ x["z"], (columns, fresh))

            def left(x, h=h):
                rest = x["z"] - x["basis"] @ h
                return np.concatenate([x["basis"], rest], axis=1).T @ rest

            again = _total(work, ["basis", "z"], left, (columns + fresh, fresh))
            fix, rest = again[:columns], again[columns:]
            grown = np.zeros((size, size))
            grown[: len(projected), : len(projected)] = projected
            grown[:, size - fresh:] = h[locked:]
            grown[size - fresh:, :] = h[locked:].T
            projected = (grown + grown.T) / 2
            values, ritz = np.linalg.eigh(projected)
            values, ritz = values[::-1], ritz[:, ::-1]
            last = ritz[size - fresh:, :width]
            residual = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", last, rest, last), 0.0))
            if locked + size >= self.n or step == steps - 1:
                break
            limits = [self.caution * self.tol * _slope(_filter_value(v, degree, bound), degree, bound) for v in values[:wanted]]
            if len(limits) == wanted and (residual[:wanted] < limits).all():
                break
            turn = _orthonormal(rest, float(np.abs(values).max()) ** 2)
            turn = turn[:, -min(turn.shape[1], self.n - locked - size):]
            if turn.shape[1] == 0:
                break

            def grow(q, z, overlap=h + fix, turn=turn):
                return (z - q @ overlap) @ turn

            basis = map_parts(work, {
                "v": (["basis", "z"], grow),
                "basis": (["basis", "z"], lambda q, z, grow=grow: np.concatenate([q, grow(q, z)], axis=1))})
            fresh = turn.shape[1]
            size += fresh
        top = ritz[:, :width]
        best = map_parts(work, {"locked": (["basis"], lambda q: q[:, :locked]), "v": (["basis"], lambda q: q[:, locked:] @ top)})
        return best, values[:width], residual

    def settle(self, best: DataFrame, width: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """Rotates a filter's best vectors to the matrix's own, with values and residuals |M v - value v|."""
        z = self.operator.apply(best.select("part", "n", "v"), width)
        work = cut_lineage(best.join(z, "part"), "best")
        inner = _total(work, ["v", "z"], lambda x: x["v"].T @ np.concatenate([x["v"], x["z"]], axis=1), (width, 2 * width))
        turn = _orthonormal(inner[:, :width])
        image = turn.T @ inner[:, width:] @ turn
        values, ritz = np.linalg.eigh((image + image.T) / 2)
        values, whole = values[::-1], turn @ ritz[:, ::-1]

        def squares(x):
            rest = x["z"] @ whole - (x["v"] @ whole) * values
            return (rest * rest).sum(0)[None, :]

        residual = np.sqrt(_total(work, ["v", "z"], squares, (1, len(values)))[0])
        return map_parts(work, {"locked": (["locked"], lambda u: u), "v": (["v"], lambda v: v @ whole)}), values, residual

    def lock(self, block: DataFrame, count: int) -> DataFrame:
        """The first vectors of the block join the locked ones."""
        return map_parts(block, {"locked": (["locked", "v"], lambda u, v: np.concatenate([u, v[:, :count]], axis=1)), "v": (["v"], lambda v: v[:, count:])})


def leading_pairs(
    operator: Operator, parts: DataFrame, k: int, n: int, known: int, tol: float, degree: int = DEGREE, cycles: int = CYCLES,
) -> tuple[DataFrame, list[float], float]:
    """The k largest eigenpairs: packed vectors (part, y), values descending, and the largest residual.

    `parts` are (part, n, keys, known): in `known` the vectors of the eigenvalue 1 that follow from the matrix itself. They
    are locked from the start, which deflates them exactly; others are locked once their residual is below `tol`. Each
    cycle builds a basis of at most `BASIS` columns and starts the next one from the best of it. On an operator with a filter
    the smallest value found bounds the part that the next cycle damps: values found are never above the true ones, so
    nothing wanted is damped. Raises ArithmeticError if the pairs aren't settled after `cycles` cycles.
    """
    k = min(k, n)
    first = lambda column, all_: map_parts(parts if column == "known" else block, {"y": ([column], lambda u: u[:, :all_])}).drop("n")
    if known >= k:
        return first("known", k), [1.0] * k, 0.0
    solve = _Solve(operator, n, tol)
    block, width = solve.start(parts, known, min(k - known + GUARD, n - known))
    locked, values, worst, bound = known, [1.0] * known, 0.0, None
    for _ in range(cycles):
        power = 1 if operator.filter is None or n <= BASIS else degree
        used = FIRST_BOUND if bound is None else bound
        steps = max(2, -(-BASIS // width)) if bound is not None or power == 1 else 2
        block, found, residual = solve.cycle(block, locked, width, k - locked, power, used, steps)
        if power > 1:
            block, found, residual = solve.settle(block, len(found))
            solve.caution *= 0.1  # should the filter's own residuals have promised too much
        width = len(found)
        wanted = min(k - locked, width)
        trusted = power == 1 or found[wanted - 1] > used  # else something wanted may have been damped
        settled = int(np.argmin(np.append(residual[:wanted] < tol, False))) if trusted else 0
        worst = max([worst, *map(float, residual[:settled])])
        values += [float(v) for v in found[:settled]]
        block = solve.lock(block, settled)
        locked, width = locked + settled, width - settled
        if locked >= k:
            return first("locked", k), values[:k], worst
        if not width:
            raise ArithmeticError(f"only {locked} of {k} eigenvectors found")
        bound = min(max(float(found[-1]), -0.5), 1 - 1e-9)
    raise ArithmeticError(f"{locked} of {k} eigenvectors settled after {cycles} cycles, the next has residual {residual[settled]:.1e}")


def _positive(vectors: DataFrame, k: int) -> DataFrame:
    """Largest-magnitude entry of every column positive (ties to the smaller key)."""
    best = vectors.agg(*[
        F.max(F.struct(F.abs(F.col("y")[j]).alias("a"), (-F.col("key")).alias("o"), F.col("y")[j].alias("v"))).alias(f"c{j}")
        for j in range(k)
    ]).first()
    signs = [-1.0 if best[f"c{j}"]["v"] < 0 else 1.0 for j in range(k)]
    return vectors.withColumn("y", F.array(*[F.col("y")[j] * F.lit(signs[j]) for j in range(k)]))


def top_eigen(copies: Copies, sigma: float, k: int, block_rows: int = BLOCK_ROWS, tol: float = 1e-8) -> Eigen:
    """k largest eigenpairs of M = D^-1/2 W D^-1/2 for the full Gaussian affinity W.

    Equal rows have equal entries in every eigenvector with a non-zero eigenvalue, so
    the problem is solved on folded rows, weighted by the root of their copies. W is
    never stored: features are laid out once, and each pass sends vectors to them. Narrow rows are summed
    by boxes, in time linear in the rows; for others the tiles are filled again, except those too far to matter. The eigenvector of 1, the root of the degrees, is known.
    """
    reach = affinity_reach(sigma, copies.n_rows)
    layout = lay_out_boxes(copies, sigma, reach, ["m"])
    if layout is not None:
        times = layout.product
    else:
        layout = lay_out(build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups, block_rows=block_rows), reach, ["m"])

        def weights(x: np.ndarray, y: np.ndarray, same: bool) -> np.ndarray:
            return kernel(sq_distances(x, y), sigma, same)

        def times(vectors: DataFrame) -> DataFrame:
            return layout.product(vectors, weights)

    degrees = times(layout.parts.select("part", F.col("m").alias("v"))).withColumnRenamed("z", "d")
    rows = cut_lineage(layout.parts.select("part", "n", "keys", "m").join(degrees, "part"), "degrees")
    floored = lambda d: np.maximum(d, 1e-9)
    total = float(_total(rows, ["m", "d"], lambda x: x["m"].T @ floored(x["d"]), (1, 1))[0, 0])
    shape = map_parts(rows, {
        "known": (["m", "d"], lambda m, d: np.sqrt(m * floored(d) / total)), "s": (["m", "d"], lambda m, d: np.sqrt(m / floored(d)))})
    rows = cut_lineage(rows.join(shape.drop("n"), "part"), "scaled")
    scales = rows.select("part", "n", "s")

    def matvec(vectors: DataFrame, width: int) -> DataFrame:
        sent = map_parts(vectors.join(scales.drop("n"), "part"), {"v": (["v", "s"], lambda v, s: v * s)})
        z = scales.join(times(sent), "part")
        return map_parts(z, {"z": (["z", "s"], lambda z, s: z * s)}).drop("n")

    vectors, values, residual = leading_pairs(Operator(matvec), rows, k, copies.n_groups, 1, tol)
    spread = unpack_rows(map_parts(rows.join(vectors, "part"), {
        "y": (["y", "m"], lambda y, m: y / np.sqrt(m)), "m": (["m"], lambda m: m), "degree": (["d"], floored)}).join(rows.select("part", "keys"), "part"), ["y", "m", "degree"])
    spread = spread.select("key", F.col("m")[0].cast("bigint").alias("m"), F.col("degree")[0].alias("degree"), "y")
    signed = _positive(cut_lineage(spread, "vectors"), len(values))
    return Eigen(signed.withColumnRenamed("key", "gid"), values, residual)


def graph_operator(layout: GraphLayout) -> Operator:
    """Products with a matrix that is laid out by strips; those of a filter are chained, `hops` of them between two exchanges."""

    def apply(vectors: DataFrame, width: int) -> DataFrame:
        return layout.run(vectors, width, [[lambda product, rows, a, b: product(a)]])

    def filtered(vectors: DataFrame, width: int, degree: int, bound: float) -> DataFrame:
        def line(product, rows, a, b):
            return (2.0 * product(a) - (bound - 1.0) * a[rows]) / (bound + 1.0)

        def go_on(product, rows, a, b):
            return 2.0 * line(product, rows, a, b) - b[rows]

        products = [line] + [go_on] * (degree - 1)
        return layout.run(vectors, width, [products[i:i + layout.hops] for i in range(0, degree, layout.hops)])

    return Operator(apply, filtered)


def entries_eigen(
    m: DataFrame, n: int, k: int, masses: DataFrame | None = None, homes: DataFrame | None = None, block_rows: int = BLOCK_ROWS, tol: float = 1e-6,
) -> tuple[DataFrame, list[float], float]:
    """Largest eigenpairs of a sparse symmetric table (i, j, m) with eigenvalues in [-1, 1]: (key, y), values, residual.

    With `masses` (key, mass), m is w_ij / sqrt(mass_i mass_j) for weights w > 0 with the row sums `mass`. Then every connected component has
    the eigenvalue 1 with the root of its masses as vector, and these are deflated exactly. If there are at least k
    components, the k with the most mass are the result. `homes` (key, strip) places rows that belong together;
    by default rows are placed by hash.
    """
    diagonal = m.select(F.col("i").alias("key")).distinct()
    full = m.unionByName(diagonal.select(F.col("key").alias("i"), F.col("key").alias("j"), F.lit(0.0).alias("m")))
    full = cut_lineage(full.groupBy("i", "j").agg(F.sum("m").alias("m")), "entries")
    strips = max(min(MIN_BLOCKS, n), math.ceil(n / block_rows))
    if homes is None:
        homes = diagonal.select("key", F.pmod(F.xxhash64("key"), F.lit(strips)).cast("int").alias("strip"))
    homes = cut_lineage(homes, "homes")
    layout = lay_out_graph(full, homes, n, strips)
    known, count, placed = F.array().cast("array<double>"), 0, homes
    if masses is not None:
        placed = cut_lineage(components(full.select("i", "j")).join(masses, "key").join(homes, "key"), "components")
        sums = placed.groupBy("component").agg(F.sum("mass").alias("total")).orderBy(F.desc("total"), "component").limit(min(k, n)).collect()
        count = len(sums)
        known = F.array(*[F.when(F.col("component") == s["component"], F.sqrt(F.col("mass") / s["total"])).otherwise(0.0) for s in sums])
    parts = cut_lineage(pack_rows(placed.select("key", "strip", known.alias("known")), "strip", ["known"]), "known")
    vectors, values, residual = leading_pairs(graph_operator(layout), parts, k, n, count, tol)
    rows = unpack_rows(parts.select("part", "n", "keys").join(vectors, "part"), ["y"])
    return _positive(cut_lineage(rows, "vectors"), len(values)), values, residual
