"""Silhouettes of narrow rows from sums of distances by a tree of boxes, in time that grows with the rows.

Between boxes with at least a box of room between them a distance is, far beyond the digits that a score shows, a polynomial
of small degree. So what the rows of a box, label by label, add to the rows of another follows from their weights on a fixed
number of places; rows of boxes closer to each other are paired. The tree splits where rows are dense, so a row is paired
with a bounded number of rows. Its layout comes from a bounded hash sample; every row is in the sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.functions.vectors import width
from eigenpool.operators.boxes import HELD_BYTES, _sums, _values, chebyshev
from eigenpool.operators.layout import packed
from eigenpool.operators.tiles import BLOCK_ROWS, Copies, list_matrix, sq_distances
from eigenpool.session import cut_lineage

#: Fewer rows are paired: that costs less.
MIN_ROWS = 1 << 15
#: Places along each feature and rows of a box that isn't split, by the number of features.
PLACES = {1: 20, 2: 14, 3: 10}
LEAF_ROWS = {1: 256, 2: 512, 3: 1024}
#: Pairs of labeling and label that are summed side by side; more are left to the tiles.
MAX_LABELS = 64
#: The tree is drawn from about so many rows, and so many for each box that isn't split.
SAMPLE_ROWS, SAMPLE_PER_LEAF = 20_000, 16
MAX_SAMPLE = 200_000
MAX_DEPTH = 60
#: Neighbouring boxes whose rows are scored by one call: at least and at most so many, and so many bytes of their sums. The more there are,
#: the fewer times rows and sums are sent, which is most of what a silhouette puts on disk; each core gets `CALLS` calls all the same.
GROUP_LEAVES, MOST_GROUP_LEAVES, GROUP_BYTES, CALLS = 16, 512, 12 << 20, 3


def places(p: int) -> np.ndarray:
    return np.cos(np.pi * (np.arange(p) + 0.5) / p)


def lagrange(x: np.ndarray, p: int) -> np.ndarray:
    """Values at x in [-1, 1] of the polynomials that are 1 on one of the p places and 0 on the others."""
    turn = np.cos(np.pi * np.outer(np.arange(p), np.arange(p) + 0.5) / p) * np.where(np.arange(p) == 0, 1, 2)[:, None] / p
    return chebyshev(x, p) @ turn


@dataclass(frozen=True)
class Tree:
    """Boxes as cubes (centre, half side). Children of box b are first[b] .. first[b] + kids[b] - 1; without any it is a leaf."""

    centre: np.ndarray
    half: np.ndarray
    first: np.ndarray
    kids: np.ndarray
    parent: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in a tree whose split boxes have all their children."""
        at = np.zeros(len(x), dtype=np.int32)
        bit = 1 << np.arange(x.shape[1])
        open_ = np.nonzero(self.kids[at])[0]
        while len(open_):
            box = at[open_]
            at[open_] = self.first[box] + (x[open_] >= self.centre[box]) @ bit
            open_ = open_[self.kids[at[open_]] > 0]
        return at

    def up_from(self, box: int) -> Iterator[int]:
        while box >= 0:
            yield box
            box = int(self.parent[box])

    def local(self, box: int, x: np.ndarray) -> list[np.ndarray]:
        """The polynomials of a box at rows in it, feature by feature."""
        at = np.clip((x - self.centre[box]) / self.half[box], -1.0, 1.0)
        return [lagrange(at[:, j], PLACES[x.shape[1]]) for j in range(x.shape[1])]

    def steps(self, box: int, above: int) -> list[np.ndarray]:
        """The polynomials of a box above at the places of a box, feature by feature."""
        p = PLACES[self.centre.shape[1]]
        at = (self.centre[box] - self.centre[above])[:, None] + self.half[box] * places(p)[None, :]
        return [lagrange(np.clip(a / self.half[above], -1.0, 1.0), p) for a in at]

    def lists(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For these leaves: pairs (box that holds one or more of them, box far from it) and (leaf, leaf near it).

        Together they have every leaf on the other side once for each of these.
        """
        wanted = np.zeros(len(self.half), dtype=bool)
        for leaf in leaves:
            for box in self.up_from(int(leaf)):
                if wanted[box]:
                    break
                wanted[box] = True
        far, near = [], []
        a = b = np.zeros(1, dtype=np.int64)
        while len(a):
            gap = (np.abs(self.centre[a] - self.centre[b]) - (self.half[a] + self.half[b])[:, None]).max(1)
            apart = gap >= 2 * np.maximum(self.half[a], self.half[b]) * (1 - 1e-9)
            far.append(np.stack([a[apart], b[apart]]))
            a, b = a[~apart], b[~apart]
            done = (self.kids[a] == 0) & (self.kids[b] == 0)
            near.append(np.stack([a[done], b[done]]))
            a, b = a[~done], b[~done]
            split_a = (self.kids[a] > 0) & ((self.kids[b] == 0) | (self.half[a] >= self.half[b]))
            split_b = (self.kids[b] > 0) & ((self.kids[a] == 0) | (self.half[b] >= self.half[a]))
            na, nb = np.where(split_a, self.kids[a], 1), np.where(split_b, self.kids[b], 1)
            times = na * nb
            of = np.repeat(np.arange(len(a)), times)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            a2 = np.where(split_a[of], self.first[a[of]] + step // nb[of], a[of])
            b2 = np.where(split_b[of], self.first[b[of]] + step % nb[of], b[of])
            a, b = a2[wanted[a2]], b2[wanted[a2]]
        return np.concatenate(far, axis=1), np.concatenate(near, axis=1)


def draw_tree(sample: np.ndarray, low: np.ndarray, high: np.ndarray, most: float) -> Tree:
    """Splits boxes that hold more of the sample than `most`, as long as halves differ in more than rounding."""
    d = sample.shape[1]
    signs = 2.0 * ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1) - 1.0
    centre, half, first, kids, parent = [(low + high) / 2], [float((high - low).max()) / 2 * (1 + 1e-12)], [0], [0], [-1]
    open_ = [(0, sample, 0)]
    while open_:
        box, rows, depth = open_.pop()
        fine = 64 * np.finfo(float).eps * np.abs(centre[box]).max()
        if len(rows) <= most or depth >= MAX_DEPTH or half[box] <= fine:
            continue
        first[box], kids[box] = len(half), 1 << d
        child = (rows >= centre[box]) @ (1 << np.arange(d))
        for k in range(1 << d):
            open_.append((len(half), rows[child == k], depth + 1))
            centre.append(centre[box] + signs[k] * half[box] / 2)
            half.append(half[box] / 2)
            first.append(0)
            kids.append(0)
            parent.append(box)
    return Tree(np.array(centre), np.array(half), np.array(first), np.array(kids), np.array(parent))


def trimmed(tree: Tree, counts: dict[int, int]) -> tuple[Tree, dict[int, int]]:
    """The tree without empty boxes and boxes with one child, and the new numbers of its leaves in the order of place."""
    total = np.zeros(len(tree.half), dtype=np.int64)
    for leaf, n in counts.items():
        total[leaf] = n
    for box in range(len(total) - 1, 0, -1):  # children come after their parents
        total[tree.parent[box]] += total[box]

    def down(box: int) -> tuple[int, list[int]]:
        while True:
            held = [int(k) for k in range(tree.first[box], tree.first[box] + tree.kids[box]) if total[k]]
            if len(held) != 1:
                return box, held
            box = held[0]

    box, held = down(0)
    kept, first, kids, parent = [box], [0], [0], [-1]
    queue = [(0, held)]
    while queue:
        at, held = queue.pop()
        first[at], kids[at] = len(kept), len(held)
        below = []
        for k in held:
            box, inner = down(k)
            below.append((len(kept), inner))
            kept.append(box)
            first.append(0)
            kids.append(0)
            parent.append(at)
        queue += below
    out = Tree(tree.centre[kept], tree.half[kept], np.array(first), np.array(kids), np.array(parent))
    leaves: dict[int, int] = {}
    stack = [0]
    while stack:
        at = stack.pop()
        if out.kids[at]:
            stack += range(out.first[at], out.first[at] + out.kids[at])
        else:
            leaves[kept[at]] = at
    return out, leaves


def _apply(bases: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """A matrix for each feature, applied along it to (places, labels)."""
    p = bases[0].shape[1]
    w = values.reshape((p,) * len(bases) + (-1,))
    for j, basis in enumerate(bases):
        w = np.moveaxis(np.tensordot(basis, w, (1, j)), 0, j)
    return w.reshape(-1, values.shape[1])


def _far_sums(tree: Tree, far: np.ndarray, weights: dict[int, np.ndarray], labels: int) -> dict[int, np.ndarray]:
    """What far boxes add on the places of each box."""
    d = tree.centre.shape[1]
    p = PLACES[d]
    targets, at = np.unique(far[0], return_inverse=True)
    out = np.zeros((len(targets), p ** d, labels))
    a, b = far
    least = np.minimum(tree.half[a], tree.half[b])
    moved = np.rint((tree.centre[b] - tree.centre[a]) / least[:, None])
    kinds, kind = np.unique(np.column_stack([tree.half[a] / least, tree.half[b] / least, moved]), axis=0, return_inverse=True)
    order = np.argsort(kind.ravel(), kind="stable")
    ends = np.searchsorted(kind.ravel()[order], np.arange(len(kinds) + 1))
    for k, (ha, hb, *gap) in enumerate(kinds):
        here = order[ends[k]:ends[k + 1]]
        d2 = 0.0
        for j in range(d):
            one = (gap[j] + hb * places(p)[None, :] - ha * places(p)[:, None]) ** 2
            shape = [1] * (2 * d)
            shape[j], shape[d + j] = p, p
            d2 = d2 + one.reshape(shape)
        distance = np.sqrt(d2).reshape(p ** d, p ** d)
        for s in range(0, len(here), 256):
            some = here[s:s + 256]
            w = np.stack([weights[int(box)] for box in b[some]], axis=1).reshape(p ** d, -1)
            sums = (distance @ w).reshape(p ** d, len(some), labels) * least[some][None, :, None]
            out[at[some]] += np.moveaxis(sums, 1, 0)  # a box has one partner at most in each place
    return dict(zip(map(int, targets), out))


def leaves_per_call(leaves: int, cores: int, box_bytes: int) -> int:
    """How many neighbouring boxes one call scores."""
    return max(GROUP_LEAVES, min(leaves // (CALLS * cores), GROUP_BYTES // box_bytes, MOST_GROUP_LEAVES))


def silhouette_by_boxes(copies: Copies, labelings: int) -> DataFrame | None:
    """(gid, t, m, s) like `_silhouette_groups`; None for few, wide or incomplete rows and many labels, which are left to the tiles."""
    groups, d = copies.groups, width(copies.groups)
    if copies.n_groups < MIN_ROWS or d not in PLACES:
        return None
    coded = groups.select("m", F.posexplode("codes").alias("t", "code")).groupBy("t", "code").agg(F.sum("m").alias("size"))
    sizes = sorted((r["t"], r["code"], r["size"]) for r in coded.limit(MAX_LABELS + 1).collect())
    holes = [F.count_if(F.col("f")[j].isNull() | F.isnan(F.col("f")[j])).alias(f"h{j}") for j in range(d)]
    ends = groups.agg(*holes, *[f(F.col("f")[j]).alias(f"{n}{j}") for j in range(d) for n, f in (("a", F.min), ("b", F.max))]).first()
    if len(sizes) > MAX_LABELS or any(ends[f"h{j}"] for j in range(d)):
        return None
    low, high = (np.array([ends[f"{n}{j}"] for j in range(d)], dtype=float) for n in "ab")
    if not np.isfinite(high - low).all():
        return None
    known = [np.array([code for u, code, _ in sizes if u == t], dtype=np.int64) for t in range(labelings)]
    base = np.cumsum([0, *map(len, known)])
    size_of, labels, p, leaf_rows = np.array([float(n) for _, _, n in sizes]), len(sizes), PLACES[d], LEAF_ROWS[d]

    def columns_of(codes: np.ndarray) -> np.ndarray:
        return np.stack([base[t] + np.searchsorted(known[t], codes[:, t]) for t in range(labelings)], axis=1)

    def weights_of(codes: np.ndarray, m: np.ndarray) -> np.ndarray:
        out = np.zeros((len(m), labels))
        out[np.arange(len(m))[:, None], columns_of(codes)] = m[:, None]
        return out

    wanted = min(copies.n_groups, MAX_SAMPLE, max(SAMPLE_ROWS, SAMPLE_PER_LEAF * copies.n_groups // leaf_rows))
    share = wanted / copies.n_groups
    drawn = F.pmod(F.xxhash64(F.lit("tree"), "gid"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = list_matrix(groups.where(drawn).select("f").toArrow().column("f")).reshape(-1, d)
    whole = draw_tree(sample, low, high, leaf_rows * share)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = whole.leaf_of(list_matrix(batch.column("f")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    kinds = "gid bigint, f array<double>, codes array<bigint>, m bigint"
    tasks = max(4 * groups.sparkSession.sparkContext.defaultParallelism, copies.n_groups // (64 * BLOCK_ROWS))
    placed = groups.select("gid", "f", "codes", "m").mapInArrow(place, f"{kinds}, leaf int")
    rows = cut_lineage(placed.repartitionByRange(tasks, "leaf").sortWithinPartitions("leaf"), "leaves")
    counts = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}
    tree, number = trimmed(whole, counts)
    renumber = np.zeros(len(whole.half), dtype=np.int32)
    renumber[list(number)] = list(number.values())
    in_place = np.array(list(number.values()))
    size = leaves_per_call(len(in_place), groups.sparkSession.sparkContext.defaultParallelism, 8 * p ** d * labels)
    n_groups = math.ceil(len(in_place) / size)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([packed(s) for s in held.values()], pa.binary())], ["box", "s"])
            held.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, x = renumber[batch.column("leaf").to_numpy()], list_matrix(batch.column("f"))
            v = weights_of(list_matrix(batch.column("codes")), batch.column("m").to_numpy())
            for box in np.unique(leaf):
                here = np.nonzero(leaf == box)[0]
                some, below = 0.0, int(box)
                for s in range(0, len(here), BLOCK_ROWS):
                    at = here[s:s + BLOCK_ROWS]
                    some = some + _sums(tree.local(below, x[at]), v[at])
                for above in tree.up_from(below):
                    if above != below:
                        some = _apply([basis.T for basis in tree.steps(below, above)], some)
                        below = above
                    held[above] = held[above] + some if above in held else some
                if len(held) * p ** d * labels * 8 > HELD_BYTES:
                    yield flush()
        if held:
            yield flush()

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table.column("s").combine_chunks())
        return pa.table({"box": table.column("box")[:1], "s": pa.array([packed(total)], pa.binary())})

    weights = cut_lineage(rows.mapInArrow(up, "box int, s binary").groupBy("box").applyInArrow(add_up, "box int, s binary"), "weights")

    def leaves_of(group: int) -> np.ndarray:
        return in_place[group * size:(group + 1) * size]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = np.array([*number, -1])[np.argsort([*number.values(), len(tree.half)])]
        place_of = {int(new): int(o) for new, o in zip(sorted(number.values()), old)}
        for batch in batches:
            for group in batch.column("id").to_numpy():
                far, near = tree.lists(leaves_of(int(group)))
                boxes, leaves = np.unique(far[1]), [place_of[int(b)] for b in np.unique(near[1])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(boxes) + len(leaves), group, dtype=np.int32)), pa.array([*boxes, *leaves], pa.int32()),
                    pa.array([False] * len(boxes) + [True] * len(leaves))], ["group", "at", "near"])

    sent = groups.sparkSession.range(n_groups).mapInArrow(members, "group int, at int, near boolean").persist()
    calls = min(n_groups, 4096)
    moved = weights.join(F.broadcast(sent.where("not near").select(F.col("group").alias("call"), F.col("at").alias("box"))), "box").repartition(calls, "call")
    near_rows = rows.join(F.broadcast(sent.where("near").select("group", F.col("at").alias("leaf"))), "leaf").repartition(calls, "group")

    def score(here: pa.Table, there: pa.Table) -> pa.Table:
        group = here.column("group")[0].as_py()
        held = {}
        for box, s in zip(there.column("box").to_pylist(), there.column("s").combine_chunks() if there.num_rows else ()):
            held[box] = np.frombuffer(s.as_buffer(), np.float64).reshape(p ** d, labels)
        far, near = tree.lists(leaves_of(group))
        added = _far_sums(tree, far, held, labels) if far.shape[1] else {}
        del held
        here = here.combine_chunks()
        here = here.take(pa.array(np.argsort(here.column("leaf").to_numpy(), kind="stable")))
        leaf, x, codes = renumber[here.column("leaf").to_numpy()], list_matrix(here.column("f")), list_matrix(here.column("codes"))
        m, gid = here.column("m").to_numpy(), here.column("gid")
        v = weights_of(codes, m)
        rows_of = {int(b): np.nonzero(leaf == b)[0] for b in np.unique(leaf)}
        out = []
        for box in map(int, leaves_of(group)):
            around = [rows_of[int(b)] for b in near[1][near[0] == box]]
            path = list(tree.up_from(box))
            field = None
            for above, below in zip(path[::-1], [*path[::-1][1:], None]):
                if above in added:
                    field = added[above] if field is None else field + added[above]
                if field is not None and below is not None:
                    field = _apply(tree.steps(below, above), field)
            for s in range(0, len(rows_of[box]), BLOCK_ROWS):
                at = rows_of[box][s:s + BLOCK_ROWS]
                total = np.zeros((len(at), labels)) if field is None else _values(tree.local(box, x[at]), field)
                for other in around:
                    for r in range(0, len(other), BLOCK_ROWS):
                        of = other[r:r + BLOCK_ROWS]
                        gap = sq_distances(x[at], x[of])
                        total += np.sqrt(gap, out=gap) @ v[of]
                out.append((at, total))
        at, total = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
        own = columns_of(codes[at])
        tables = []
        for t in range(labelings):
            mine, n = own[:, t], len(at)
            size = size_of[mine]
            inner = total[np.arange(n), mine] / np.maximum(size - 1, 1)
            mean = total[:, base[t]:base[t + 1]] / size_of[base[t]:base[t + 1]]
            mean[np.arange(n), mine - base[t]] = np.inf
            other = mean.min(1)
            most = np.maximum(inner, other)
            s = np.where((size > 1) & (most > 0), (other - inner) / np.where(most > 0, most, 1.0), 0.0)
            tables.append(pa.table({
                "gid": gid.take(pa.array(at)), "t": pa.array(np.full(n, t)), "m": pa.array(m[at]),
                "s": pa.array(s, mask=np.full(n, len(known[t]) < 2))}))
        return pa.concat_tables(tables).combine_chunks()

    found = near_rows.groupBy("group").cogroup(moved.groupBy("call"))
    return found.applyInArrow(score, "gid bigint, t bigint, m bigint, s double")
