"""Neighbours of narrow rows by a tree of cuts: exact, across its parts too, and without pairing all rows."""

import numpy as np
import pyarrow as pa
import pytest

from eigenpool.operators import neighbours, pairs, profile
from eigenpool.operators.tiles import sq_distances
from helpers import distances, frame


def wanted(x, ids, k):
    d = distances(x)
    return {int(ids[i]): sorted((d[i, j], int(ids[j])) for j in range(len(x)))[:k] for i in range(len(x))}


def rows_of(kind, d, seed=3):
    """Rows on a grid tie at every distance; others lie on lines, a few far away; some come several times."""
    rng = np.random.default_rng(seed)
    if kind == "grid":
        x = rng.integers(0, 6, size=(260, d)).astype(float)
    else:
        x = rng.normal(size=(240, d)) * 100
        x[:, -1] = rng.integers(0, 4, size=240)
        x[:3] += 1e6
    x[rng.permutation(len(x))[:40]] = x[7]
    return x


@pytest.mark.parametrize("kind, d, part_rows", [("grid", 2, 20), ("lines", 2, 31), ("lines", 1, 9), ("grid", 3, 40), ("lines", 3, None)])
def test_neighbours_by_parts(spark, monkeypatch, kind, d, part_rows):
    """Every row's list is that of all pairs, ties by id, and no blocks are paired."""
    monkeypatch.setattr(pairs, "run_cells", None)
    x = rows_of(kind, d)
    ids = np.random.default_rng(1).permutation(len(x)) + 5
    want = wanted(x, ids, 6)
    got = {}
    for r in pairs.knn_join(frame(spark, x, ids=ids).repartition(4), 6, True, part_rows).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["d"], r["nid"]))
    assert got.keys() == want.keys()
    for i, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 7))
        assert [n for _, _, n in rows] == [n for _, n in want[i]]
        assert [v for _, v, _ in rows] == pytest.approx([v for v, _ in want[i]], abs=0)


def test_density_of_narrow_rows_pairs_no_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "run_cells", None)
    x = rows_of("lines", 2)
    kd = np.array([near[-1][0] for near in wanted(x, np.arange(len(x)), 5).values()])
    row = profile.density(frame(spark, x), block_rows=25).first()
    assert row["avg_neighbor_distance"] == pytest.approx(kd.mean())
    assert row["density_variation"] == pytest.approx(kd.std() / kd.mean())


def test_rows_with_a_missing_feature_are_left_to_the_tiles(spark):
    x = rows_of("lines", 2)
    x[50, 0] = np.nan
    copies = pairs.fold_copies(frame(spark, x))
    assert neighbours.nearest_by_parts(copies.groups.selectExpr("gid", "f", "array(gid) ids"), copies.groups, copies.n_groups, 5) is None


def test_work_of_a_row_does_not_grow_with_the_rows(monkeypatch):
    """Distances computed per row stay the same when there are sixteen times the rows."""
    seen = []
    monkeypatch.setattr(neighbours, "sq_distances", lambda a, b: seen.append(len(a) * len(b)) or sq_distances(a, b))

    def per_row(n):
        rng = np.random.default_rng(n)
        x = rng.uniform(-1e3, 1e4, (n, 2))
        gid = np.arange(n)
        part = neighbours._Part(pa.table({"gid": gid, "f": pa.array(list(x)), "ids": pa.array([[i] for i in gid])}), 5)
        seen.clear()
        i, _, _, _ = part.nearest(part.x, np.split(gid, part.start[1:]), np.full(n, np.inf))
        assert len(i) == 5 * n
        return sum(seen) / n

    few, many = per_row(2_000), per_row(32_000)
    assert many < 1.5 * few and many < 32_000 / 20


def test_parts_hold_about_equally_many_rows():
    """Even where most rows share a value."""
    rng = np.random.default_rng(0)
    x = np.stack([np.where(rng.random(20_000) < 0.7, 0.0, rng.normal(size=20_000) * 1e3), rng.normal(size=20_000)], axis=1)
    cuts = neighbours.draw_cuts(x[:3200], 64)
    sizes = np.bincount(cuts.part_of(x))
    assert sizes.sum() == len(x) and sizes.max() <= 2 * 64 * len(x) / 3200
