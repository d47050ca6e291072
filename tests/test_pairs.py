"""Pairwise operators against brute force, in one block and in many, with a third of the rows equal."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool.functions.vectors import rounded, rounded_entry
from eigenpool.operators import anomaly, boxes, distance_sums, eigen, entries, matrix, pairs, profile, quality, tiles
from eigenpool.operators.eigen import top_eigen
from eigenpool.operators.tiles import build_blocks, fold_copies, tile_plan
from eigenpool.plans.queries import QUERIES, SQL
from helpers import distances, frame, with_copies

BLOCKS = [2048, 17]


@pytest.fixture(scope="module", params=["narrow", "wide"])
def case(request, spark):
    x = with_copies() if request.param == "narrow" else with_copies(seed=1, n=120, d=30, hot=40)
    return x, frame(spark, x).repartition(4).persist()


def neighbours(d, k, include_self):
    out = {}
    for i in range(len(d)):
        order = sorted((d[i, j], j) for j in range(len(d)) if include_self or j != i)
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_distances(case, block_rows):
    x, points = case
    d2 = distances(x) ** 2
    radius = float(np.quantile(np.sqrt(d2), 0.3)) + 1e-6
    got = {(r["i"], r["j"]): r["d2"] for r in pairs.pair_distances(points, radius, block_rows).collect()}
    want = {(i, j): d2[i, j] for i in range(len(x)) for j in range(i + 1, len(x)) if d2[i, j] <= radius ** 2}
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)
    for r in pairs.distance_summary(points, block_rows).collect():
        row = np.delete(d2[r["id"]], r["id"])
        assert (r["n"], r["total"], r["most"]) == (len(row), pytest.approx(row.sum()), pytest.approx(row.max()))
        assert r["least"] == pytest.approx(row.min(), abs=1e-9)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(pairs, "PAIRS_AT_ONCE", 100)
    x = with_copies(seed=1, n=60, d=30, hot=20)
    ids = [7 if i in (3, 50) else None if i == 9 else i for i in range(60)]
    cells = [(i, None if at == 4 else [float("nan"), *map(float, r[1:])] if at == 30 else list(map(float, r))) for at, (i, r) in enumerate(zip(ids, x))]
    points = spark.createDataFrame(cells, "id bigint, f array<double>").repartition(4)
    d2 = distances(x) ** 2
    want = []
    for a, i in enumerate(ids):
        for b, j in enumerate(ids):
            if i is not None and j is not None and i < j:
                want.append((i, j, None if {a, b} & {4, 30} else pytest.approx(d2[a, b], abs=1e-9)))
    got = [tuple(r) for r in pairs.pair_distances(points, block_rows=block_rows).collect()]
    order = lambda r: (r[0], r[1], -1.0 if r[2] is None else r[2].expected if hasattr(r[2], "expected") else r[2])
    assert sorted(got, key=order) == sorted(want, key=order)
    near = pairs.pair_distances(points, 5.0, block_rows).collect()
    assert len(near) == sum(r[2] is not None and r[2].expected <= 25.0 for r in want)


def test_pair_query_lists_every_pair(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=8)], i % 3) for i in range(40)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.sql(SQL["pair_sq_distance"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["pair_sq_distance"](spark, str(tmp_path)).collect())
    assert len(got) == 40 * 39 // 2 and got == want


@pytest.mark.parametrize("block_rows", BLOCKS)
@pytest.mark.parametrize("include_self", [True, False])
def test_neighbours(case, block_rows, include_self):
    x, points = case
    want = neighbours(distances(x), 6, include_self)
    got = {}
    for r in pairs.knn_join(points, 6, include_self, block_rows).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nid"], r["d"]))
    assert len(got) == len(x)
    for i, rows in got.items():
        rows.sort(key=lambda r: r[0])
        assert [d for _, _, d in rows] == pytest.approx([d for d, _ in want[i]], abs=1e-9)
        assert [j for _, j, _ in rows] == [j for _, j in want[i]]


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_affinity(case, block_rows):
    x, points = case
    sigma = 1.0 if x.shape[1] < 8 else 4.0
    w = np.exp(-distances(x) ** 2 / (2 * sigma ** 2))
    copies = fold_copies(points)
    assert (copies.n_rows, copies.n_groups) == (len(x), len(np.unique(x, axis=0)))
    got = {r["gid"]: r for r in pairs.affinity_summary(copies, sigma, block_rows).collect()}
    for i, r in got.items():
        assert (r["degree"], r["squares"]) == pytest.approx((w[i].sum(), (w[i] ** 2).sum()))
    m = w / np.sqrt(np.outer(w.sum(1), w.sum(1)))
    for r in pairs.normalized_summary(copies, sigma, block_rows).collect():
        i = r["gid"]
        assert (r["total"], r["squares"], r["diagonal"]) == pytest.approx((m[i].sum(), (m[i] ** 2).sum(), m[i, i]))
    entries = pairs.affinity_entries(copies, sigma, 0.05, block_rows).collect()
    for r in entries:
        assert r["w"] == pytest.approx(w[r["i"], r["j"]], abs=1e-9)
    reps = list(got)
    assert len(entries) == sum(w[i, j] >= 0.05 for i in reps for j in reps)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_eigenpairs(case, block_rows):
    x, points = case
    sigma = 1.0 if x.shape[1] < 8 else 4.0
    w = np.exp(-distances(x) ** 2 / (2 * sigma ** 2))
    m = w / np.sqrt(np.outer(w.sum(1), w.sum(1)))
    copies = fold_copies(points)
    solved = top_eigen(copies, sigma, 3, block_rows=block_rows)
    assert solved.values == pytest.approx(list(np.linalg.eigvalsh(m)[::-1][:3]), abs=1e-8)
    by_row = {tuple(r["f"]): r["y"] for r in copies.groups.join(solved.vectors.select("gid", "y"), "gid").collect()}
    y = np.array([by_row[tuple(r)] for r in x])
    assert np.abs(m @ y - y * solved.values).max() < 1e-6
    assert np.allclose(np.abs(y[:, 0]), np.sqrt(w.sum(1) / w.sum()), atol=1e-7)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_local_outlier_factor(case, block_rows):
    x, points = case
    d, n = distances(x), len(x)
    near = neighbours(d, 20, False)
    kd = np.array([near[i][-1][0] for i in range(n)])
    lrd = np.array([1 / (np.mean([max(dist, kd[j]) for dist, j in near[i]]) + 1e-10) for i in range(n)])
    want = np.array([np.mean([lrd[j] for _, j in near[i]]) / lrd[i] for i in range(n)])
    got = {r["id"]: r["severity"] for r in anomaly.lof(points, block_rows=block_rows).collect()}
    assert np.allclose([got[i] for i in range(n)], want, rtol=1e-6)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_silhouette_and_density(case, spark, block_rows):
    x, _ = case
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 3, len(x))
    labels[7] = 9
    points = frame(spark, x, owners=labels)
    d, want = distances(x), []
    for i in range(len(x)):
        own = (labels == labels[i]).sum()
        if own == 1:
            want.append(0.0)
            continue
        a = d[i, labels == labels[i]].sum() / (own - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != labels[i])
        want.append((b - a) / max(a, b) if max(a, b) else 0.0)
    got = {r["id"]: r["silhouette"] for r in quality.silhouette_samples(points, "owner", block_rows).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-9)
    assert quality.mean_silhouette(points, "owner", block_rows).first()[0] == pytest.approx(np.mean(want))
    assert quality.silhouette_sampled(points, len(x), "owner").first()[0] == pytest.approx(np.mean(want))
    kd = np.sort(d, axis=1)[:, 4]
    near = profile.density(points, block_rows).first()
    assert near["avg_neighbor_distance"] == pytest.approx(kd.mean(), abs=1e-9)
    assert near["density_variation"] == pytest.approx(kd.std() / (kd.mean() + 1e-10), abs=1e-9)


def test_far_blocks_are_not_paired(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(60, 2)) + 1000 * c for c in range(5)])
    points = frame(spark, x).withColumnRenamed("id", "gid")
    blocks = build_blocks(points.drop("owner"), len(x), block_rows=20)
    every, near = tile_plan(blocks).count(), tile_plan(blocks, 10.0).count()
    assert near < every / 3


def test_degrees_invert_the_normalisation(spark):
    x = np.random.default_rng(12).uniform(size=(5, 2))
    w = np.exp(-distances(x) ** 2)
    table = spark.createDataFrame([(i, j, float(w[i, j])) for i in range(5) for j in range(5)], "i bigint, j bigint, w double")
    m = matrix.normalized_affinity(table)
    s = 1 / np.sqrt(w.sum(1))
    for r in m.collect():
        assert r["m"] == pytest.approx(w[r["i"], r["j"]] * s[r["i"]] * s[r["j"]])
    back = matrix.reconstruct_affinity(m.drop("w"), matrix.degree(table)).withColumnRenamed("w_back", "w")
    found = pairs.compare_tables(table, back, ["i", "j"], "w", atol=1e-5).first()
    assert found["all_close"] and found["identical"] and found["frobenius"] < 1e-10
    short = pairs.compare_tables(table, back.where("i < 4"), ["i", "j"], "w").first()
    assert not short["all_close"] and not short["identical"]


def boxed(n, d, seed):
    x = np.random.default_rng(seed).normal(size=(n, d))
    x[: n // 4] = x[0]
    x[-1] = 7.0
    return x


@pytest.mark.parametrize("n, d", [(700, 1), (900, 2)])
def test_sums_by_boxes(spark, monkeypatch, n, d):
    """Affinity sums of narrow rows never pair rows, and are those of all pairs."""
    monkeypatch.setattr(boxes, "MOST_SENT", 500)
    monkeypatch.setattr(boxes, "BLOCK_ROWS", 100)
    monkeypatch.setattr(pairs, "run_tiles", None)
    monkeypatch.setattr(eigen, "build_blocks", None)
    x = boxed(n, d, 5)
    copies = fold_copies(frame(spark, x).repartition(4))
    gids = np.array(sorted(r["gid"] for r in copies.groups.collect()))
    w = np.exp(-distances(x) ** 2 / 2)
    degree = w.sum(1)
    m = w / np.sqrt(np.outer(degree, degree))
    got = np.array(pairs.affinity_summary(copies, 1.0).orderBy("gid").select("degree", "squares").collect())
    assert np.allclose(got, np.stack([degree, (w * w).sum(1)], axis=1)[gids], rtol=1e-13, atol=0)
    got = np.array(pairs.normalized_summary(copies, 1.0).orderBy("gid").select("degree", "diagonal", "total", "squares").collect())
    assert np.allclose(got, np.stack([degree, 1 / degree, m.sum(1), (m * m).sum(1)], axis=1)[gids], rtol=1e-12, atol=0)
    solved = eigen.top_eigen(copies, 1.0, 4)
    assert solved.values == pytest.approx(list(np.linalg.eigvalsh(m)[::-1][:4]), abs=1e-10)
    y = np.array([r["y"] for r in solved.vectors.orderBy("gid").collect()])
    full = y[np.searchsorted(gids, [gids[np.all(x[gids] == row, axis=1)][0] for row in x])]
    assert np.abs(m @ full - full * solved.values).max() < 1e-7


def test_scattered_rows_are_left_to_tiles(spark):
    copies = fold_copies(frame(spark, np.random.default_rng(1).normal(size=(300, 2)) * 1000))
    assert boxes.lay_out_boxes(copies, 1.0, 10.0, ["m"]) is None


def test_rows_are_sent_a_bounded_number_of_times(spark, monkeypatch):
    """Many blocks share few cells: neither rows nor partial sums grow with the number of blocks."""
    monkeypatch.setattr(tiles, "STRIPS", 4)
    x = np.random.default_rng(8).normal(size=(600, 30))
    laid = build_blocks(frame(spark, x).select(F.col("id").alias("gid"), "f"), len(x), block_rows=20)
    assert laid.count >= 30
    tile = lambda a, b, same: {"gid": np.concatenate([a["gid"]] + [b["gid"]] * (not same)), "n": np.ones(len(a) + len(b) * (not same), int)}
    sums = tiles.run_tiles(laid, tile, "gid bigint, n bigint", total={"n": "sum"})
    got = {r["gid"]: (r["lines"], r["tiles"]) for r in sums.groupBy("gid").agg(F.count("n").alias("lines"), F.sum("n").alias("tiles")).collect()}
    assert len(got) == len(x) and all(lines <= 4 and n == laid.count for lines, n in got.values())


def test_missing_features_are_left_to_tiles(spark, monkeypatch):
    monkeypatch.setattr(boxes, "MOST_SENT", 500)
    points = frame(spark, np.random.default_rng(2).normal(size=(300, 2)))
    assert boxes.lay_out_boxes(fold_copies(points), 1.0, 10.0, ["m"]) is not None
    for hole in (None, float("nan")):
        gap = F.when(F.col("id") == 5, F.lit(hole).cast("double")).otherwise(F.col("f")[1])
        holed = points.withColumn("f", F.array(F.col("f")[0], gap))
        assert boxes.lay_out_boxes(fold_copies(holed), 1.0, 10.0, ["m"]) is None


@pytest.mark.parametrize("d", [1, 2, 3])
def test_silhouettes_by_boxes(spark, monkeypatch, d):
    monkeypatch.setattr(distance_sums, "MIN_ROWS", 100)
    monkeypatch.setattr(distance_sums, "LEAF_ROWS", {1: 16, 2: 16, 3: 24})
    monkeypatch.setattr(quality, "run_tiles", None)  # no rows are paired but those of neighbouring boxes
    rng = np.random.default_rng(d)
    x = rng.normal(size=(1500, d))
    x[:300], x[300:600], x[600:620] = x[:300] * 1e-6 + 3, x[300:600] * 1e-3 + 1, x[0]
    labels = np.where(np.arange(1500) < 300, "near", rng.integers(0, 3, 1500).astype(str)).astype(object)
    labels[3] = "alone"
    dist, want = distances(x), []
    for i in range(len(x)):
        own = labels == labels[i]
        a = dist[i, own].sum() / max(own.sum() - 1, 1)
        b = min(dist[i, labels == other].mean() for other in set(labels) - {labels[i]})
        want.append((b - a) / max(a, b) if own.sum() > 1 and max(a, b) > 0 else 0.0)
    points = frame(spark, x, owners=labels)
    got = {r["id"]: r["silhouette"] for r in quality.silhouette_samples(points, "owner").collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(want, abs=1e-6)
    assert quality.mean_silhouette(points, "owner").first()[0] == pytest.approx(np.mean(want), abs=1e-6)
    monkeypatch.setattr(distance_sums, "leaves_per_call", lambda leaves, cores, box_bytes: 50)
    again = {r["id"]: r["silhouette"] for r in quality.silhouette_samples(points, "owner").collect()}
    assert [again[i] for i in range(len(x))] == pytest.approx([got[i] for i in range(len(x))], abs=1e-12)


def test_calls_grow_with_the_boxes():
    box = 8 * 10 ** 3 * 3
    assert [distance_sums.leaves_per_call(n, 12, box) for n in (100, 3_600, 18_399, 10 ** 6)] == [16, 100, 511, 512]
    assert distance_sums.leaves_per_call(10 ** 6, 12, 64 * box) == 16


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_entries_are_scaled_and_compared_in_tiles(spark, monkeypatch, block_rows):
    copies = fold_copies(frame(spark, with_copies()))
    w = pairs.affinity_entries(copies, 0.6, 0.05, block_rows)
    table = pairs.affinity_entries(copies, 0.6, 0.05, block_rows).table.persist()
    m = matrix.normalized_affinity(w, copies="mj")
    want = {(r["i"], r["j"]): (r["w"], r["m"]) for r in matrix.normalized_affinity(table, copies="mj").collect()}
    assert {(r["i"], r["j"]): r["m"] for r in m.collect()} == {at: pytest.approx(v[1]) for at, v in want.items()}
    back = matrix.reconstruct_affinity(m.drop("w"), matrix.degree(w, copies="mj")).withColumnRenamed("w_back", "w")
    assert {(r["i"], r["j"]): r["w"] for r in back.collect()} == {at: pytest.approx(v[0]) for at, v in want.items()}
    monkeypatch.setattr(entries.TiledEntries, "table", None)  # neither listed nor joined
    found = pairs.compare_tables(w, back, ["i", "j"], "w").first()
    assert (found["n"], found["all_close"], found["identical"]) == (len(want), True, True)
    other = pairs.compare_tables(w, m.drop("w").withColumnRenamed("m", "w"), ["i", "j"], "w").first()
    gap = np.sqrt(sum((v[0] - v[1]) ** 2 for v in want.values()))
    assert (other["n"], other["all_close"], other["frobenius"]) == (len(want), False, pytest.approx(gap))
    degrees = {r["i"]: (r["degree"], r["n"]) for r in matrix.degree(w, copies="mj").collect()}
    assert degrees == {r["i"]: (pytest.approx(r["degree"]), r["n"]) for r in matrix.degree(table, copies="mj").collect()}


def test_entries_are_rounded_like_others(spark):
    rng = np.random.default_rng(4)
    halves = [(k + 0.5) / 10000 for k in range(-300, 300)]
    near = [float(np.nextafter(h, side)) for h in halves for side in (-9, 9)]
    wild = [0.0, -0.0, 0.00005, -0.00005, 1e-300, 123456.78905, 1e5 + 0.00005, 4e8, 1e15 + 0.3, 1e300, float("inf"), float("-inf"), float("nan"), None]
    values = [*halves, *near, *wild, *map(float, rng.normal(size=2000)), *map(float, 1e4 * rng.normal(size=2000))]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    shown = rows.select("v", rounded("v").cast("string").alias("a"), rounded_entry(F.col("v")).cast("string").alias("b")).collect()
    assert [(r["v"], r["b"]) for r in shown if r["a"] != r["b"]] == []


def test_tiles_leave_out_rows_beyond_reach():
    x = np.random.default_rng(5).uniform(0, 4, (400, 2))
    x[7, 1], x[300, 0] = np.nan, np.nan
    one, two = (tiles.Side(x[at], {"gid": np.arange(400)[at], "m": np.ones(200, dtype=int)}) for at in (slice(0, 200), slice(200, 400)))
    one.x[:, 0] /= 2
    reach = 0.5
    two.x[:, 0] = two.x[:, 0] / 2 + 2
    a, b = entries.in_room(one, two, reach)
    d2 = tiles.sq_distances(one.x, two.x)
    want = {(i, j + 200) for i, j in zip(*np.nonzero(d2 <= reach ** 2))}
    kept = tiles.sq_distances(a.x, b.x)
    assert {(a["gid"][i], b["gid"][j]) for i, j in zip(*np.nonzero(kept <= reach ** 2))} == want
    assert len(want) > 50 and len(a) < 100 and len(b) < 100
    assert [len(s) for s in entries.in_room(one, tiles.Side(two.x[:0], {"gid": np.arange(0)}), reach)] == [0, 0]
