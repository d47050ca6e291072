"""The eigen solver on many parts: against dense solutions, known spectra, and for what its plans shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool.operators import eigen, layout
from eigenpool.operators.components import components
from eigenpool.operators.tiles import build_blocks, fold_copies
from eigenpool.plans import cluster
from helpers import distances, frame, with_copies


def entries(spark, m):
    return spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i bigint, j bigint, m double")


def walk(spark, w):
    """(entries, masses) of the normalised weights."""
    mass = w.sum(1)
    m = w / np.sqrt(np.outer(mass, mass))
    return m, entries(spark, m), spark.createDataFrame([(i, float(v)) for i, v in enumerate(mass)], "key bigint, mass double")


def path(n):
    w = np.eye(n) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    return w


def test_components_of_paths_stars_and_single_nodes(spark):
    arcs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(501, 500), (502, 501)]
    nodes = sorted({x for a in arcs for x in a} | {900})
    both = arcs + [(b, a) for a, b in arcs] + [(x, x) for x in nodes]
    rng = np.random.default_rng(1)
    names = {x: int(v) for x, v in zip(nodes, rng.permutation(10_000)[: len(nodes)])}
    got = components(spark.createDataFrame([(names[a], names[b]) for a, b in both], "i bigint, j bigint")).collect()
    groups = [range(0, 61), range(100, 140), range(500, 503), [900]]
    want = {names[x]: min(names[y] for y in g) for g in groups for x in g}
    assert {r["key"]: r["component"] for r in got} == want and len(got) == len(want)


def test_fine_path_settles(spark):
    """Eigenvalues of a path crowd at 1, as those of any fine mesh do."""
    n = 150
    m, table, masses = walk(spark, path(n))
    vectors, values, residual = eigen.entries_eigen(table, n, 4, masses, block_rows=20)
    assert values == pytest.approx(list(np.linalg.eigvalsh(m)[::-1][:4]), abs=1e-9)
    assert values[0] == 1.0 and residual < 1e-6
    y = np.array([r["y"] for r in vectors.orderBy("key").collect()])
    assert np.abs(m @ y - y * values).max() < 1e-6
    assert np.allclose(y.T @ y, np.eye(4), atol=1e-8)


def test_components_are_deflated(spark):
    """Two components: two exact vectors of 1, and the next one found by the solver."""
    w = np.zeros((90, 90))
    w[:50, :50], w[50:, 50:] = path(50), path(40)
    m, table, masses = walk(spark, w)
    vectors, values, _ = eigen.entries_eigen(table, 90, 3, masses, block_rows=20)
    assert values == pytest.approx(list(np.linalg.eigvalsh(m)[::-1][:3]), abs=1e-9)
    y = np.array([r["y"] for r in vectors.orderBy("key").collect()])
    root = np.sqrt(w.sum(1))
    assert np.allclose(y[:50, 0], root[:50] / np.linalg.norm(root[:50])) and not y[50:, 0].any()
    assert np.allclose(y[50:, 1], root[50:] / np.linalg.norm(root[50:])) and not y[:50, 1].any()
    _, values, residual = eigen.entries_eigen(table, 90, 1, masses, block_rows=20)
    assert (values, residual) == ([1.0], 0.0)


def test_negative_and_repeated_values(spark):
    """A ring of even length has values from 1 down to -1, all but these two in pairs."""
    n = 48
    ring = np.roll(np.eye(n), 1, axis=0) + np.roll(np.eye(n), -1, axis=0)
    m, table, masses = walk(spark, ring)
    _, values, _ = eigen.entries_eigen(table, n, 5, masses, block_rows=10)
    assert values == pytest.approx([np.cos(2 * np.pi * j / n) for j in (0, 1, 1, 2, 2)], abs=1e-9)


def test_unsettled_raises(spark):
    _, table, _ = walk(spark, path(300))
    homes = spark.range(300).select(F.col("id").alias("key"), F.lit(0).alias("strip"))
    laid = layout.lay_out_graph(table, homes, 300, 1)
    parts = layout.pack_rows(homes.select("key", "strip", F.array().cast("array<double>").alias("known")), "strip", ["known"])
    with pytest.raises(ArithmeticError, match="settled after 1 cycles"):
        eigen.leading_pairs(eigen.graph_operator(laid), parts, 3, 300, 0, 1e-12, cycles=1)


def test_wanting_all_pairs(spark):
    points = frame(spark, with_copies(n=12, hot=4))
    x = np.array([r["f"] for r in points.orderBy("id").collect()])
    w = np.exp(-distances(x) ** 2 / 2)
    m = w / np.sqrt(np.outer(w.sum(1), w.sum(1)))
    solved = eigen.top_eigen(fold_copies(points), 1.0, 50, block_rows=3)
    assert solved.values == pytest.approx(list(np.linalg.eigvalsh(m)[::-1][: len(solved.values)]), abs=1e-8)
    assert len(solved.values) == len(np.unique(x, axis=0))


def test_one_row(spark):
    solved = eigen.top_eigen(fold_copies(frame(spark, [[1.0, 2.0]] * 5)), 1.0, 3)
    assert solved.values == [1.0]
    row = solved.vectors.first()
    assert (row["m"], row["degree"], row["y"]) == (5, 5.0, [pytest.approx(1 / np.sqrt(5))])


def exchanges(df):
    """The columns that each exchange of a plan moves, without those below a written table."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    return [next(x for x in lines[i + 1:] if "Project" in x or "Scan" in x or "Arrow" in x) for i, x in enumerate(lines) if " Exchange" in x]


def test_a_pass_moves_vectors_only(spark):
    points = frame(spark, np.random.default_rng(3).normal(size=(400, 3)))
    copies = fold_copies(points)
    blocks = build_blocks(copies.groups.select("gid", "f", "m"), copies.n_groups, block_rows=40)
    laid = layout.lay_out(blocks, np.inf, ["m"])
    assert laid.rows.count() >= 8 * 8
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (kept, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            one_pass = laid.product(laid.parts.select("part", F.col("m").alias("v")), lambda x, y, same: np.ones((len(x), len(y))))
            moved = exchanges(one_pass)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        assert moved and not any("f#" in m for m in moved)
        assert "Bucketed: true" in one_pass._jdf.queryExecution().executedPlan().toString()
    z = layout.unpack_rows(laid.parts.select("part", "n", "keys").join(one_pass, "part"), ["z"]).collect()
    assert all(r["z"] == [400.0] for r in z) and len(z) == 400


def test_graph_strips_take_many_products_between_exchanges(spark):
    n = 120
    m, table, _ = walk(spark, path(n))
    homes = spark.range(n).select(F.col("id").alias("key"), F.floor(F.col("id") / 30).cast("int").alias("strip"))
    laid = layout.lay_out_graph(table, homes, n, 4)
    assert laid.hops == layout.MAX_HOPS
    v = np.random.default_rng(2).normal(size=(n, 3))
    rows = spark.createDataFrame([(i, i // 30, [float(x) for x in v[i]]) for i in range(n)], "key bigint, strip int, v array<double>")
    parts = layout.pack_rows(rows, "strip", ["v"])
    operator = eigen.graph_operator(laid)
    read = lambda z: np.array([r["z"] for r in layout.unpack_rows(parts.select("part", "n", "keys").join(z, "part"), ["z"]).orderBy("key").collect()])
    assert np.allclose(read(operator.apply(parts.select("part", "n", "v"), 3)), m @ v)
    bound, degree = 0.7, 19
    a, b = (2 * m @ v - (bound - 1) * v) / (bound + 1), v
    for _ in range(degree - 1):
        a, b = 2 * (2 * m @ a - (bound - 1) * a) / (bound + 1) - b, a
    assert np.allclose(read(operator.filter(parts.select("part", "n", "v"), 3, degree, bound)), a, rtol=1e-9)


def test_knn_mode_on_separate_groups(spark):
    """As many components as clusters: the embedding is exact, one unit vector for each."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(40, 2)) * 0.2 + c for c in ((0, 0), (9, 0), (0, 9))])
    found = cluster.knn_embedding(frame(spark, x), 3, 1.0, neighbours=8, block_rows=16)
    y = np.array([r["y"] for r in found.rows.orderBy("id").collect()])
    assert found.values == [1.0] * 3 and found.residual == 0.0
    assert np.allclose(np.abs(y) @ np.ones(3), 1.0) and len(np.unique(y.round(9), axis=0)) == 3
