import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool.operators import prepare
from eigenpool.operators.joins import join_groups, with_position
from eigenpool.operators.quantiles import exact_quantiles
from eigenpool.sources import generate, owners

MESSY = [
    ("o", 0, "north", 7.5, -2.0), ("o", 1, "east", 0.25, float("nan")), ("o", 2, None, float("nan"), 6.0), ("o", 3, "west", 12.0, 9.5),
    ("o", 4, "north", -3.0, 0.0),
]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(MESSY, "owner string, id bigint, side string, depth double, shift double")


def test_adapt_fills_scales_and_drops_text(messy):
    points = prepare.adapt(messy).points.orderBy("id").collect()
    cells = np.array([r[3:] for r in MESSY])
    cells = np.where(np.isnan(cells), np.nanmean(cells, axis=0), cells)
    want = (cells - cells.mean(axis=0)) / cells.std(axis=0)
    assert np.allclose([p["f"] for p in points], want)


def test_adapt_is_fitted_per_owner_and_drops_columns_per_owner(spark):
    rows = [("a", i, float(i), None, 5.0) for i in range(4)] + [("b", 10 + i, None, float(2 * i), 7.0) for i in range(4)]
    made = prepare.adapt(spark.createDataFrame(rows, "owner string, id bigint, x double, y double, flat double"))
    z = (np.arange(4) - 1.5) / np.arange(4).std()
    found = {r["id"]: r["f"] for r in made.points.collect()}
    for i in range(4):
        assert found[i] == pytest.approx([z[i], 0.0]) and found[10 + i] == pytest.approx([z[i], 0.0])
    kept = {r["owner"]: r["columns"] for r in made.columns.collect()}
    assert kept == {"a": ["x", "flat"], "b": ["y", "flat"]}


def test_adapt_rejects_unequal_widths_and_reports_bad_owners(spark):
    shape = "owner string, id bigint, x double, y double"
    uneven = spark.createDataFrame([("a", 0, 1.0, 2.0), ("b", 1, 1.0, None)], shape)
    with pytest.raises(ValueError, match="differ"):
        prepare.adapt(uneven)
    bad = spark.createDataFrame([("a", 0, 1.0, 2.0), ("a", 1, 2.0, 2.0), ("b", 2, float("inf"), 1.0)], shape)
    made = prepare.adapt(bad)
    assert {r["owner"]: r["ok"] for r in made.status.collect()} == {"a": True, "b": False}
    assert made.points.select("owner").distinct().count() == 1
    with pytest.raises(ValueError, match="No numeric data"):
        prepare.adapt(spark.createDataFrame([("a", 0, "t", True)], "owner string, id bigint, x string, y boolean"))


def test_empty_rows_and_columns(spark):
    df = spark.createDataFrame(
        [("o", 0, None, float("nan"), None), ("o", 1, None, float("nan"), "t"), ("o", 2, 1, 2.0, None)],
        "owner string, id bigint, a int, b double, c string",
    )
    assert [r["id"] for r in prepare.drop_empty_rows(df).orderBy("id").collect()] == [1, 2]
    assert prepare.drop_empty_columns(df.withColumn("e", F.lit(None).cast("double"))).columns == df.columns


@pytest.mark.parametrize("kind", ["broadcast", "shuffle", "hot"])
def test_join_groups_is_whole_on_every_path(spark, kind):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("m"))
    limits = {"broadcast": {}, "shuffle": {"broadcast_bytes": 0}, "hot": {"broadcast_bytes": 0, "hot_rows": 200}}
    joined = join_groups(rows, groups, ["k"], "m", **limits[kind])
    assert joined.count() == 3000 and joined.select("id").distinct().count() == 3000
    assert joined.agg(F.max("m")).first()[0] == groups.agg(F.max("m")).first()[0]


def test_position_follows_the_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("v"))
    got = with_position(df.repartition(5), ["v"]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(1000))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_split_gives_the_remainder_to_the_last(spark):
    sizes = generate.split_parties(spark.range(11), 3, ["id"]).groupBy("party").count().orderBy("party").collect()
    assert [r["count"] for r in sizes] == [3, 3, 5]


@pytest.mark.parametrize("direct", [1_000_000, 50])
def test_quantiles_are_exact_also_beyond_the_direct_limit(spark, direct):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=700), np.full(400, 0.25), rng.exponential(50, size=301)])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["v"], shares, direct=direct)["v"]
    assert got == pytest.approx(list(np.quantile(v, shares)), rel=1e-12, abs=1e-12)


def test_owner_files_with_other_headers_and_bad_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text("x,y,note\n1,10,a\n2,,b\n\n3,30,c\n")
    (tmp_path / "two.csv").write_text("y,x,note\n40,4,7\n50,5,8\n")
    (tmp_path / "codes.csv").write_text("x,y,note\n8,12d,-1.#IND\n9,7F,5e-1\n#N/A N/A,0x1p3,-nan\n")
    (tmp_path / "text.csv").write_text("x,y\na,b\nc,d\n")
    (tmp_path / "ragged.csv").write_text("x,y\n1,2\n3,4,5\n")
    (tmp_path / "empty.csv").write_text("")
    codes = owners.read_owner_csvs(spark, [str(tmp_path / "codes.csv")]).rows
    assert codes.where("y is not null").count() == 0  # numbers with a suffix are codes
    assert [(r["x"], r["note"]) for r in codes.orderBy("id").collect()] == [(8.0, None), (9.0, 0.5), (None, None)]
    names = ["one", "two", "text", "ragged", "empty", "missing"]
    read = owners.read_owner_csvs(spark, [str(tmp_path / f"{n}.csv") for n in names])
    ok = {r["owner"]: r["ok"] for r in read.status.collect()}
    assert ok == {f"{n}.csv": n in ("one", "two") for n in names}
    assert [(r["id"], r["x"]) for r in read.rows.orderBy("id").collect()] == list(enumerate([1.0, 2.0, 3.0, 4.0, 5.0]))
    rows = {(r["owner"], r["x"]): (r["y"], r["note"]) for r in read.rows.collect()}
    assert rows == {("one.csv", 1.0): (10.0, None), ("one.csv", 2.0): (None, None), ("one.csv", 3.0): (30.0, None),
                    ("two.csv", 4.0): (40.0, 7.0), ("two.csv", 5.0): (50.0, 8.0)}


def test_pool_needs_equal_widths(spark):
    from helpers import frame

    two, three = frame(spark, [[1, 2]]), frame(spark, [[1, 2, 3]])
    assert sorted(r["owner"] for r in owners.pool_points([two, two]).collect()) == ["User_0", "User_1"]
    with pytest.raises(ValueError):
        owners.pool_points([two, three])
