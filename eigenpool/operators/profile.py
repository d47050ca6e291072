"""Profile of a point set before clustering: moments, outliers, correlation, tendency, density."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eigenpool.functions.bands import hopkins_band
from eigenpool.functions.uniform import secret_seed, uniform
from eigenpool.functions.vectors import width
from eigenpool.operators.joins import first_per_group, join_groups
from eigenpool.operators.pairs import block_pairs, knn_groups
from eigenpool.operators.quantiles import exact_quantiles
from eigenpool.operators.tiles import build_blocks, fold_copies, list_matrix, sq_distances
from eigenpool.session import cut_lineage

# Limits and sample sizes of the profile.
Z_LIMIT, IQR_FACTOR, LISTED = 3.0, 1.5, 20
HIGH_CORRELATION, VARIANCE_SHARE = 0.8, 0.95
HOPKINS_LEAST_ROWS, HOPKINS_SHARE, HOPKINS_MOST = 10, 5, 50
DENSITY_NEIGHBOURS, SIGMA_ROWS = 5, 100
TINY = 1e-10
PAIRWISE_WIDTH = 32


def _moments(points: DataFrame) -> tuple[list[dict], int]:
    """Per feature mean, std, min, max, mean of |x| and missing count, in one aggregate."""
    d = width(points)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(d):
        x = F.col("f")[i]
        aggs += [
            F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"), F.avg(F.abs(x)).alias(f"abs{i}"),
            F.count_if(F.isnan(x) | x.isNull()).alias(f"gap{i}"),
        ]
    row = points.agg(*aggs).first()
    if not row["n"]:
        raise ValueError("no rows to profile")
    parts = ("mean", "std", "min", "max", "abs", "gap")
    return [{p: row[f"{p}{i}"] for p in parts} for i in range(d)], row["n"]


def basic_stats(points: DataFrame) -> DataFrame:
    """(feature, mean, std, min, max, n_samples, n_features, has_missing); population std."""
    stats, n = _moments(points)
    missing = any(s["gap"] for s in stats)
    nan = float("nan")
    rows = [
        (i, *[nan if s["gap"] else float(s[p]) for p in ("mean", "std", "min", "max")], n, len(stats), missing)
        for i, s in enumerate(stats)
    ]
    return points.sparkSession.createDataFrame(
        rows, "feature int, mean double, std double, min double, max double, "
        "n_samples bigint, n_features int, has_missing boolean"
    )


def variance_ratio(points: DataFrame) -> DataFrame:
    """One row: variance of all cells over their mean magnitude.

    The variance of all cells is the mean of the feature variances plus the variance of
    the feature means, so no cell is exploded.
    """
    stats, _ = _moments(points)
    spread = np.mean([s["std"] ** 2 for s in stats]) + np.var([s["mean"] for s in stats])
    value = float(spread / (np.mean([s["abs"] for s in stats]) + TINY))
    return points.sparkSession.createDataFrame([(value,)], "variance_ratio double")


def outlier_flags(points: DataFrame) -> DataFrame:
    """(id, zscore, iqr, combined): per row, does any feature stand out; missing cells never do."""
    stats, _ = _moments(points)
    d = len(stats)
    columns = [f"x{i}" for i in range(d)]
    quartiles = exact_quantiles(points.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)]), columns, [0.25, 0.75])
    z, q = [], []
    for i, (s, c) in enumerate(zip(stats, columns)):
        x = F.nanvl(F.col("f")[i], F.lit(None).cast("double"))
        if s["std"] and s["std"] > 0:
            z.append(F.coalesce(F.abs(x - F.lit(s["mean"])) / F.lit(s["std"]) > Z_LIMIT, F.lit(False)))
        low, high = quartiles[c]
        if low is not None:
            fence = IQR_FACTOR * (high - low)
            q.append(F.coalesce((x < F.lit(low - fence)) | (x > F.lit(high + fence)), F.lit(False)))
    either = lambda tests: reduce(lambda a, b: a | b, tests, F.lit(False))
    return points.select("id", either(z).alias("zscore"), either(q).alias("iqr")).withColumn(
        "combined", F.col("zscore") | F.col("iqr")
    )


def outlier_summary(flags: DataFrame) -> DataFrame:
    """One row: counts per method, their union and its percentage."""
    return flags.agg(
        F.count_if("zscore").alias("zscore_count"), F.count_if("iqr").alias("iqr_count"),
        F.count_if("combined").alias("combined_count"),
        (F.count_if("combined") / F.count(F.lit(1)) * 100).alias("outlier_percentage"),
    )


def listed_outliers(flags: DataFrame, method: str, n: int = LISTED) -> DataFrame:
    """The first ids flagged by 'zscore', 'iqr' or 'combined'."""
    return flags.where(F.col(method)).select("id").orderBy("id").limit(n)


def correlation_matrix(points: DataFrame) -> DataFrame:
    """(i, j, r): Pearson, both triangles; a constant feature gives NULL; no rows below two features."""
    d = width(points)
    spark = points.sparkSession
    if d < 2:
        return spark.createDataFrame([], "i int, j int, r double")
    if d <= PAIRWISE_WIDTH:
        cov = [
            F.covar_pop(F.col("f")[i], F.col("f")[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1, d)
        ]
        std = [F.stddev_pop(F.col("f")[i]).alias(f"s{i}") for i in range(d)]
        row = points.agg(*cov, *std).first()
        table = []
        for i in range(d):
            table.append((i, i, 1.0 if row[f"s{i}"] else None))
            for j in range(i + 1, d):
                scale = row[f"s{i}"] * row[f"s{j}"]
                r = row[f"c{i}_{j}"] / scale if scale else None
                table += [(i, j, r), (j, i, r)]
    else:
        matrix = Correlation.corr(points.select(array_to_vector("f").alias("v")), "v").first()[0].toArray()
        table = [
            (i, j, None if np.isnan(matrix[i, j]) else float(matrix[i, j])) for i in range(d) for j in range(d)
        ]
    return spark.createDataFrame(table, "i int, j int, r double")


def high_correlations(correlations: DataFrame, limit: float = HIGH_CORRELATION) -> DataFrame:
    return correlations.where((F.col("i") < F.col("j")) & (F.abs("r") > limit))


def pca_variance(points: DataFrame) -> DataFrame:
    """(component, ratio, running, n_components): ratios descending with their running sum.

    n_components is the first component whose running sum reaches the share, or 1 if none does.
    """
    d = width(points)
    model = PCA(k=d, inputCol="v", outputCol="p").fit(points.select(array_to_vector("f").alias("v")))
    ratios = model.explainedVariance.toArray()
    running = np.cumsum(ratios)
    reached = int(np.argmax(running >= VARIANCE_SHARE)) + 1
    rows = [(i, float(v), float(c), reached) for i, (v, c) in enumerate(zip(ratios, running))]
    return points.sparkSession.createDataFrame(rows, "component int, ratio double, running double, n_components int")


def cumulative_share(table: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Adds `running`: the running sum per group of a short ranked table."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn("running", F.sum(value).over(w))


def _two_nearest(probes: np.ndarray):
    def part(batches):
        best = np.full((len(probes), 2), np.inf)
        for batch in batches:
            if batch.num_rows:
                d2 = sq_distances(probes, list_matrix(batch.column("f")))
                best = np.sort(np.concatenate([best, d2], axis=1) if d2.shape[1] < 2 else
                               np.concatenate([best, np.partition(d2, 1, axis=1)[:, :2]], axis=1), axis=1)[:, :2]
        near = np.sqrt(best)
        where = np.repeat(np.arange(len(probes)), 2)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(near.ravel())], ["probe", "d"])

    return part


def second_nearest(points: DataFrame, probes: np.ndarray) -> DataFrame:
    """(probe, d): distance of each of a few probes to its second nearest row; one scan, no row shuffled."""
    near = points.select("f").mapInArrow(_two_nearest(probes), "probe bigint, d double")
    return first_per_group(near, ["probe"], ["d"], 2).where("rank = 2").select("probe", "d")


def hopkins(points: DataFrame, seed=None) -> DataFrame:
    """One row (hopkins, interpretation).

    Sampled rows and uniform probes of the bounding box are compared by their second
    nearest distance (for a sampled row the first is itself); too few rows give 0.5.
    """
    spark = points.sparkSession
    seed = secret_seed() if seed is None else seed
    stats, n = _moments(points)
    if n < HOPKINS_LEAST_ROWS:
        return spark.createDataFrame(
            [(0.5, "Too few samples for reliable Hopkins test")], "hopkins double, interpretation string"
        )
    m, d = min(n // HOPKINS_SHARE, HOPKINS_MOST), len(stats)
    chosen = points.orderBy(uniform(seed, "sample", F.col("id")), "id").limit(m).select("f").collect()
    cells = [
        F.lit(s["min"]) + uniform(seed, "probe", F.col("id"), j) * F.lit(s["max"] - s["min"]) for j, s in enumerate(stats)
    ]
    random = spark.range(m).orderBy("id").select(F.array(*cells).alias("f")).collect()
    probes = np.array([r["f"] for r in random] + [r["f"] for r in chosen], dtype=float).reshape(2 * m, d)
    far = second_nearest(points, probes)
    u = F.sum(F.when(F.col("probe") < m, F.col("d")))
    w = F.sum(F.when(F.col("probe") >= m, F.col("d")))
    return far.agg((u / (u + w + F.lit(TINY))).alias("hopkins")).withColumn(
        "interpretation", hopkins_band(F.col("hopkins"))
    )


def k_distances(points: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(id, kd): distance to the k-th neighbour, the row itself counted; k = min(5, n-1)."""
    groups = _group_k_distances(points, block_rows)
    return join_groups(points.select("id", "f"), groups.select("f", "m", "kd"), ["f"], "m").select("id", "kd")


def _group_k_distances(points: DataFrame, block_rows: int | None) -> DataFrame:
    copies = fold_copies(points)
    k = min(DENSITY_NEIGHBOURS, copies.n_rows - 1)
    near = knn_groups(copies, points, k, block_rows)
    far = near.groupBy("gid").agg(F.max("d").alias("kd"))
    return copies.groups.select("gid", "f", "m").join(far, "gid")


def suggested_sigma(points: DataFrame) -> DataFrame:
    """One row: median pair distance among the first 100 rows by id."""
    head = cut_lineage(points.orderBy("id").limit(SIGMA_ROWS), "head")  # blocks read it several times
    gaps = block_pairs(build_blocks(head.select("id", "f"), head.count(), key="id")).where(~F.isnan("d2")).select(F.sqrt("d2").alias("d"))
    return gaps.agg(F.percentile("d", F.lit(0.5)).alias("suggested_sigma"))


def density(points: DataFrame, block_rows: int | None = None) -> DataFrame:
    """One row (avg_neighbor_distance, density_variation, density_interpretation)."""
    groups = _group_k_distances(points, block_rows).persist()
    mean = groups.agg((F.sum(F.col("m") * F.col("kd")) / F.sum("m")).alias("v")).first()["v"]
    gap = F.col("kd") - F.lit(mean)
    out = groups.agg(
        F.lit(mean).alias("avg_neighbor_distance"),
        (F.sqrt(F.sum(F.col("m") * gap * gap) / F.sum("m")) / F.lit(mean + TINY)).alias("density_variation"),
    )
    return out.withColumn(
        "density_interpretation",
        F.when(F.col("density_variation") > 1, "High variation").otherwise("Uniform density"),
    )


def recommendations(facts: DataFrame) -> DataFrame:
    """(kind, message) from rows (hopkins, outlier_percentage, high_pairs, suggested_sigma, n_samples)."""

    def rule(kind, message):
        return F.struct(F.lit(kind).alias("kind"), message.alias("message"))

    def say(text, *args):
        return F.format_string(text, *args) if args else F.lit(text)

    # Rule limits and wording.
    rate, shown = F.col("outlier_percentage"), F.bround("outlier_percentage", 1)
    rules = F.array(
        F.when(F.col("hopkins") > 0.7, rule("success", say(
            "Data shows strong natural clustering tendency. Spectral clustering should work well!")))
        .when(F.col("hopkins") < 0.5, rule("warning", say(
            "Low cluster tendency detected. Consider if clustering is appropriate for this data."))),
        F.when(rate > 10, rule("warning", say(
            "High outlier rate (%.1f%%). Consider enabling Anomaly-Aware mode.", shown)))
        .when(rate > 5, rule("info", say("%.1f%% outliers detected. Results may be affected.", shown))),
        F.when(F.col("high_pairs") > 0, rule("info", say(
            "%d highly correlated feature pair(s) found. Consider PCA preprocessing.", F.col("high_pairs")))),
        rule("tip", say("Suggested Gaussian sigma based on data density: %.2f", F.bround(F.coalesce("suggested_sigma", F.lit(1.0)), 2))),
        F.when(F.col("n_samples") < 30, rule("warning", say(
            "Small sample size. Clustering results may be unstable.")))
        .when(F.col("n_samples") > 500, rule("info", say(
            "Large dataset. Computation may take longer with real HE backend."))),
    )
    kept = facts.withColumn("rules", F.filter(rules, lambda r: r.isNotNull()))
    others = [c for c in facts.columns if c not in ("hopkins", "outlier_percentage", "high_pairs", "suggested_sigma", "n_samples")]
    return kept.select(*others, F.explode("rules").alias("r")).select(*others, "r.kind", "r.message")


@dataclass(frozen=True)
class Profile:
    basic_stats: DataFrame
    variance_ratio: DataFrame
    hopkins: DataFrame
    outlier_flags: DataFrame
    outliers: DataFrame
    correlations: DataFrame
    high_correlations: DataFrame
    pca: DataFrame | None
    density: DataFrame
    suggested_sigma: DataFrame
    facts: DataFrame
    recommendations: DataFrame


def profile(points: DataFrame, seed=None, block_rows: int | None = None) -> Profile:
    """Every analysis over one cached copy of the points, and the advice drawn from them."""
    points = points.persist()
    flags = outlier_flags(points)
    parts = {
        "hopkins": hopkins(points, seed), "outliers": outlier_summary(flags), "sigma": suggested_sigma(points),
    }
    correlations = correlation_matrix(points)
    high = high_correlations(correlations)
    row = {name: part.first() for name, part in parts.items()}
    facts = points.sparkSession.createDataFrame(
        [(
            row["hopkins"]["hopkins"], row["outliers"]["outlier_percentage"], high.count(),
            row["sigma"]["suggested_sigma"], points.count(),
        )],
        "hopkins double, outlier_percentage double, high_pairs bigint, suggested_sigma double, n_samples bigint",
    )
    return Profile(
        basic_stats=basic_stats(points), variance_ratio=variance_ratio(points), hopkins=parts["hopkins"],
        outlier_flags=flags, outliers=parts["outliers"], correlations=correlations, high_correlations=high,
        pca=pca_variance(points) if width(points) > 1 else None, density=density(points, block_rows),
        suggested_sigma=parts["sigma"], facts=facts, recommendations=recommendations(facts),
    )


def profile_record(found: Profile) -> DataFrame:
    """(section, item, value, text): the whole profile as one table, a row for each number or message.

    Items of features, pairs and components carry their numbers, `r_0_1` say; listed outliers are their place and id.
    Nothing is collected: sections are small tables of their own, joined end to end.
    """

    def part(rows: DataFrame, section: str, cells: dict[str, Column | str], suffix: tuple[str, ...] = (), text: dict[str, str] | None = None) -> DataFrame:
        words = text or {}
        items = [
            F.struct(
                F.concat_ws("_", F.lit(name), *[F.col(c).cast("string") for c in suffix]).alias("item"),
                (F.col(cell) if isinstance(cell, str) else cell).cast("double").alias("value"),
                (F.col(words[name]) if name in words else F.lit(None).cast("string")).alias("text"))
            for name, cell in cells.items()
        ]
        return rows.select(F.lit(section).alias("section"), F.inline(F.array(*items)))

    def named(*names: str) -> dict[str, str]:
        return {n: n for n in names}

    sections = [
        part(found.basic_stats.where("feature = 0"), "basic", named("n_samples", "n_features", "has_missing")),
        part(found.basic_stats, "basic", named("mean", "std", "min", "max"), ("feature",)),
        part(found.variance_ratio, "basic", named("variance_ratio")),
        part(found.hopkins, "tendency", named("hopkins"), text={"hopkins": "interpretation"}),
        part(found.outliers, "outliers", named("zscore_count", "iqr_count", "combined_count", "outlier_percentage")),
        part(found.correlations, "correlation", {"r": "r"}, ("i", "j")),
        part(found.high_correlations, "high_correlation", {"r": "r"}, ("i", "j")),
        part(found.density, "density", named("avg_neighbor_distance", "density_variation"), text={"density_variation": "density_interpretation"}),
        part(found.suggested_sigma, "density", named("suggested_sigma")),
    ]
    first = Window.orderBy("id")  # over the few listed rows
    for method in ("zscore", "iqr", "combined"):
        listed = listed_outliers(found.outlier_flags, method).withColumn("place", F.row_number().over(first) - 1)
        sections.append(part(listed, "outliers", {method: "id"}, ("place",)))
    if found.pca is not None:
        sections.append(part(found.pca, "components", named("ratio", "running"), ("component",)))
        sections.append(part(found.pca.where("component = 0"), "components", named("n_components")))
    advice = found.recommendations.select(F.lit("advice").alias("section"), F.col("kind").alias("item"), F.lit(None).cast("double").alias("value"), F.col("message").alias("text"))
    return reduce(DataFrame.unionByName, [*sections, advice])


def value_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) over equal-width bins from the least to the greatest value; empty bins stay."""
    ends = df.agg(F.min(column).cast("double").alias("a"), F.max(column).cast("double").alias("b")).first()
    spark = df.sparkSession
    if ends["a"] is None:
        return spark.createDataFrame([], "bin int, low double, high double, n bigint")
    step = (ends["b"] - ends["a"]) / bins or 1.0
    place = F.least(F.floor((F.col(column) - F.lit(ends["a"])) / F.lit(step)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = frame.withColumns({
        "low": F.lit(ends["a"]) + F.col("bin") * F.lit(step), "high": F.lit(ends["a"]) + (F.col("bin") + 1) * F.lit(step)
    })
    return edges.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def frequency_audit(df: DataFrame, key: str, column: str, noise: float = 0.01, seed=None, step_digits: int = 0) -> DataFrame:
    """(stage, n_distinct, top_count): does the value distribution survive added noise?

    'raw' values, 'noised' ones to four digits, and 'recovered' ones rounded back to the
    known step of the data: equal counts there mean the noise hides nothing.
    """
    from eigenpool.functions.uniform import normal

    seed = secret_seed() if seed is None else seed
    value = F.col(column).cast("double")
    noised = value + F.lit(float(noise)) * normal(seed, F.col(key))
    stages = {"raw": value, "noised": F.round(noised, 4) + F.lit(0.0), "recovered": F.round(noised, step_digits) + F.lit(0.0)}
    cells = F.array(*[F.struct(F.lit(s).alias("stage"), v.alias("v")) for s, v in stages.items()])
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.stage", "c.v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("stage").agg(F.count(F.lit(1)).alias("n_distinct"), F.max("n").alias("top_count"))
