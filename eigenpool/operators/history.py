"""Run log: append, list, summarise, compare, export, and data fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from eigenpool.operators.joins import first_per_group

RUN_SCHEMA = (
    "id bigint, ts timestamp, config map<string,string>, metrics map<string,double>, "
    "data_hash string, notes string, n_samples bigint, n_clusters bigint"
)
ROW_SCHEMA = "run_id bigint, id bigint, cluster int, y array<double>"
# Runs kept, fingerprint length, metrics where less is better.
KEPT_RUNS = 20
HASH_DIGITS = 12
LOWER_IS_BETTER = ("Davies-Bouldin Index",)
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, empty where nothing was written yet; anything else that can't be read is an error."""
    try:
        return spark.read.schema(schema).parquet(path).select(*[part.split(" ")[0] for part in schema.split(", ")])
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The kept runs of a history folder."""
    return kept_runs(_read(spark, f"{path}/runs", RUN_SCHEMA))


def read_run_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the kept runs; rows of dropped runs go with them."""
    kept = read_runs(spark, path).select(F.col("id").alias("run_id"))
    return _read(spark, f"{path}/rows", ROW_SCHEMA).join(F.broadcast(kept), "run_id", "left_semi")


def kept_runs(runs: DataFrame, keep: int = KEPT_RUNS, by: list[str] | None = None) -> DataFrame:
    """The newest runs by id, overall or per log when several logs share a table."""
    if not by:
        return runs.orderBy(F.desc("id")).limit(keep)
    return first_per_group(runs, by, [F.desc("id")], keep).drop("rank")


def next_run_id(runs: DataFrame) -> int:
    last = runs.agg(F.max("id").alias("id")).first()["id"]
    return 0 if last is None else last + 1


def add_run(path: str, config: dict, metrics: DataFrame, labels: DataFrame, data_hash: str, notes: str = "") -> int:
    """Append one run and its rows (id, cluster, y), and delete the files of runs no longer kept; single writer per history folder."""
    spark = labels.sparkSession
    run_id = next_run_id(_read(spark, f"{path}/runs", RUN_SCHEMA))
    facts = labels.agg(
        F.count(F.lit(1)).alias("n_samples"), F.countDistinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("n_clusters")
    ).first()
    scores = {r["metric"]: r["value"] for r in metrics.collect()}
    settings = {k: None if v is None else str(v) for k, v in config.items()}
    entry = [(run_id, settings, scores, data_hash, notes, facts["n_samples"], facts["n_clusters"])]
    shape = RUN_SCHEMA.replace("ts timestamp, ", "")
    order = [c.split(" ")[0] for c in ("id", "ts", "config", "metrics", "data_hash", "notes", "n_samples", "n_clusters")]
    run = spark.createDataFrame(entry, shape).withColumn("ts", F.current_timestamp()).select(*order)
    rows = labels.select(F.lit(run_id).cast("bigint").alias("run_id"), "id", "cluster", F.col("y"))
    rows.write.mode("append").partitionBy("run_id").parquet(f"{path}/rows")
    run.write.mode("append").partitionBy("id").parquet(f"{path}/runs")
    _delete_dropped(spark, path, run_id)
    return run_id


def _delete_dropped(spark: SparkSession, path: str, newest: int) -> None:
    """Deletes the folders of runs too old to be kept; a run's own folder goes last, so a broken delete is taken up again."""
    java = spark._jvm.org.apache.hadoop.fs
    root = java.Path(f"{path}/runs")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [entry.getPath().getName() for entry in files.listStatus(root)]
    for run_id in sorted(int(name[len("id="):]) for name in found if name.startswith("id=")):
        if run_id <= newest - KEPT_RUNS:
            files.delete(java.Path(f"{path}/rows/run_id={run_id}"), True)
            files.delete(java.Path(f"{path}/runs/id={run_id}"), True)


def clear_history(spark: SparkSession, path: str) -> None:
    """Empty history; the next run is number 0 again."""
    spark.createDataFrame([], RUN_SCHEMA).write.mode("overwrite").partitionBy("id").parquet(f"{path}/runs")
    spark.createDataFrame([], ROW_SCHEMA).write.mode("overwrite").partitionBy("run_id").parquet(f"{path}/rows")


def get_run(runs: DataFrame, run_id: int) -> DataFrame:
    return runs.where(F.col("id") == run_id)


def all_runs(runs: DataFrame) -> DataFrame:
    """Newest first."""
    return runs.orderBy(F.desc("id"))


def cluster_count(rows: DataFrame, by: str, label: str = "cluster") -> DataFrame:
    """Distinct labels per run without the noise label."""
    return rows.groupBy(by).agg(F.countDistinct(F.when(F.col(label) != -1, F.col(label))).alias("n_clusters"))


def _config_text(name: str, default: str) -> Column:
    """Absent keys show the default, keys present without a value show None."""
    present = F.map_contains_key("config", name)
    return F.when(present, F.coalesce(F.col("config")[name], F.lit("None"))).otherwise(F.lit(default))


def _seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


# The lines of a summary, the columns of the table, the sections of a report and the
# texts for what is missing, here and in the functions below.
def run_summary(runs: DataFrame) -> DataFrame:
    """(id, summary): a few lines of text per run; floats with four digits."""
    silhouette = F.col("metrics")["Silhouette Score"]
    score = F.when(F.size(F.map_keys("metrics")) > 0, F.concat(
        F.lit("  Silhouette: "), F.coalesce(F.format_string("%.4f", silhouette), F.lit("N/A")), F.lit("\n")
    )).otherwise(F.lit(""))
    text = F.concat(
        F.lit("Run #"), F.col("id").cast("string"), F.lit(" @ "), _seconds(F.col("ts")), F.lit("\n  k="),
        _config_text("k", "?"), F.lit(", σ="), _config_text("sigma", "?"), F.lit(", ε="), _config_text("epsilon", "None"),
        F.lit("\n  Backend: "), _config_text("backend", "mock"), F.lit("\n"), score,
    )
    return runs.select("id", text.alias("summary"))


def history_table(runs: DataFrame) -> DataFrame:
    """Display rows; a silhouette of 0 or none shows N/A."""
    silhouette = F.nullif(F.col("metrics")["Silhouette Score"], F.lit(0.0))
    shown = F.when(silhouette.isNull(), "N/A").otherwise(F.format_string("%.4f", silhouette))
    return runs.select(
        F.col("id").alias("ID"), _seconds(F.col("ts")).alias("Time"), _config_text("k", "?").alias("k"),
        _config_text("sigma", "?").alias("sigma"), _config_text("epsilon", "None").alias("epsilon"),
        shown.alias("Silhouette"), F.coalesce("n_samples", F.lit(0)).alias("Samples"),
    )


def run_pairs(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(run_1, run_2) with both runs' data; a pair with an unknown run has `error` set."""
    cols = ["config", "metrics", "data_hash"]
    first = runs.select(F.col("id").alias("run_1"), *[F.col(c).alias(f"{c}_1") for c in cols], F.lit(True).alias("has_1"))
    second = runs.select(F.col("id").alias("run_2"), *[F.col(c).alias(f"{c}_2") for c in cols], F.lit(True).alias("has_2"))
    both = pairs.join(first, "run_1", "left").join(second, "run_2", "left")
    known = F.col("has_1").isNotNull() & F.col("has_2").isNotNull()
    return both.withColumn("error", F.when(~known, F.lit("One or both runs not found"))).withColumn(
        "same_data", F.col("data_hash_1") == F.col("data_hash_2")
    ).drop("has_1", "has_2")


def _keys(name: str) -> Column:
    return F.explode(F.array_union(F.map_keys(f"{name}_1"), F.map_keys(f"{name}_2")))


def _equal_numbers(a: Column, b: Column) -> Column:
    """Both texts are plain numbers of one value, as 1 and 1.0 are."""
    number = lambda text: F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.coalesce(number(a) == number(b), F.lit(False))


def config_diff(paired: DataFrame) -> DataFrame:
    """(run_1, run_2, key, value_1, value_2) for settings that differ; a missing one is NULL.

    Numbers are compared by value.
    """
    keyed = paired.where(F.col("error").isNull()).select("run_1", "run_2", "config_1", "config_2", _keys("config").alias("key"))
    values = keyed.select(
        "run_1", "run_2", "key", F.col("config_1")[F.col("key")].alias("value_1"), F.col("config_2")[F.col("key")].alias("value_2")
    )
    return values.where(~F.col("value_1").eqNullSafe(F.col("value_2")) & ~_equal_numbers(F.col("value_1"), F.col("value_2")))


def metric_diff(paired: DataFrame) -> DataFrame:
    """(run_1, run_2, metric, value_1, value_2, delta, improvement, better).

    A missing metric counts as 0. `improvement` is value_2 > value_1 for every metric;
    `better` also knows the metrics where less is better. Neither holds where a value is NaN.
    """
    keyed = paired.where(F.col("error").isNull()).select("run_1", "run_2", "metrics_1", "metrics_2", _keys("metrics").alias("metric"))
    zero = F.lit(0.0)
    values = keyed.select(
        "run_1", "run_2", "metric", F.coalesce(F.col("metrics_1")[F.col("metric")], zero).alias("value_1"),
        F.coalesce(F.col("metrics_2")[F.col("metric")], zero).alias("value_2"),
    )
    gain = F.col("value_2") - F.col("value_1")
    turned = F.when(F.col("metric").isin(*LOWER_IS_BETTER), -gain).otherwise(gain)
    known = ~F.isnan("value_1") & ~F.isnan("value_2")
    return values.withColumns({"delta": gain, "improvement": known & (F.col("value_2") > F.col("value_1")), "better": known & (turned > 0)})


def compare_runs(runs: DataFrame, run_1: int, run_2: int) -> dict[str, DataFrame]:
    """Frames `same_data`, `config_diff` and `metric_diff` of two runs; unknown ids are an error."""
    pairs = runs.sparkSession.createDataFrame([(run_1, run_2)], "run_1 bigint, run_2 bigint")
    paired = run_pairs(runs, pairs)
    if paired.where(F.col("error").isNotNull()).count():
        raise ValueError("One or both runs not found")
    return {
        "same_data": paired.select("run_1", "run_2", "same_data"),
        "config_diff": config_diff(paired), "metric_diff": metric_diff(paired),
    }


def export_history_json(runs: DataFrame, path: str) -> None:
    """One JSON object per run."""
    runs.select(F.to_json(F.struct(*runs.columns), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def import_history_json(spark: SparkSession, path: str, schema: str = RUN_SCHEMA) -> tuple[DataFrame, int]:
    """The runs of an export and the id the next run gets."""
    runs = spark.read.schema(schema).json(path)
    return runs, next_run_id(runs)


def report_rows(metrics: DataFrame, config: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(section, line) from metrics(metric, value) and config(key, value), optionally per report key."""
    by = by or []
    settings = config.select(*by, F.lit("1. System Configuration").alias("section"), F.concat_ws(": ", F.col("key"), F.coalesce("value", F.lit("None"))).alias("line"))
    scores = metrics.select(
        *by, F.lit("2. Clustering Quality Metrics").alias("section"),
        F.concat_ws(": ", F.col("metric"), F.format_string("%.4f", F.col("value"))).alias("line"),
    )
    if by:
        silent = config.select(*by).distinct().join(metrics.select(*by).distinct(), by, "left_anti")
    else:
        silent = metrics.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    none = silent.select(*by, F.lit("2. Clustering Quality Metrics").alias("section"), F.lit("No metrics available.").alias("line"))
    return settings.unionByName(scores).unionByName(none)


def data_fingerprint(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(fingerprint): 12 hex digits over owner, row number and exact values of every row.

    Row hashes are summed in four exact slices, so the rows may be hashed anywhere and in
    any order; swapping two rows changes their numbers and with them the result.
    """
    text = F.concat_ws("|", F.col("owner"), F.col("id").cast("string"), F.concat_ws(",", F.transform("f", lambda v: v.cast("string"))))
    digest = F.md5(text.cast("binary"))
    slices = [
        F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"s{i}")
        for i in range(4)
    ]
    grouped = points.groupBy(*(by or []))
    sums = grouped.agg(*slices)
    whole = F.md5(F.concat_ws("|", *[F.col(f"s{i}") for i in range(4)]).cast("binary"))
    return sums.select(*(by or []), F.substring(whole, 1, HASH_DIGITS).alias("fingerprint"))
