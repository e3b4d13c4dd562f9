"""Run records, metric gate and the champion pointer."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow import schemas
from shopflow.functions import columns as C, fixed_values as fixed
from shopflow.operators import dedupe

CHAMPIONS = schemas.table(
    ("model", schemas.S, True), ("alias", schemas.S, True), ("version", schemas.S, True),
    ("promoted_at", schemas.TS),
)


def default_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.GATE_THRESHOLDS, schemas.THRESHOLDS)


def record_run(spark: SparkSession, model: str, version: str, run_id: str,
               params: dict, metrics: dict, now=None) -> DataFrame:
    """Rows to append to the run table: one per parameter and metric."""
    rows = [(model, version, run_id, "param", k, str(v)) for k, v in params.items()]
    rows += [(model, version, run_id, "metric", k, repr(float(v))) for k, v in metrics.items()]
    columns = schemas.RUNS.names[:-1]
    made = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    return made.withColumn("logged_at", C.stamp(now))


def metric_rows(model: str, version: str, run_id: str, metrics: DataFrame, now=None) -> DataFrame:
    """The columns of a one-row metrics table as run rows."""
    text = metrics.select([F.col(c).cast("string").alias(c) for c in metrics.columns])
    return text.unpivot([], metrics.columns, "key", "value").select(
        F.lit(model).alias("model"), F.lit(version).alias("version"),
        F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"), "key", "value",
        C.stamp(now).alias("logged_at"),
    )


def latest_version(runs: DataFrame) -> DataFrame:
    """Highest version per model, and the run of it that logged last.

    Versions that are whole numbers compare as numbers and are above all others, which
    compare as text. Runs that logged at the same time compare by run id.
    """
    newest = F.max(F.struct(F.col("version").try_cast("bigint").alias("_number"), "version", "logged_at", "run_id"))
    return runs.groupBy("model").agg(newest.alias("newest")).select(
        "model", "newest.version", "newest.run_id"
    )


def validate(runs: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Judge each model's latest version, one row per threshold.

    Of a metric that a run logged several times the newest value counts. A missing version
    or metric is a failure.
    """
    logged = runs.where("kind = 'metric'").select(
        "model", "run_id", F.col("key").alias("metric"), "logged_at",
        F.col("value").try_cast("double").alias("value"))
    values = dedupe.last_per_key(logged, ["model", "run_id", "metric"], ["logged_at"]).drop("logged_at")
    judged = thresholds.join(latest_version(runs), "model", "left").join(
        values, ["model", "run_id", "metric"], "left"
    )
    met = (
        F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold"))
        .when(F.col("op") == "<=", F.col("value") <= F.col("threshold"))
    )
    error = F.when(
        F.col("version").isNull(), F.concat(F.lit("model "), "model", F.lit(" was never run")),
    ).when(
        F.col("value").isNull(), F.concat(F.lit("run "), "run_id", F.lit(" has no number for "), "metric"),
    )
    return judged.select(
        "model", "version", "run_id", "metric", "op", "threshold", "value",
        F.coalesce(met, F.lit(False)).alias("passed"), error.alias("error"),
    )


def verdicts(validated: DataFrame) -> DataFrame:
    """One row per model: it passes when all its thresholds are met."""
    return validated.groupBy("model").agg(
        F.max("version").alias("version"), F.bool_and("passed").alias("passed"))


def promote(champions: DataFrame, validated: DataFrame, now=None) -> DataFrame:
    """Point each passing model's champion at its version; keep the pointer of the others."""
    passing = verdicts(validated).where("passed").select(
        "model", F.lit("champion").alias("alias"), "version", C.stamp(now).alias("promoted_at")
    )
    both = champions.withColumn("_new", F.lit(0)).unionByName(passing.withColumn("_new", F.lit(1)))
    return dedupe.last_per_key(both, ["model", "alias"], ["_new"]).drop("_new")


def summary(validated: DataFrame) -> DataFrame:
    """Whether all models passed, and how many did and did not."""
    return verdicts(validated).agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count_if("passed").alias("passed_models"),
        F.count_if(~F.col("passed")).alias("failed_models"),
    )


def replace_run(stored: DataFrame | None, rows: DataFrame, run_id: str) -> DataFrame:
    """The run table with the rows of one run, in place of what it logged before."""
    if stored is None:
        return rows
    return stored.where(F.col("run_id") != run_id).unionByName(rows)
