"""Weekly job: segments, demand forecast, model gate."""

from pyspark.sql import DataFrame, SparkSession

from shopflow import schemas
from shopflow.functions import fixed_values as fixed
from shopflow.operators import forecast, gate, segment
from shopflow.plans import pipeline
from shopflow.plans.layout import Layout, job
from shopflow.sources import stage, versioned


def segmentation(spark: SparkSession, lake: Layout, version: str, run_id: str, now=None) -> DataFrame:
    """Write the segment of every customer; return the run rows."""
    c360 = lake.published(spark, "gold", "customer_360")
    features = segment.rfm_features(c360)
    standard = segment.standardise(segment.stored_histogram(features))
    assigned = segment.predict(standard, segment.fit(standard))
    segments = segment.assign(features, assigned, segment.label(assigned), run_id, now)
    versioned.publish_next(segments, lake.table("ml", "customer_segments"), schemas.CUSTOMER_SEGMENTS)
    params = {"n_clusters": len(fixed.SEGMENT_NAMES), "seed": fixed.KMEANS_SEED,
              "n_init": fixed.KMEANS_STARTS}
    return gate.record_run(spark, "segmentation", version, run_id, params, {}, now).unionByName(
        gate.metric_rows("segmentation", version, run_id, segment.silhouette(assigned), now)
    )


def demand_forecast(spark: SparkSession, lake: Layout, version: str, run_id: str,
                    n: int | None = None, now=None) -> DataFrame:
    """Write forecast, parameters and skipped SKUs; return the run rows."""
    weekly = stage.table(forecast.weekly_for(pipeline.transactions(spark, lake), n), "weekly-sales")
    versioned.publish_next(forecast.refit(weekly), lake.table("ml", "forecast_params"))
    stored = lake.published(spark, "ml", "forecast_params")
    rows = forecast.to_gold(forecast.predict(stored), version, run_id, now)
    versioned.publish_next(rows, lake.table("gold", "demand_forecast"), schemas.DEMAND_FORECAST)
    versioned.publish_next(forecast.skipped(weekly), lake.table("ml", "forecast_skipped"))
    fitted = forecast.fit(weekly, fixed.HOLDOUT_WEEKS)
    errors = forecast.metrics(forecast.backtest(weekly, fitted))
    params = {"n_skus": n or "all", "forecast_horizon_weeks": fixed.FORECAST_HORIZON_WEEKS,
              "train_cutoff_weeks": fixed.HOLDOUT_WEEKS}
    return gate.record_run(spark, "demand_forecast", version, run_id, params, {}, now).unionByName(
        gate.metric_rows("demand_forecast", version, run_id, errors, now)
    )


def validation(spark: SparkSession, lake: Layout, thresholds: DataFrame | None = None,
               now=None) -> DataFrame:
    """Judge the latest versions and move the champion pointers of those that pass."""
    runs = versioned.current(spark, lake.table("ml", "runs"), schemas.RUNS)
    judged = gate.validate(runs, thresholds or gate.default_thresholds(spark))
    pointers = lake.table("ml", "champions")
    champions = versioned.current(spark, pointers, gate.CHAMPIONS)
    if champions is None:
        champions = spark.createDataFrame([], gate.CHAMPIONS)
    versioned.publish_next(gate.promote(champions, judged, now), pointers)
    return judged


def run(spark: SparkSession, lake: Layout, version: str, run_id: str,
        n_skus: int | None = None, thresholds: DataFrame | None = None,
        now=None) -> DataFrame:
    """All three steps. Returns the verdict per threshold; a failing model stops nothing.

    A run that is repeated under its id replaces what it wrote before.
    """
    with job(spark):
        rows = stage.table(segmentation(spark, lake, version, run_id, now).unionByName(
            demand_forecast(spark, lake, version, run_id, n_skus, now)
        ), "run-rows")
        runs = lake.table("ml", "runs")
        stored = versioned.current(spark, runs, schemas.RUNS)
        versioned.publish_next(gate.replace_run(stored, rows, run_id), runs)
        return validation(spark, lake, thresholds, now)
