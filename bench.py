"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  folder of test tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    runs per query, the fastest counts (default 1)

A query runs from the raw files to its last row: every column of the result is computed
and dropped by the ``noop`` sink. Tables a query stores on the way are part of its time.
Arguments name the queries to time instead of the headline ones.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from shopflow.plans.queries import QUERIES

HEADLINE = [
    "silver_transactions", "expectation_report", "customers_scd1", "product_flags", "orphan_skus",
    "rfm_scores", "customer_facts", "customer_360", "daily_sales", "daily_new_returning",
    "daily_category_revenue", "daily_kpis", "weekly_sales", "forecast_metrics",
    "demand_forecast_all", "segment_silhouette", "keep_last", "normalise_raw",
    "transaction_profile", "preferred_store", "product_dimension", "error_exceptions",
    "stream_bronze", "stream_dedupe_keys", "stream_scd1",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query, so that the first timed one does not pay for starting the JVM.
    QUERIES["daily_kpis"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "lineitem_rows": lines,
        "daily_kpis_rows_per_sec": round(lines / seconds["daily_kpis"]) if "daily_kpis" in seconds else None,
    }))


if __name__ == "__main__":
    main()
