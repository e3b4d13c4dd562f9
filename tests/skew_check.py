"""Largest share of one task in every shuffle, with hot keys holding a third of the rows.

    python tests/skew_check.py [rows]

Builds transactions where one invoice, SKU, customer, country and second hold a third of
the lines, runs the operators and reads Spark's event log from a new scratch folder.
"""

import glob
import json
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TASKS = 32
WORTH_COUNTING = 100_000


def session(log_dir):
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", TASKS)
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )


def hot_transactions(spark, rows):
    def mixed(hot, cold):
        return F.when(F.col("id") % 3 == 0, hot).otherwise(cold)

    def text(prefix, column):
        return F.concat(F.lit(prefix), column.cast("string"))

    second = mixed(F.lit(1), F.col("id") % 1000 * 86400).cast("long")
    return spark.range(0, rows, 1, 16).select(
        mixed(F.lit("hot"), text("i", F.col("id") % 200_000)).alias("invoice_no"),
        mixed(F.lit("SKU1"), text("SKU", F.pmod(F.hash("id"), F.lit(5000)))).alias("stock_code"),
        F.lit("x").alias("description"),
        (F.col("id") % 7 + 1).cast("int").alias("quantity"),
        F.timestamp_seconds(second + 978_307_200).alias("invoice_date"),
        (F.col("id") % 100 / 10).cast("decimal(10,2)").alias("unit_price"),
        mixed(F.lit(1), F.col("id") % 50_000).cast("long").alias("customer_id"),
        mixed(F.lit("France"), text("c", F.col("id") % 20)).alias("country"),
    )


def shares(log_dir):
    """(operator, records, largest share of a task) per shuffle of some size."""
    operator, read = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/*"):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":
                stage = event["Stage Info"]["Stage ID"]
                operator[stage] = event["Properties"].get("operator")
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                metrics = event["Task Metrics"]["Shuffle Read Metrics"]
                read[event["Stage ID"]].append(metrics["Total Records Read"])
    for stage, records in sorted(read.items()):
        if sum(records) >= WORTH_COUNTING:
            yield operator.get(stage), sum(records), max(records) / sum(records)


def main():
    from shopflow.operators import dims, forecast, gold, joins, silver
    from shopflow.sources import ingest, stage

    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(log_dir)
    spark.sparkContext.setLogLevel("ERROR")
    raw = stage.table(hot_transactions(spark, rows), "raw")
    # Kept with all copies, so that the hot keys reach the operators after deduplication.
    tx = stage.table(silver.enrich_transactions(silver.route_transactions(raw).valid), "tx")
    products = stage.table(spark.range(5000).select(
        F.concat(F.lit("SKU"), F.col("id").cast("string")).alias("stock_code"),
        (F.col("id") % 9).cast("string").alias("category"),
    ), "products")
    cancelled = tx.limit(0).select("invoice_no", "invoice_date")

    def shuffled():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1m")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        return joins.lookup(tx, products, "stock_code")

    jobs = {
        "silver.transactions": lambda: silver.transactions(raw),
        "ingest.keep_last": lambda: ingest.keep_last(raw, ["stock_code"], ["invoice_date"]),
        "gold.daily_kpis": lambda: gold.daily_kpis(tx, cancelled, products),
        "gold.customer_facts": lambda: gold.customer_facts(tx, products, "2004-01-01"),
        "forecast": lambda: forecast.predict(forecast.refit(forecast.weekly_for(tx, None))),
        "dims.product_dimension": lambda: dims.product_dimension(tx),
        "dims.preferred_store": lambda: dims.preferred_store(tx, dims.stores(spark)),
        "ingest.profile": lambda: ingest.profile_transactions(tx),
        "joins.lookup shuffled": shuffled,
    }
    for name, job in jobs.items():
        spark.sparkContext.setLocalProperty("operator", name)
        job().write.format("noop").mode("overwrite").save()
    spark.stop()
    for name, records, share in shares(log_dir):
        print(f"{name:24s} {records:10,d} records, largest task {share:.0%}")


if __name__ == "__main__":
    main()
