"""Steps of the daily job that must not shuffle or write more than they need."""

import os

import pytest
from pyspark.sql import functions as F

from rows import D, ts
from shopflow import schemas
from shopflow.operators import contracts, dedupe, gold
from shopflow.plans import extract, layout
from shopflow.sources import ingest, partitions, stage
from shopflow.streaming import stream

TX = schemas.RAW_TRANSACTIONS


def tx_row(invoice, when, sku="A"):
    return (invoice, sku, "x", 1, ts(when), D("2.00"), 1, "EIRE")


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_only_keys_with_copies_are_compared(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(stream, "FEW_ROWS", 0)
    monkeypatch.setattr(stream, "MAX_SHARED", most)
    base, compared, first = str(tmp_path / "t"), [], dedupe.first_per_key

    def recorded(df, keys, order):
        compared.append(df.count())
        return first(df, keys, order)

    monkeypatch.setattr(dedupe, "first_per_key", recorded)

    def append(n, rows):
        stream.append_batch(spark.createDataFrame(rows, "k string, j int, o int"), n, base, ["k", "j"], ["o"], tail=2)

    append(0, [(f"{i}", 1, i) for i in range(100, 200)] + [("100", 1, 7), ("100", 2, 8), ("101", 1, 200), (None, 1, 3), (None, 1, 2)])
    append(1, [("100", 1, 1), ("300", 1, 5), ("300", 1, 4), ("301", 1, 6)])
    append(2, [("400", 1, 1)])
    stored = spark.read.option("recursiveFileLookup", True).parquet(base).collect()
    assert sorted((r.k or "", r.j, r.o) for r in stored) == sorted(
        [(f"{i}", 1, i) for i in range(101, 200)]
        + [("100", 1, 7), ("100", 2, 8), ("", 1, 2), ("300", 1, 4), ("301", 1, 6), ("400", 1, 1)])
    assert compared == ([6, 3] if most else [105, 4])


def test_new_rows_are_landed_without_a_copy_and_late_ones_compared(spark, tmp_path, monkeypatch):
    landing, control, staged, table = str(tmp_path / "l"), str(tmp_path / "c"), [], stage.table
    monkeypatch.setattr(stage, "table", lambda df, name: staged.append(name) or table(df, name))
    first = [tx_row("1", "2024-01-01"), tx_row("2", "2024-01-03")]
    later = [tx_row("3", "2024-01-03"), tx_row("2", "2024-01-03"), tx_row("4", "2024-01-05"), tx_row("4", "2024-01-05")]
    for rows, day in ((first, "2024-01-04"), (first + later, "2024-01-06")):
        extract.transactions(spark.createDataFrame(rows, TX), landing, control, day)
    assert "increment" not in staged
    extract.transactions(spark.createDataFrame(first + later, TX), landing, control, "2024-01-07")
    assert staged.count("increment") == 1
    found = ingest.scan(spark, f"{landing}/transactions", TX).collect()
    assert sorted(r.invoice_no for r in found) == ["1", "2", "2", "3", "4", "4"]


def test_swapped_partitions_are_written_once(spark, tmp_path, monkeypatch):
    base, apply, written = str(tmp_path / "t"), partitions._apply, set()

    def recorded(spark, base, schema, redo):
        for part in stage.children(spark, redo):
            written.update("/".join(f.split("/")[-2:]) for f in stage.children(spark, part) if f.endswith(".parquet"))
        apply(spark, base, schema, redo)

    monkeypatch.setattr(partitions, "_apply", recorded)
    rows = spark.range(20).selectExpr("id", "CAST(id % 3 AS int) AS p")
    for n in (3, 1):
        partitions.swap(rows.where(F.col("p") < n), base, rows.schema)
    there = {f"{os.path.basename(d)}/{f}" for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}
    assert len(there) == 3 and there <= written
    assert sorted(r.id for r in partitions.read(spark, base, rows.schema).collect()) == list(range(20))


def test_amounts_are_added_up_before_anything_is_stored(spark, monkeypatch):
    lines = spark.range(400).selectExpr(
        "CAST(id DIV 2 AS string) AS invoice_no", "CONCAT('S', id % 40) AS stock_code", "CAST(1 AS int) AS quantity",
        "CAST(DATE_ADD(DATE '2024-01-01', CAST(id % 4 AS int)) AS timestamp) AS invoice_date",
        "CAST(2 AS decimal(10,2)) AS unit_price", "CAST(2 AS decimal(12,2)) AS line_total", "id % 30 AS customer_id",
        "'EIRE' AS country")
    products = spark.range(30).selectExpr("CONCAT('S', id) AS stock_code", "CONCAT('T', id % 2) AS category")
    first = lines.groupBy("customer_id").agg(F.to_date(F.min("invoice_date")).alias("first_purchase_date"))
    staged, table = [], stage.table

    def recorded(df, name):
        made = table(df, name)
        staged.append(made.count())
        return made

    monkeypatch.setattr(gold.stage, "table", recorded)
    cancelled = lines.limit(0).select("invoice_no", "invoice_date")
    made = gold.daily_kpis(lines, cancelled, products, first=first).collect()
    assert max(staged) <= 12  # four days of two categories and none
    assert [(r.total_revenue, r.total_orders, r.unique_customers, r.total_units_sold, r.avg_unit_price) for r in made] == [
        (D("200.00"), 100, 15, 100, D("2.00"))] * 4
    assert sum(r.new_customers for r in made) == 30
    assert "Expand" not in gold.customer_facts(lines, products, "2024-02-01")._jdf.queryExecution().executedPlan().toString()


def test_jobs_store_times_that_scans_can_skip_by(spark, tmp_path):
    was, path = spark.conf.get("spark.sql.parquet.outputTimestampType"), str(tmp_path / "t")
    times = ["0001-01-01 00:00:00", "1582-10-10 00:00:00", "1899-12-31 23:59:59.999999", "9999-12-31 23:59:59.999999"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select("t", F.col("t").cast("timestamp").alias("at"))
    with layout.job(spark):
        rows.coalesce(1).write.parquet(path)
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == was
    back = spark.read.parquet(path)
    assert back.where("at = CAST(t AS timestamp)").count() == 4
    footer = spark.read.format("binaryFile").load(f"{path}/*.parquet").head().content
    import pyarrow as pa
    import pyarrow.parquet as pq
    assert pq.ParquetFile(pa.BufferReader(bytes(footer))).metadata.row_group(0).column(1).statistics.has_min_max


def test_copies_and_nulls_are_found_among_keys(spark):
    good = spark.createDataFrame([("1", "A"), ("1", "B")], "i string, s string")
    assert contracts.check_keys(good, ["i", "s"], "t") is good
    for bad in (good.union(good.limit(1)), spark.createDataFrame([("1", None)], good.schema)):
        with pytest.raises(contracts.ContractError):
            contracts.check_keys(bad, ["i", "s"], "t")
