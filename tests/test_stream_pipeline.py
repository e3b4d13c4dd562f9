from pathlib import Path

import pytest
from rows import D, ts

from shopflow import schemas
from shopflow.operators import contracts, silver
from shopflow.plans import extract, layout, pipeline, retrain
from shopflow.sources import adapter, ingest, stage, versioned
from shopflow.streaming import stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    """Rows with a date: an extract by high-water mark never takes the others."""
    return adapter.transactions(spark, SF).where("invoice_date IS NOT NULL").cache()


def halves(raw):
    first = raw.where("invoice_date <= '1998-01-01'")
    second = raw.where("invoice_date > '1998-01-01'")
    return first, second


def test_bronze_stream_reads_each_file_once(spark, raw, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    seen = []
    for day, part in zip(("2024-01-01", "2024-01-02"), halves(raw)):
        ingest.land_parquet(part, landing, day)
        files = ingest.scan_stream(spark, landing, schemas.RAW_TRANSACTIONS)
        stream.append(ingest.with_lineage(files), table, checkpoint)
        seen.append(spark.read.parquet(table).count())
    stream.append(ingest.with_lineage(files), table, checkpoint)
    assert seen[1] == raw.count() and spark.read.parquet(table).count() == raw.count()
    assert spark.read.parquet(table).columns == schemas.RAW_TRANSACTIONS.names + schemas.LINEAGE.names


@pytest.mark.parametrize("splits", [1, 4])
def test_streamed_keys_equal_batch_keys(spark, raw, tmp_path, splits):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    for day, part in zip(("2024-01-01", "2024-01-02", "2024-01-03"), (*halves(raw), halves(raw)[0])):
        ingest.land_parquet(part, landing, day)
        files = ingest.with_lineage(ingest.scan_stream(spark, landing, schemas.RAW_TRANSACTIONS))
        stream.append(stream.silver_transactions(files, splits=splits), table, checkpoint)
    made = spark.read.parquet(table)
    keys = ["invoice_no", "stock_code"]
    want = silver.transactions(raw)
    assert made.count() == made.select(keys).distinct().count() == want.count()
    assert made.join(want, keys, "left_anti").count() == 0


def test_bounded_dedupe_drops_copies_within_the_delay(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    rows = [("1", "A", None, 1, ts(f"2024-01-01 10:0{i}"), D("1.00"), 1, "France") for i in range(3)]
    df = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_TRANSACTIONS))
    ingest.land_parquet(df, landing, "2024-01-01")
    files = ingest.scan_stream(spark, landing, schemas.RAW_TRANSACTIONS)
    made = stream.silver_transactions(files, watermark=("invoice_date", "1 day"))
    stream.append(made, table, checkpoint)
    assert spark.read.parquet(table).count() == 1


def test_scd1_takes_later_snapshots_and_repeats_safely(spark, tmp_path):
    base, checkpoint, landing = (str(tmp_path / n) for n in ("t", "cp", "landing"))
    schema = "customer_id long, tier string, _ingested_at timestamp"
    one = spark.createDataFrame([(1, "a", ts("2024-01-01")), (2, "a", ts("2024-01-01"))], schema)
    two = spark.createDataFrame([(1, "b", ts("2024-01-02")), (3, "b", ts("2024-01-02"))], schema)
    for day, part in (("2024-01-01", one), ("2024-01-02", two)):
        ingest.land_parquet(part, landing, day)
        files = ingest.scan_stream(spark, landing, one.schema)
        stream.upsert_scd1(files, base, one.schema, ["customer_id"], ["_ingested_at"], checkpoint)
    rows = {r.customer_id: r.tier for r in versioned.current(spark, base, one.schema).collect()}
    assert rows == {1: "b", 2: "a", 3: "b"}
    assert versioned.numbers(spark, base) == [0, 1]


@pytest.fixture(scope="module")
def lake(spark, raw, tmp_path_factory):
    """Two daily runs of extract and pipeline, then a retrain."""
    root = tmp_path_factory.mktemp("lake")
    landing, control, out = (str(root / n) for n in ("landing", "control", "out"))
    full = {
        "customers": ["phone string", "date_of_birth date", "registration_date date", "preferred_store_id string"],
        "products": ["cost_price decimal(10,2)", "weight_grams int", "is_active boolean",
                     "supplier_id string", "first_listed_date date"],
    }

    def widened(df, name):
        return df.selectExpr("*", *[f"CAST(NULL AS {c.split(' ', 1)[1]}) AS {c.split(' ', 1)[0]}" for c in full[name]])

    products = widened(adapter.products(spark, SF), "products")
    for day, part, customers in zip(
        ("2001-08-01", "2001-08-02"), (halves(raw)[0], raw), adapter.customer_snapshots(spark, SF)
    ):
        extract.transactions(part, landing, control, day)
        extract.snapshot(widened(customers, "customers"), "customers", landing, day)
        extract.snapshot(products, "products", landing, day)
        made = pipeline.run(spark, landing, out, adapter.AS_OF)
    verdict = retrain.run(spark, made, "1", "run-1", n_skus=None).collect()
    pipeline.gold_tables(spark, made, adapter.AS_OF)
    return made, verdict, landing, out


def test_pipeline_conserves_rows(spark, raw, lake):
    lake = lake[0]
    tx = pipeline.transactions(spark, lake)
    sides = [f(spark, lake).count() for f in (pipeline.cancelled, pipeline.quarantine, pipeline.rejected)]
    routed = silver.route_transactions(raw)
    assert sides == [routed.cancelled.count(), routed.quarantine.count(), routed.rejected.count()]
    assert tx.count() == silver.transactions(raw).count()
    assert tx.where("line_total IS NULL OR _ingested_at IS NULL").count() == 0


def test_customers_and_products_conserve_rows(spark, lake):
    lake = lake[0]
    read = lambda name: spark.read.option("recursiveFileLookup", True).parquet(lake.table("silver", name))
    people = spark.read.parquet(lake.table("bronze", "customers"))
    routed = silver.route_customers(people)
    assert read("quarantine_customers").count() == routed.quarantine.count() > 0
    assert read("rejected_customers").count() == routed.rejected.count() > 0
    assert pipeline.customers(spark, lake).where("_transformed_at IS NULL").count() == 0
    goods = spark.read.parquet(lake.table("bronze", "products"))
    assert read("rejected_products").count() == silver.route_products(goods).rejected.count() > 0
    metrics = {(r.table_name, r.rule): r for r in pipeline.rule_metrics(spark, lake).collect()}
    assert {t for t, _ in metrics} == set(pipeline.RULES)
    assert all(r.passed_rows + r.failed_rows == spark.read.parquet(lake.table("bronze", t)).count()
               for (t, _), r in metrics.items())


def test_a_landed_file_that_breaks_its_contract_stops_the_job(spark, tmp_path):
    bad = spark.createDataFrame([("X", 1)], "stock_code string, avg_unit_price int")
    ingest.land_parquet(bad, str(tmp_path / "products"), "2024-01-01")
    with pytest.raises(contracts.ContractError, match="missing column category.*avg_unit_price is int"):
        ingest.check_landed(spark, str(tmp_path / "products"), schemas.RAW_PRODUCTS)


def test_keys_must_be_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "customer_id long, v string")
    assert {r.customer_id for r in contracts.key_violations(df, ["customer_id"]).collect()} == {1, None}
    with pytest.raises(contracts.ContractError, match="customers"):
        contracts.check_keys(df, ["customer_id"], "customers")


def test_stored_keys_win_over_later_batches_and_a_repeat_changes_nothing(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    schema = "k string, o int, v string"
    for day, rows in (("2024-01-01", [("a", 2, "x"), ("a", 1, "y")]), ("2024-01-02", [("a", 0, "z"), ("b", 5, "w")])):
        ingest.land_parquet(spark.createDataFrame(rows, schema), landing, day)
        files = ingest.scan_stream(spark, landing, spark.createDataFrame(rows, schema).schema)
        stream.append_first(files, table, ["k"], ["o"], checkpoint)
    stored = ingest.scan(spark, table, spark.createDataFrame([], schema).schema)
    assert {(r.k, r.v) for r in stored.collect()} == {("a", "y"), ("b", "w")}
    assert versioned.numbers(spark, table, "batch=") == [0, 1]


def test_gold_tables_meet_their_contract(spark, lake):
    lake = lake[0]
    kpis = lake.published(spark, "gold", "daily_kpis")
    c360 = lake.published(spark, "gold", "customer_360")
    assert kpis.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DAILY_KPIS]
    assert c360.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.CUSTOMER_360]
    assert kpis.count() == kpis.select("report_date").distinct().count() > 0
    assert c360.count() == c360.select("customer_id").distinct().count() > 0
    assert c360.count() == pipeline.customers(spark, lake).count()
    assert c360.where("loyalty_tier = 'Platinum'").count() > 0


def test_segments_flow_back_into_customer_360(spark, lake):
    lake = lake[0]
    c360 = lake.published(spark, "gold", "customer_360")
    assert c360.where("rfm_recency_score IS NOT NULL AND customer_segment IS NULL").count() == 0
    assert c360.select("customer_segment").where("customer_segment IS NOT NULL").distinct().count() == 4


def test_retrain_writes_forecast_runs_and_verdict(spark, lake):
    lake, verdict = lake[0], lake[1]
    forecast = lake.published(spark, "gold", "demand_forecast")
    assert forecast.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DEMAND_FORECAST]
    skus = forecast.select("stock_code").distinct().count()
    skipped = lake.published(spark, "ml", "forecast_skipped").count()
    assert forecast.count() == 12 * skus
    assert skus + skipped == pipeline.transactions(spark, lake).select("stock_code").distinct().count()
    rows = {r.model: r for r in verdict}
    assert set(rows) == {"segmentation", "demand_forecast"} and rows["segmentation"].passed
    runs = lake.published(spark, "ml", "runs")
    assert {"silhouette_score", "mean_mape", "mean_mae", "n_skus_trained"} <= {r.key for r in runs.collect()}


def test_second_run_without_new_files_changes_nothing(spark, lake):
    made, _, landing, out = lake
    before = pipeline.transactions(spark, made).count()
    again = pipeline.run(spark, landing, out, adapter.AS_OF)
    assert again == made and pipeline.transactions(spark, again).count() == before


def test_a_repeated_retrain_gives_the_same_tables(spark, lake):
    made = lake[0]

    def state():
        runs = made.published(spark, "ml", "runs").drop("logged_at")
        champions = made.published(spark, "ml", "champions").drop("promoted_at")
        return sorted(map(tuple, runs.collect())), sorted(map(tuple, champions.collect()))

    before = state()
    again = retrain.run(spark, made, "1", "run-1")
    assert state() == before and again.count() == len(lake[1])


def test_full_refresh_builds_a_new_generation_and_keeps_the_models(spark, lake):
    made, _, landing, out = lake
    champions = made.published(spark, "ml", "champions").count()
    fresh = pipeline.run(spark, landing, out, adapter.AS_OF, mode="full_refresh")
    assert fresh.root.endswith("generation=1") and made.root.endswith("generation=0")
    assert pipeline.transactions(spark, fresh).count() == pipeline.transactions(spark, made).count()
    assert fresh.published(spark, "ml", "champions").count() == champions > 0
    c360 = fresh.published(spark, "gold", "customer_360")
    assert c360.where("rfm_recency_score IS NOT NULL AND customer_segment IS NULL").count() == 0


def test_a_refresh_that_stops_does_not_become_current(spark, lake, monkeypatch):
    made, _, landing, out = lake
    current = layout.open_layout(spark, out, "incremental")

    def broken(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline, "gold_tables", broken)
    with pytest.raises(RuntimeError):
        pipeline.run(spark, landing, out, adapter.AS_OF, mode="full_refresh")
    assert layout.open_layout(spark, out, "incremental") == current


def test_a_failed_gold_write_leaves_the_version_before(spark, tmp_path):
    base = str(tmp_path / "t")
    versioned.publish_next(spark.range(3), base)
    with pytest.raises(Exception):
        versioned.publish_next(spark.range(9).selectExpr("if(id = 8, raise_error('stop'), id) AS id"), base)
    assert versioned.current(spark, base).count() == 3
    for n in (4, 5):
        versioned.publish_next(spark.range(n), base)
    assert versioned.current(spark, base).count() == 5
    assert len(versioned.numbers(spark, base)) == 2


def test_jobs_leave_nothing_staged_and_run_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        with layout.job(spark):
            stored = stage.table(spark.range(3).selectExpr("timestamp_seconds(1700000000) AS t"), "x")
            path = stored.inputFiles()[0].removeprefix("file:")
            assert str(stored.selectExpr("to_date(t)").first()[0]) == "2023-11-14"
            assert Path(path).exists()
        assert not Path(path).exists()
        assert spark.conf.get("spark.sql.session.timeZone") == "Australia/Sydney"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_waiting_snapshots_are_taken_in_the_order_of_their_dates(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    blank = {"phone": None, "date_of_birth": None, "registration_date": None, "is_wholesaler": False,
             "preferred_store_id": None, "marketing_opt_in": True}
    people = [("2024-03-01", "Zora Old", "gold"), ("2024-03-02", "Abel New", "silver")]
    for day, name, tier in people:
        row = {"customer_id": 4, "full_name": name, "email": "four@mail.test", "loyalty_tier": tier, **blank}
        extract.snapshot(spark.createDataFrame([row], schemas.RAW_CUSTOMERS), "customers", landing, day)
        price = D("9.50") if tier == "gold" else D("1.25")
        item = ("TEA", "tea", "Drinks", price, None, None, True, None, None)
        extract.snapshot(spark.createDataFrame([item], schemas.RAW_PRODUCTS), "products", landing, day)
    line = ("77", "TEA", "tea", 2, ts("2024-03-02 10:00"), D("1.25"), 4, "France")
    source = spark.createDataFrame([line], ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_TRANSACTIONS))
    extract.transactions(source, landing, str(tmp_path / "control"), "2024-03-02")
    for mode in ("incremental", "full_refresh"):
        made = pipeline.run(spark, landing, out, "2024-03-05", mode=mode)
        customer = pipeline.customers(spark, made).collect()
        product = made.published(spark, "silver", "products").collect()
        assert [(r.full_name, r.loyalty_tier) for r in customer] == [("Abel New", "Silver")]
        assert [r.avg_unit_price for r in product] == [D("1.25")]
