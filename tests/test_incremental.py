"""Work that grows with the batch, not with the history."""

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import D, day, ts

from shopflow import schemas
from shopflow.operators import contracts, dims, gate, gold, segment, silver
from shopflow.plans import daily, extract, pipeline
from shopflow.sources import adapter, buckets, ingest, partitions, stage
from shopflow.streaming import stream

SF = "/root/testdata/sf0.001"
TX = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_TRANSACTIONS)


def tx_row(invoice, when, customer=1, sku="A", quantity=1):
    return (invoice, sku, None, quantity, ts(when), D("1.00"), customer, "France")


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "_redo" not in str(p)}


# ---- partitions -------------------------------------------------------------------------

SCHEMA = schemas.table(("k", schemas.L), ("v", schemas.S), ("part", schemas.I))


def part_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_swap_replaces_the_partitions_it_has_and_no_others(spark, tmp_path):
    base = str(tmp_path / "t")
    assert partitions.read(spark, base, SCHEMA) is None
    partitions.swap(part_rows(spark, [(1, "a", 1), (2, "a", 2)]), base, SCHEMA)
    before = files(base)
    partitions.swap(part_rows(spark, [(3, "b", 2), (4, "b", 3)]), base, SCHEMA)
    after = files(base)
    assert {p for p in before if "part=1" in p} == {p for p in after if "part=1" in p}
    assert {tuple(r) for r in partitions.read(spark, base, SCHEMA).collect()} == {(1, "a", 1), (3, "b", 2), (4, "b", 3)}


def test_what_a_crash_left_is_put_in_place(spark, tmp_path):
    base = str(tmp_path / "t")
    partitions.swap(part_rows(spark, [(1, "a", 1), (2, "a", 2)]), base, SCHEMA)
    whole, half = f"{base}/_redo/whole", f"{base}/_redo/half"
    part_rows(spark, [(9, "z", 2)]).write.partitionBy("part").parquet(whole)
    part_rows(spark, [(8, "y", 1)]).write.partitionBy("part").parquet(half)
    Path(half, "_SUCCESS").unlink()
    for p in Path(base, "part=2").glob("*.parquet"):
        p.unlink()  # the crash came after the old folder was gone
    assert {tuple(r) for r in partitions.read(spark, base, SCHEMA).collect()} == {(1, "a", 1), (9, "z", 2)}
    assert stage.children(spark, f"{base}/_redo") == []


# ---- silver -----------------------------------------------------------------------------


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    base, schema = str(tmp_path / "t"), schemas.table(("k", schemas.L), ("o", schemas.I), ("v", schemas.S))
    stream.merge_buckets(spark.createDataFrame([(k, 1, "old") for k in range(200)], schema), base, schema, ["k"], ["o"], 16)
    before = files(base)
    batch = spark.createDataFrame([(7, 2, "new"), (7, 0, "late"), (500, 1, "more")], schema)
    for _ in range(2):  # merging a batch again changes nothing
        stream.merge_buckets(batch, base, schema, ["k"], ["o"], 16)
        rows = {r.k: r.v for r in partitions.read(spark, base, stream.bucketed(schema)).collect()}
        assert len(rows) == 201 and rows[7] == "new" and rows[500] == "more" and rows[8] == "old"
    kept = set(before.items()) & set(files(base).items())
    assert 14 <= len(kept) < len(before) == 16


def test_a_batch_opens_only_files_that_may_hold_its_keys(spark, tmp_path, monkeypatch):
    base, opened = str(tmp_path / "t"), []
    read = stream.stored_rows

    def recorded(*args):
        rows = read(*args)
        rows.collect()
        scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
        opened.append(scan.metrics().get("numFiles").get().value())
        return rows

    monkeypatch.setattr(stream, "stored_rows", recorded)
    schema = "k string, o int, v string"

    def append(n, rows):
        stream.append_batch(spark.createDataFrame(rows, schema), n, base, ["k"], ["o"], tail=3)

    append(0, [(f"{i}", 1, "first") for i in range(1000, 9000, 10)])
    append(1, [(f"{i}", 1, "second") for i in range(8000, 8990, 5)] + [("12", 1, "short")])
    append(2, [("8000", 0, "late"), ("8003", 2, "x"), ("8003", 1, "new"), ("12", 0, "late"), ("", 1, "blank")])
    assert len(files(base)) > 9 and max(opened) <= 4 and len(opened) == 2
    stored = {r.k: r.v for r in spark.read.option("recursiveFileLookup", True).parquet(base).collect()}
    assert (stored["8000"], stored["8005"], stored["8003"], stored["12"], stored[""]) == (
        "first", "second", "new", "short", "blank")
    assert len(stored) == 800 + 99 + 3
    append(2, [("8003", 1, "new")])  # a repeated batch replaces its own rows only
    assert spark.read.option("recursiveFileLookup", True).parquet(base).count() == 800 + 99 + 2


def test_a_batch_with_keys_of_many_parts_is_compared_with_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "MAX_PARTS", 2)
    base, schema = str(tmp_path / "t"), "k string, o int"
    for n in range(2):
        stream.append_batch(spark.createDataFrame([(f"{i}00", n) for i in range(5 + n)], schema), n, base, ["k"], ["o"], tail=2)
    assert spark.read.option("recursiveFileLookup", True).parquet(base).count() == 6


def test_many_parts_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "FEW_PARTS", 4)
    base = str(tmp_path / "t")
    rows = [(f"{i}00", 1) for i in range(100, 140)]
    stream.append_batch(spark.createDataFrame(rows, "k string, o int"), 0, base, ["k"], ["o"], tail=2)
    assert len(files(base)) == 40
    assert len({f.rpartition("/")[2].split("-")[1] for f in files(base)}) > 1  # numbers of the tasks


def test_few_parts_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    base, schema = str(tmp_path / "t"), "k string, o int"
    first, second = (spark.createDataFrame([(f"{i}", n) for i in range(100, 140 + n)], schema) for n in range(2))

    def shuffled(*args):
        raise AssertionError("shuffled once more by part, of which there may be a single one")

    monkeypatch.setattr(type(first), "repartition", shuffled)
    for n, batch in enumerate((first, second)):
        stream.append_batch(batch, n, base, ["k"], ["o"], tail=2)
    stored = spark.read.option("recursiveFileLookup", True).parquet(base)
    assert sorted((r.k, r.o) for r in stored.collect()) == [(f"{i}", 0) for i in range(100, 140)] + [("140", 1)]


def test_counts_ride_along_with_the_write(spark, tmp_path):
    rules = {"positive": "quantity > 0", "known": "customer_id IS NOT NULL"}
    rows = [tx_row("1", "2024-01-01"), tx_row("2", "2024-01-01", None), tx_row("3", "2024-01-01", 5, quantity=-1)]
    df = spark.createDataFrame(rows, TX)
    watched, seen = contracts.watch_rules(df, rules)
    watched.where("quantity > 0").write.parquet(str(tmp_path / "t"))  # rows that a later filter drops count too
    got = contracts.watched_report(spark, seen, rules)
    want = contracts.expectation_report(df, rules)
    assert set(got.collect()) == set(want.collect()) and got.dtypes == want.dtypes
    kept, before, after = ingest.keep_last_counted(
        spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, o int"), ["k"], ["o"])
    kept.write.parquet(str(tmp_path / "k"))
    assert (before.get["rows"], after.get["rows"]) == (3, 2)


# ---- landing ----------------------------------------------------------------------------


def landed(spark, landing):
    return sorted(r.invoice_no for r in ingest.scan(spark, f"{landing}/transactions", schemas.RAW_TRANSACTIONS).collect())


def test_late_rows_land_once_whatever_is_repeated(spark, tmp_path):
    landing, control = str(tmp_path / "landing"), str(tmp_path / "control")

    def run(rows, run_date):
        extract.transactions(spark.createDataFrame(rows, TX), landing, control, run_date, overlap="2 DAY")

    first = [tx_row("1", "2024-01-01"), tx_row("2", "2024-01-03"), tx_row("2", "2024-01-03")]
    run(first, "2024-01-04")
    late = [tx_row("3", "2024-01-03"), tx_row("4", "2024-01-02 12:00"), tx_row("2", "2024-01-03")]
    run(first + late, "2024-01-05")
    assert landed(spark, landing) == ["1", "2", "2", "2", "3", "4"]
    run(first + late, "2024-01-05")
    run(first + late + [tx_row("5", "2024-01-03")], "2024-01-05")  # no newer row, so no newer mark
    old = tx_row("0", "2023-12-01")  # older than the overlap
    run(first + late + [tx_row("5", "2024-01-03"), tx_row("6", "2024-01-09"), old], "2024-01-10")
    assert landed(spark, landing) == ["1", "2", "2", "2", "3", "4", "5", "6"]


def test_a_run_repeated_on_another_day_lands_nothing_twice(spark, tmp_path):
    landing, control = str(tmp_path / "landing"), str(tmp_path / "control")
    source = spark.createDataFrame([tx_row("1", "2024-01-01"), tx_row("2", "2024-01-02")], TX)
    ingest.land_parquet(source, f"{landing}/transactions", "2024-01-03", "crashed")  # its mark was not stored
    extract.transactions(source, landing, control, "2024-01-04")
    assert landed(spark, landing) == ["1", "2"]


def test_what_was_read_leaves_the_landing_folder(spark, tmp_path):
    landing, archive, table, checkpoint = (str(tmp_path / n) for n in ("landing", "archive", "table", "cp"))
    schema = spark.createDataFrame([], "a int").schema
    for n in range(3):
        ingest.land_parquet(spark.range(10 * n, 10 * n + 10).selectExpr("CAST(id AS int) AS a").repartition(2),
                            landing, f"2024-01-0{n + 1}")
        stream.append(ingest.scan_stream(spark, landing, schema, max_files=1, archive=archive), table, checkpoint)
    assert sorted(r.a for r in spark.read.parquet(table).collect()) == list(range(30))
    left = files(landing)
    assert len(left) + len(files(archive)) == 6 and len(left) <= 1
    query = stream.append(ingest.scan_stream(spark, landing, schema, max_files=1, archive=archive), table, checkpoint)
    assert not query.exception() and spark.read.parquet(table).count() == 30


def test_a_bad_folder_is_listed_not_read_and_read_once_repaired(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), pipeline.open_layout(spark, str(tmp_path / "out"), "incremental")
    good = spark.createDataFrame([tx_row("1", "2024-01-01")], TX)
    bad = good.withColumn("quantity", F.lit("many")).drop("country")
    for name, rows in (("customers", schemas.RAW_CUSTOMERS), ("products", schemas.RAW_PRODUCTS)):
        ingest.land_parquet(spark.createDataFrame([], rows), f"{landing}/{name}", "2024-01-01")

    def bronze():
        pipeline.bronze(spark, landing, lake)
        return spark.read.parquet(lake.table("bronze", "transactions")).count()

    ingest.land_parquet(bad, f"{landing}/transactions", "2024-01-01")
    ingest.land_parquet(good, f"{landing}/transactions", "2024-01-02")
    assert bronze() == 1
    listed = pipeline.quarantined(spark, lake, "transactions").collect()
    assert [r.folder.rpartition("=")[2] for r in listed] == ["2024-01-01"]
    assert "missing column country" in listed[0].problems and "quantity is string" in listed[0].problems
    ingest.land_parquet(good, f"{landing}/transactions", "2024-01-01")
    assert bronze() == 2 and pipeline.quarantined(spark, lake, "transactions").count() == 0


# ---- daily KPIs -------------------------------------------------------------------------


def clean(rows, spark):
    return silver.transactions(spark.createDataFrame(rows, TX))


def kpi_rows(df):
    return sorted(map(tuple, df.drop("_rebuilt_at").collect()))


PRODUCTS = [("A", "Tea"), ("B", "Coffee")]


def test_touched_days_give_what_all_days_give(spark, tmp_path):
    base = str(tmp_path / "daily")
    products = spark.createDataFrame(PRODUCTS, "stock_code string, category string")
    sales = [
        [tx_row("1", "2024-01-10", 1), tx_row("2", "2024-03-01", 2), tx_row("3", "2024-03-01", 1, "B", 5)],
        # Customer 2 turns out to have come in January: the first of March loses a new customer.
        [tx_row("4", "2024-01-20", 2), tx_row("5", "2024-05-05", 3)],
        [tx_row("6", "2024-05-05", 3, "B", 9)],
    ]
    gone = [[("C9", ts("2024-03-01"))], [("C8", ts("2024-02-02"))], [("C7", ts("2024-01-10"))]]
    seen, cancelled = [], []
    for n in range(3):
        seen += sales[n]
        cancelled += gone[n]
        lines, out = clean(seen, spark), spark.createDataFrame(cancelled, "invoice_no string, invoice_date timestamp")
        new = daily.sold_and_cancelled(clean(sales[n], spark), out.where(F.col("invoice_no").isin([i for i, _ in gone[n]])))
        before = files(f"{base}/by_month")
        for _ in range(2):  # the second time is a batch repeated after a crash
            daily.advance(base, n, new, lines, out, products)
        assert kpi_rows(daily.kpis(spark, base)) == kpi_rows(gold.daily_kpis(lines, out, products))
        if n == 1:
            kept = {p for p in before if p in files(f"{base}/by_month")}
            assert kept == set()  # January and March are touched
        if n == 2:
            assert any("_month=202403" in p for p in before if p in files(f"{base}/by_month"))
    later = spark.createDataFrame([("A", "Tea"), ("B", "Cocoa")], "stock_code string, category string")
    changed = daily.changed_category(products, later)
    assert [r.stock_code for r in changed.collect()] == ["B"]
    days = lines.join(changed, "stock_code", "left_semi").select(F.to_date("invoice_date")).distinct()
    daily.recompute(spark, base, [r[0] for r in days.collect()], lines, out, later)
    assert kpi_rows(daily.kpis(spark, base)) == kpi_rows(gold.daily_kpis(lines, out, later))


def test_touched_days_reach_the_scan(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tx")
    clean([tx_row(str(i), f"2024-01-{i:02d}") for i in range(1, 29)], spark).write.parquet(path)
    days = [day("2024-01-03"), day("2024-01-04"), day("2024-01-20")]
    some = daily._on_days(spark.read.parquet(path), days)
    assert some.count() == 3
    assert "GreaterThanOrEqual(invoice_date" in some._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(daily, "RANGES", 1)
    assert daily._on_days(spark.read.parquet(path), days).count() == 3


def test_a_category_that_changes_reaches_the_published_kpis(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    item = {"description": "x", "cost_price": None, "weight_grams": None, "is_active": True, "supplier_id": None,
            "first_listed_date": None, "avg_unit_price": D("1.00")}
    source = spark.createDataFrame([tx_row("1", "2024-01-10"), tx_row("2", "2024-02-10", 2, "B")], TX)
    extract.transactions(source, landing, str(tmp_path / "control"), "2024-03-01")
    people = spark.createDataFrame([], schemas.RAW_CUSTOMERS)
    extract.snapshot(people, "customers", landing, "2024-03-01")
    for run_date, category in (("2024-03-01", "Tea"), ("2024-03-02", "Coffee")):
        goods = spark.createDataFrame([{"stock_code": k, "category": category if k == "B" else "Tea", **item} for k in "AB"],
                                      schemas.RAW_PRODUCTS)
        extract.snapshot(goods, "products", landing, run_date)
        lake = pipeline.run(spark, landing, out, "2024-03-05")
        kpis = {str(r.report_date): r for r in lake.published(spark, "gold", "daily_kpis").collect()}
        assert kpis["2024-02-10"].top_category_by_revenue == category
        assert kpis["2024-01-10"].top_category_by_revenue == "Tea" and len(kpis) == 2
    assert {(r.table_name, r.rule): r.passed_rows for r in pipeline.rule_metrics(spark, lake).collect()}[
        ("products", "avg_unit_price_positive")] == 4


# ---- customers, segments, gate ------------------------------------------------------------


def test_bucketed_customers_meet_without_a_shuffle(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    tx, products = silver.transactions(adapter.transactions(spark, SF)), adapter.products(spark, SF)
    customers = silver.customers(adapter.customers(spark, SF))
    lines = buckets.store(tx, "lines", "customer_id", 8)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        measures = gold.rfm(lines, adapter.AS_OF).join(gold.top_country(lines), "customer_id")
        assert "Exchange" not in measures._jdf.queryExecution().executedPlan().toString()
        facts = buckets.store(gold.facts_by_key(lines, products, adapter.AS_OF), "facts", "customer_id", 8)
        people = buckets.store(customers, "customers", "customer_id", 8)
        made = gold.assemble_360(people, gold.scored(facts))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    finally:
        for k in conf:
            spark.conf.unset(k)
    want = gold.customer_360(tx, customers, products, adapter.AS_OF)
    assert made.drop("_rebuilt_at").exceptAll(want.drop("_rebuilt_at")).count() == 0 and made.count() == want.count()


def brute_lloyd(points, centres, steps):
    """points: (coordinates, weight)."""
    for _ in range(steps):
        sums = [[0.0] * 3 + [0] for _ in centres]
        for p, n in points:
            k = min(range(len(centres)), key=lambda k: (sum((a - b) ** 2 for a, b in zip(p, centres[k])), k))
            for i in range(3):
                sums[k][i] += n * p[i]
            sums[k][3] += n
        centres = [[x / s[3] for x in s[:3]] if s[3] else c for s, c in zip(sums, centres)]
    return centres


def test_lloyd_steps_equal_plain_ones_and_the_cheapest_start_wins(spark):
    cells = [((r, f, m), 1 + (7 * r + 3 * f + m) % 5) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)
             if (r * f + m) % 3]
    rows = [cell for cell, n in cells for _ in range(n)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(rows)], "customer_id long, " + ", ".join(
        f"{s} int" for s in segment.SCORES))
    standard = segment.standardise(segment.stored_histogram(df))
    points = [(tuple(r[z] for z in segment.Z), r.n) for r in standard.collect()]
    starts = [[[9.0] * 3, [8.0] * 3, [7.0] * 3, [0.0] * 3], [[1.1, 0.9, 1.0], [0.8, -0.7, -1.05], [-0.85, 0.75, 0.95], [-1.0, -1.1, -0.9]]]
    for start in starts:
        got, want = segment.lloyd(standard, [start], 6), brute_lloyd(points, start, 6)
        assert all(math.isclose(a, b, abs_tol=1e-9) for x, y in zip(got, want) for a, b in zip(x, y))

    def cost(centres):
        return segment.cost(segment.predict(standard, centres)).first().cost

    alone = [segment.lloyd(standard, [s]) for s in starts]
    assert cost(segment.lloyd(standard, starts)) == pytest.approx(min(map(cost, alone)))


def test_the_gate_judges_the_newest_run_and_takes_text_versions(spark):
    def run(model, version, run_id, value, when):
        return (model, version, run_id, "metric", "score", str(value), ts(when))

    runs = spark.createDataFrame([
        run("m", "3", "run-9", 0.1, "2024-01-01"), run("m", "3", "run-10", 0.9, "2024-02-01"),
        run("t", "2024w10", "a", 0.9, "2024-01-01"), run("t", "2024w09", "b", 0.1, "2024-02-01"),
        run("x", "draft", "a", 0.1, "2024-02-01"), run("x", "12", "b", 0.9, "2024-01-01"),
    ], schemas.RUNS)
    thresholds = spark.createDataFrame([(m, "score", ">=", 0.5) for m in "mtx"], schemas.THRESHOLDS)
    got = {r.model: (r.version, r.run_id, r.passed) for r in gate.validate(runs, thresholds).collect()}
    assert got == {"m": ("3", "run-10", True), "t": ("2024w10", "a", True), "x": ("12", "b", True)}


def test_two_stores_in_a_country_give_a_customer_one_store(spark):
    tx = spark.createDataFrame([(1, "France"), (2, "Spain")], "customer_id long, country string")
    stores = spark.createDataFrame([("France", "FR-2"), ("France", "FR-1")], "country string, store_id string")
    assert {tuple(r) for r in dims.preferred_store(tx, stores).collect()} == {(1, "FR-1"), (2, "XX-001")}


def test_ratios_of_nothing_are_null(spark):
    rows = spark.createDataFrame([(None, "A", None, 1, ts("2024-01-01"), D("1.00"), 1, "France")], TX)
    made = gold.daily_sales(silver.enrich_transactions(rows)).first()
    assert made.total_orders == 0 and made.avg_basket_value is None
