"""Registered queries: name -> function of (spark, folder of test tables)."""

from pyspark.sql import functions as F

from shopflow import schemas
from shopflow.functions import fixed_values as fixed
from shopflow.operators import (
    contracts, dims, forecast, gate, gold, monitor, segment, silver,
)
from shopflow.plans import daily, extract, pipeline
from shopflow.plans.shop import Shop
from shopflow.sources import adapter, buckets, ingest, partitions, stage, versioned
from shopflow.streaming import stream

QUERIES = {}


def register(fn):
    """Register a function of a Shop under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Shop(spark, sf_dir))
    return fn


def _names(rules):
    """Rule names as text: arrays do not occur in any table."""
    return F.array_join(rules, ",").alias("failed_rules")


@register
def silver_transactions(s):
    return s.transactions


@register
def cancelled_transactions(s):
    return s.routed.cancelled.drop("cancelled_at")


@register
def quarantine_transactions(s):
    return s.routed.quarantine.drop("quarantined_at")


@register
def rejected_transactions(s):
    return s.routed.rejected.select(
        *schemas.RAW_TRANSACTIONS.names, _names("failed_rules"),
    )


@register
def strict_price_transactions(s):
    strict = silver.transactions(s.raw_transactions, allow_zero_price=False)
    return strict.select("invoice_no", "stock_code", "quantity", "unit_price", "line_total")


@register
def transaction_routes(s):
    return s.raw_transactions.groupBy(silver.transaction_route().alias("route")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@register
def expectation_report(s):
    rules = {**fixed.TRANSACTION_RULES, "customer_id_not_null": "customer_id IS NOT NULL"}
    return contracts.expectation_report(s.raw_transactions, rules)


@register
def observed_rules(s):
    """The same counts from metrics that ride along while the rows are written."""
    watched, seen = contracts.watch_rules(s.raw_transactions, pipeline.RULES["transactions"])
    stage.table(watched, "bronze")
    return contracts.watched_report(s.spark, seen, pipeline.RULES["transactions"])


@register
def customers_clean(s):
    return silver.route_customers(s.raw_customers).valid.drop("_ingested_at")


@register
def customers_scd1(s):
    return s.customers.drop("_ingested_at")


@register
def quarantine_customers(s):
    return silver.route_customers(s.raw_customers).quarantine.drop("quarantined_at").withColumnRenamed(
        "_ingested_at", "ingested_at")


@register
def rejected_customers(s):
    rejected = silver.route_customers(s.raw_customers).rejected.drop("rejected_at")
    return rejected.withColumnRenamed("_ingested_at", "ingested_at").withColumn("failed_rules", _names("failed_rules"))


@register
def products_clean(s):
    return s.products.select("stock_code", "description", "category", "avg_unit_price")


@register
def rejected_products(s):
    return silver.route_products(s.raw_products).rejected.select(
        "stock_code", "avg_unit_price", _names("failed_rules")
    )


@register
def product_flags(s):
    flagged = silver.flag_products(s.products, s.transactions, adapter.AS_OF)
    return flagged.drop("_ingested_at", "_transformed_at")


@register
def orphan_skus(s):
    return silver.orphan_skus(s.transactions, s.products)


@register
def rfm(s):
    return gold.rfm(s.transactions, adapter.AS_OF)


@register
def rfm_scores(s):
    return gold.rfm_scores(gold.rfm(s.transactions, adapter.AS_OF)).select(
        "customer_id", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score"
    )


@register
def rfm_scores_distributed(s):
    """The same scores from the one-scan customer facts."""
    return gold.rfm_scores(gold.customer_facts(s.transactions, s.products, adapter.AS_OF)).select(
        "customer_id", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score"
    )


@register
def customer_top_country(s):
    return gold.top_country(s.transactions)


@register
def customer_favourite_category(s):
    return gold.favourite_category(s.transactions, s.products)


@register
def customer_facts(s):
    return gold.customer_facts(s.transactions, s.products, adapter.AS_OF)


@register
def customer_360(s):
    full = gold.customer_360(s.transactions, s.customers, s.products, adapter.AS_OF)
    return full.drop("_rebuilt_at")


@register
def customer_360_bucketed(s):
    """The same from lines, facts and customers bucketed by customer: no shuffle by it but theirs."""
    lines = buckets.store(s.transactions, "lines", "customer_id")
    facts = buckets.store(gold.facts_by_key(lines, s.products, adapter.AS_OF), "facts", "customer_id")
    customers = buckets.store(s.customers, "customers", "customer_id")
    return gold.assemble_360(customers, gold.scored(facts)).drop("_rebuilt_at")


@register
def first_purchase(s):
    return gold.first_purchase(s.transactions)


@register
def daily_sales(s):
    return gold.daily_sales(s.transactions)


@register
def daily_new_returning(s):
    return gold.daily_new_returning(s.stored_transactions)


@register
def daily_cancellations(s):
    return gold.daily_cancellations(s.routed.cancelled)


@register
def cancel_only_days(s):
    return gold.cancel_only_days(s.transactions, s.routed.cancelled)


@register
def daily_category_revenue(s):
    return gold.daily_category_revenue(s.transactions, s.products)


@register
def daily_top_category(s):
    return gold.daily_top_category(gold.daily_category_revenue(s.transactions, s.products))


@register
def daily_kpis_incremental(s):
    """KPIs after three batches of mixed dates; each computes the days it touches."""
    base = stage.new_path(s.spark, "daily")
    batch = F.pmod(F.crc32(F.col("invoice_no").cast("binary")), F.lit(3)).alias("batch")
    lines = stage.table(silver.transactions(s.stored_raw).drop("_transformed_at").select("*", batch), "lines")
    cancelled = silver.route_transactions(s.stored_raw).cancelled
    gone = stage.table(cancelled.select("invoice_no", "invoice_date", batch), "cancelled")
    products = stage.table(s.products, "products")
    for n in range(3):
        new = daily.sold_and_cancelled(lines.where(f"batch = {n}"), gone.where(f"batch = {n}"))
        daily.advance(base, n, new, lines.where(f"batch <= {n}"), gone.where(f"batch <= {n}"), products)
    return daily.kpis(s.spark, base).drop("_rebuilt_at")


@register
def daily_kpis(s):
    routed = silver.route_transactions(s.stored_raw)
    return gold.daily_kpis(silver.transactions(s.stored_raw), routed.cancelled, s.products).drop("_rebuilt_at")


def _rounded(df, digits=6, **by_column):
    """Doubles at a fixed number of places, so that summation order does not show."""
    return df.select([
        F.round(c, by_column.get(c, digits)).alias(c) if t == "double" else F.col(c)
        for c, t in df.dtypes
    ])


@register
def top_skus(s):
    return forecast.top_skus(s.transactions)


@register
def weekly_sales(s):
    return forecast.weekly_sales(s.stored_transactions, forecast.top_skus(s.stored_transactions))


@register
def weekly_filled(s):
    return forecast.fill_weeks(forecast.weekly_sales(s.transactions))


@register
def holdout_split(s):
    return forecast.split(forecast.weekly_for(s.transactions, None))


@register
def forecast_skipped(s):
    return forecast.skipped(forecast.weekly_for(s.transactions, None))


@register
def forecast_params(s):
    params = forecast.refit(forecast.weekly_for(s.transactions, None))
    return _rounded(params.select(
        "stock_code", "train_weeks", "first_week", "last_week", "slope", "intercept", "sigma"
    ))


@register
def forecast_month_index(s):
    params = forecast.refit(forecast.weekly_for(s.transactions, None))
    months = params.select("stock_code", F.posexplode("month_index").alias("pos", "month_index"))
    return _rounded(months.select(
        "stock_code", (F.col("pos") + 1).alias("month"), "month_index"
    ))


def _backtest(s, n=fixed.TOP_N_SKUS):
    # Read by the fit and by the test: stored, so that the lines are added up once.
    weekly = stage.table(forecast.weekly_for(s.stored_transactions, n), "weekly-sales")
    return forecast.backtest(weekly, forecast.fit(weekly, fixed.HOLDOUT_WEEKS))


@register
def forecast_backtest(s):
    return _rounded(_backtest(s), mape=4)


@register
def forecast_metrics(s):
    return _rounded(forecast.metrics(_backtest(s)), mean_mape=4)


@register
def forecast_backtest_all(s):
    return _rounded(_backtest(s, None), mape=4)


@register
def forecast_metrics_all(s):
    return _rounded(forecast.metrics(_backtest(s, None)), mean_mape=4)


def _forecast(weekly):
    predicted = forecast.predict(forecast.refit(weekly))
    return _rounded(forecast.to_gold(predicted, "1", "run", adapter.NOW))


@register
def demand_forecast(s):
    return _forecast(forecast.weekly_for(s.stored_transactions, fixed.TOP_N_SKUS))


@register
def demand_forecast_all(s):
    return _forecast(forecast.weekly_for(s.transactions, None))


@register
def customer_keys(s):
    return dims.customer_keys(s.raw_transactions)


@register
def modal_country(s):
    return dims.modal_country(s.raw_transactions)


@register
def product_dimension(s):
    return dims.product_dimension(s.raw_transactions)


@register
def preferred_store(s):
    return dims.preferred_store(s.raw_transactions, dims.stores(s.spark))


@register
def store_sales(s):
    """Stores with sales in their country, with region and currency of the store list."""
    by_country = s.transactions.groupBy("country").agg(
        F.sum("line_total").cast("decimal(14,2)").alias("revenue"),
        F.count(F.lit(1)).alias("lines"),
    )
    stores = dims.stores(s.spark)
    return by_country.join(F.broadcast(stores), "country")


# Centres that stand for a fitted model where another engine has to agree.
FIXED_CENTRES = [[1.1] * 3, [0.3] * 3, [-0.4] * 3, [-1.2] * 3]


def _features(s):
    return segment.rfm_features(s.customer_360)


def _fixed_model(s):
    features = _features(s)
    standard = segment.standardise(segment.stored_histogram(features))
    return features, segment.predict(standard, FIXED_CENTRES)


@register
def rfm_histogram(s):
    return segment.histogram(_features(s))


@register
def rfm_standardised(s):
    return _rounded(segment.standardise(segment.stored_histogram(_features(s))))


def _segments(features, assigned):
    return segment.assign(features, assigned, segment.label(assigned), "run", adapter.NOW)


@register
def segment_assign_fixed(s):
    return _segments(*_fixed_model(s)).drop("run_id", "segmented_at")


@register
def segment_silhouette(s):
    return _rounded(segment.silhouette(_fixed_model(s)[1]))


@register
def segment_labels(s):
    return _rounded(segment.label(_fixed_model(s)[1]))


@register
def segment_distribution(s):
    return segment.distribution(_segments(*_fixed_model(s)))


@register
def customer_360_segments(s):
    """Customer 360 with the segment column filled from the segment table."""
    segments = _segments(*_fixed_model(s))
    return gold.with_segments(s.customer_360, segments).drop("_rebuilt_at")


# Starting centres of K-Means where another engine has to follow it.
STARTS = [FIXED_CENTRES, [[1.1, 0.9, 1.0], [0.8, -0.7, -1.05], [-0.85, 0.75, 0.95], [-1.0, -1.1, -0.9]]]


@register
def kmeans_segments(s):
    """Segments by weighted K-Means from fixed starts."""
    features = _features(s)
    standard = segment.standardise(segment.stored_histogram(features))
    assigned = segment.predict(standard, segment.lloyd(standard, STARTS))
    return _segments(features, assigned).drop("segmented_at")


def _runs(s):
    """Two versions per model; the older ones hold no metric."""
    silhouette = segment.silhouette(_fixed_model(s)[1])
    errors = forecast.metrics(_backtest(s)).select("mean_mape")
    old = [
        gate.record_run(s.spark, "segmentation", "1", "run-1", {"n_clusters": 4}, {}, adapter.NOW),
        gate.record_run(s.spark, "demand_forecast", "9", "run-9", {"n_skus": 50}, {}, adapter.NOW),
    ]
    new = [
        gate.metric_rows("segmentation", "2", "run-2", silhouette, adapter.NOW),
        gate.metric_rows("demand_forecast", "10", "run-10", errors, adapter.NOW),
    ]
    return stage.table(contracts.union_all(old + new), "runs")


@register
def model_gate(s):
    judged = gate.validate(_runs(s), gate.default_thresholds(s.spark))
    return _rounded(judged)


@register
def gate_summary(s):
    return gate.summary(gate.validate(_runs(s), gate.default_thresholds(s.spark)))


@register
def gate_promote(s):
    """Champions after a gate with several thresholds, a repeated run and a failing version.

    ``segmentation`` logged its run twice, the newer value is the real one, and meets one
    of two thresholds; ``demand_forecast`` meets its only one; ``other`` has a newest
    version without the metric; ``kept`` was never run and keeps its pointer.
    """
    silhouette = segment.silhouette(_fixed_model(s)[1])
    errors = forecast.metrics(_backtest(s, None)).select("mean_mape")
    stale = F.lit(adapter.NOW).cast("timestamp") - F.expr("INTERVAL 1 DAY")
    runs = stage.table(contracts.union_all([
        gate.metric_rows("segmentation", "2", "run-2", silhouette, adapter.NOW),
        gate.record_run(s.spark, "segmentation", "2", "run-2", {}, {"silhouette_score": 9.0}, stale),
        gate.record_run(s.spark, "segmentation", "1", "run-1", {}, {"silhouette_score": 0.9}, stale),
        gate.metric_rows("demand_forecast", "10", "run-10", errors, adapter.NOW),
        gate.record_run(s.spark, "other", "3", "run-3", {"n": 1}, {}, adapter.NOW),
        gate.record_run(s.spark, "other", "2", "run-2", {}, {"score": 1.0}, stale),
        # The newest run counts, not the largest name; versions may be text.
        gate.record_run(s.spark, "rerun", "4", "run-10", {}, {"score": 0.9}, adapter.NOW),
        gate.record_run(s.spark, "rerun", "4", "run-9", {}, {"score": 0.1}, stale),
        gate.record_run(s.spark, "weekly", "2024w10", "run-a", {}, {"score": 0.9}, stale),
        gate.record_run(s.spark, "weekly", "2024w09", "run-b", {}, {"score": 0.1}, adapter.NOW),
    ]), "runs")
    thresholds = s.spark.createDataFrame([
        ("segmentation", "silhouette_score", ">=", 0.0), ("segmentation", "silhouette_score", ">=", 1.1),
        ("demand_forecast", "mean_mape", ">=", 0.0), ("other", "score", ">=", 0.5), ("kept", "score", ">=", 0.5),
        ("rerun", "score", ">=", 0.5), ("weekly", "score", ">=", 0.5),
    ], schemas.THRESHOLDS)
    champions = s.spark.createDataFrame(
        [("segmentation", "champion", "1", None), ("kept", "champion", "7", None)], gate.CHAMPIONS)
    judged = gate.validate(runs, thresholds)
    return gate.promote(champions, judged, adapter.NOW).join(gate.verdicts(judged).select("model", "passed"), "model")


@register
def recent_errors(s):
    found = monitor.recent_errors(s.event_log, adapter.NOW, 720, 10, ("ERROR", "WARN"))
    return found.drop("error")


@register
def error_exceptions(s):
    return monitor.explode_exceptions(s.event_log)


# ---- ingest ---------------------------------------------------------------------------

MARK = "1998-07-01 00:00:00"


def _marks(s):
    """A control table that already knows this pipeline and another one."""
    known = [(extract.TRANSACTIONS_PIPELINE, MARK), ("pl_other", MARK)]
    rows = s.spark.createDataFrame(known, "pipeline_name string, mark string")
    return rows.select("pipeline_name", F.col("mark").cast("timestamp").alias("last_watermark_value"))


@register
def watermark_increment(s):
    step = ingest.run_increment(s.raw_transactions, _marks(s), extract.TRANSACTIONS_PIPELINE)
    return step.rows


@register
def late_rows(s):
    """Landed rows after three runs, of which the first misses rows at and below its mark.

    They reach the source later, at most 60 days below the mark: none is lost or doubled.
    """
    base, control = stage.new_path(s.spark, "landing"), stage.new_path(s.spark, "control")
    source = stage.table(s.raw_transactions, "source")
    mark = F.lit(MARK).cast("timestamp")
    late = F.col("invoice_date").between(mark - F.expr("INTERVAL 59 DAY"), mark) & (
        F.pmod(F.crc32(F.col("invoice_no").cast("binary")), F.lit(4)) == 0)
    early = source.where(F.col("invoice_date") <= mark)
    at_mark = early.where(~F.coalesce(late, F.lit(False)))
    for day, rows in (("1998-07-02", at_mark), ("1998-07-03", early), ("2001-08-02", source)):
        extract.transactions(rows, base, control, day, overlap="60 DAY")
    return ingest.scan(s.spark, f"{base}/transactions", schemas.RAW_TRANSACTIONS)


@register
def watermark_upsert(s):
    """The control table after a run of a known pipeline and the first run of a new one."""
    step = ingest.run_increment(s.raw_transactions, _marks(s), extract.TRANSACTIONS_PIPELINE)
    return ingest.run_increment(s.raw_transactions, step.watermarks, "pl_new").watermarks


@register
def keep_last(s):
    keys = schemas.PRIMARY_KEYS["transactions"]
    return ingest.keep_last(ingest.canonical_keys(s.raw_transactions), keys, silver.TRANSACTION_ORDER)


@register
def duplicate_count(s):
    return ingest.duplicate_count(s.raw_transactions, schemas.PRIMARY_KEYS["transactions"])


@register
def keep_last_observed(s):
    """Rows before and after ``keep_last``, counted while its result is written."""
    keys = schemas.PRIMARY_KEYS["transactions"]
    rows, before, after = ingest.keep_last_counted(
        ingest.canonical_keys(s.raw_transactions), keys, silver.TRANSACTION_ORDER)
    stage.table(rows, "kept")
    counts = before.get["rows"], after.get["rows"], before.get["rows"] - after.get["rows"]
    return s.spark.createDataFrame([counts], "all_rows long, kept_rows long, dropped_rows long")


@register
def normalise_raw(s):
    return ingest.normalise_raw(ingest.union_parts(adapter.raw_extract_parts(s.spark, s.sf_dir)))


@register
def conform_types(s):
    """Text columns of all parts cast to the declared types; what does not fit is null."""
    return _conformed(s)


def _conformed(s):
    return contracts.union_all([
        ingest.conform(part.withColumnsRenamed(fixed.RAW_HEADERS), schemas.RAW_TRANSACTIONS)
        for part in adapter.raw_extract_parts(s.spark, s.sf_dir)
    ])


@register
def table_counts(s):
    return ingest.table_counts({
        "transactions": s.raw_transactions, "customers": s.raw_customers, "products": s.raw_products,
        "stores": dims.stores(s.spark), "pipeline_watermarks": _marks(s),
    })


@register
def transaction_profile(s):
    return ingest.profile_transactions(s.raw_transactions)


@register
def contract_violations(s):
    """Nulls in columns the contract requires, in the extract as it came, all parts."""
    return contracts.null_violations(_conformed(s), schemas.RAW_TRANSACTIONS)


@register
def text_lengths(s):
    """Longest texts of the raw tables against what the source database holds."""
    tables = {"transactions": s.raw_transactions, "customers": s.raw_customers, "products": s.raw_products}
    return contracts.union_all([
        contracts.text_lengths(df, fixed.TEXT_LIMITS[name]).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()])


@register
def csv_products(s):
    """The product dimension written to CSV and read back with its declared types."""
    made = dims.product_dimension(s.raw_transactions)
    path = stage.new_path(s.spark, "products-csv")
    ingest.write_csv(made, path)
    return ingest.read_csv_typed(s.spark, path, made.schema)


@register
def land_snapshot(s):
    """Customers landed as two daily snapshots, read back without the folder columns."""
    base = stage.new_path(s.spark, "landing")
    first, second = adapter.customer_snapshots(s.spark, s.sf_dir)
    for day, rows in (("2001-08-01", first), ("2001-08-02", second)):
        ingest.land_parquet(rows.drop("_ingested_at"), base, day)
    schema = first.drop("_ingested_at").schema
    return ingest.scan(s.spark, base, schema)


# ---- streams --------------------------------------------------------------------------


def _landed(s, base):
    """Raw transactions landed in two runs, as two increments of the source."""
    first = ingest.extract_increment(s.raw_transactions, fixed.WATERMARK_START, MARK)
    second = ingest.extract_increment(s.raw_transactions, MARK, None)
    return [
        lambda: ingest.land_parquet(first, base, "1998-07-02"),
        lambda: ingest.land_parquet(second, base, "2001-08-02"),
    ]


def _streamed(s, transform):
    """Land a run, drain the stream into a table, land the next run, drain again."""
    base = stage.new_path(s.spark, "stream")
    for land in _landed(s, f"{base}/landing"):
        land()
        files = ingest.scan_stream(s.spark, f"{base}/landing", schemas.RAW_TRANSACTIONS)
        stream.append(transform(ingest.with_lineage(files)), f"{base}/table", f"{base}/checkpoint")
    return s.spark.read.parquet(f"{base}/table")


@register
def stream_bronze(s):
    return _streamed(s, lambda rows: rows).select(schemas.RAW_TRANSACTIONS.names)


@register
def stream_dedupe_keys(s):
    """Keys only: which of several copies arrives first within a run is not fixed."""
    made = _streamed(s, lambda rows: stream.silver_transactions(rows, splits=4))
    return made.select("invoice_no", "stock_code")


@register
def stream_dedupe_rows(s):
    """Clean transactions from two drains, all columns: the survivors are fixed."""
    base = stage.new_path(s.spark, "stream")
    for land in _landed(s, f"{base}/landing"):
        land()
        files = ingest.scan_stream(s.spark, f"{base}/landing", schemas.RAW_TRANSACTIONS)
        stream.append_first(
            silver.route_transactions(files).valid, f"{base}/table", schemas.PRIMARY_KEYS["transactions"],
            silver.TRANSACTION_ORDER, f"{base}/checkpoint", silver.enrich_transactions)
    stored = s.spark.read.option("recursiveFileLookup", True).parquet(f"{base}/table")
    return stored.drop("_transformed_at")


@register
def stream_dedupe_parts(s):
    """The same rows from three drains, stored by key part: a drain opens few earlier files."""
    base = stage.new_path(s.spark, "stream")
    runs = [(fixed.WATERMARK_START, "1996-01-01"), ("1996-01-01", MARK), (MARK, None)]
    for (low, high), day in zip(runs, ("1996-01-02", "1998-07-02", "2001-08-02")):
        ingest.land_parquet(ingest.extract_increment(s.raw_transactions, low, high), f"{base}/landing", day)
        files = ingest.scan_stream(s.spark, f"{base}/landing", schemas.RAW_TRANSACTIONS)
        stream.append_first(
            silver.route_transactions(files).valid, f"{base}/table", schemas.PRIMARY_KEYS["transactions"],
            silver.TRANSACTION_ORDER, f"{base}/checkpoint", silver.enrich_transactions, tail=3)
    stored = s.spark.read.option("recursiveFileLookup", True).parquet(f"{base}/table")
    return stored.drop("_transformed_at")


@register
def stream_archive(s):
    """Bronze from drains of one file a batch; what was read leaves the landing folder."""
    base = stage.new_path(s.spark, "stream")
    for land in _landed(s, f"{base}/landing"):
        land()
        files = ingest.scan_stream(
            s.spark, f"{base}/landing", schemas.RAW_TRANSACTIONS, max_files=1, archive=f"{base}/archive")
        stream.append(files, f"{base}/table", f"{base}/checkpoint")
    return s.spark.read.parquet(f"{base}/table")


@register
def landing_violations(s):
    """Landing folders with what breaks their contract, and the rows a guarded stream reads.

    The oldest folder has a mistyped and a missing column; it is not opened.
    """
    base = stage.new_path(s.spark, "landing")
    first, second = [df.drop("_ingested_at") for df in adapter.customer_snapshots(s.spark, s.sf_dir)]
    bad = first.withColumn("customer_id", F.col("customer_id").cast("string")).drop("email")
    for day, rows in (("2001-07-31", bad), ("2001-08-01", first), ("2001-08-02", second)):
        ingest.land_parquet(rows, f"{base}/landing", day)
    found = ingest.landing_violations(s.spark, f"{base}/landing", first.schema)
    rows = ingest.scan_stream(s.spark, f"{base}/landing", first.schema).where(ingest.outside([f for f, _ in found]))
    stream.append(ingest.with_snapshot_date(rows), f"{base}/table", f"{base}/checkpoint")
    read = s.spark.read.parquet(f"{base}/table").groupBy(F.col("_snapshot_date").cast("string").alias("run_date")).count()
    folders = [(f.rpartition("=")[2], dict(found).get(f)) for f in ingest.landing_folders(s.spark, f"{base}/landing")]
    return s.spark.createDataFrame(folders, "run_date string, problems string").join(read, "run_date", "left").select(
        "run_date", "problems", F.coalesce("count", F.lit(0)).alias("read_rows"))


@register
def key_violations(s):
    """Keys on several rows: raw transactions have some, silver ones none."""
    keys = schemas.PRIMARY_KEYS["transactions"]
    found = [contracts.key_violations(df, keys).select(F.lit(name).alias("table_name"), *keys, "rows")
             for name, df in (("raw", s.raw_transactions), ("silver", s.transactions))]
    return contracts.union_all(found)


@register
def stream_cancelled(s):
    made = _streamed(s, lambda rows: silver.route_transactions(rows).cancelled)
    return made.select("original_invoice_no", *schemas.RAW_TRANSACTIONS.names)


@register
def stream_side_tables(s):
    """Rows that leave the main path, with route and reason, from one streaming scan."""
    made = _streamed(s, lambda rows: stream.rejected_sides(
        rows, silver.transaction_route(), pipeline.side_reasons()
    ))
    return made.select(*schemas.RAW_TRANSACTIONS.names, "route", "reason")


@register
def stream_scd1(s):
    base = stage.new_path(s.spark, "scd1")
    snapshots = adapter.customer_snapshots(s.spark, s.sf_dir)
    schema = snapshots[0].schema
    for day, rows in zip(("2001-08-01", "2001-08-02"), snapshots):
        ingest.land_parquet(rows, f"{base}/landing", day)
        valid = silver.route_customers(ingest.scan_stream(s.spark, f"{base}/landing", schema)).valid
        stream.upsert_scd1(
            valid, f"{base}/table", schema, ["customer_id"], ["_ingested_at"], f"{base}/checkpoint"
        )
    return versioned.current(s.spark, f"{base}/table", schema).drop("_ingested_at")


@register
def stream_scd1_buckets(s):
    """The same customers from a table of which a batch rewrites only its own buckets."""
    base = stage.new_path(s.spark, "scd1")
    snapshots = adapter.customer_snapshots(s.spark, s.sf_dir)
    schema = snapshots[0].schema
    for day, rows in zip(("2001-08-01", "2001-08-02"), snapshots):
        ingest.land_parquet(rows, f"{base}/landing", day)
        valid = silver.route_customers(ingest.scan_stream(s.spark, f"{base}/landing", schema)).valid
        stream.upsert_buckets(
            valid, f"{base}/table", schema, ["customer_id"], ["_ingested_at"], f"{base}/checkpoint", buckets=16)
    stored = partitions.read(s.spark, f"{base}/table", stream.bucketed(schema))
    return stored.drop("_ingested_at", "_bucket")


@register
def stream_scd1_backlog(s):
    """Two snapshots that wait for one drain; the later run date wins."""
    base = stage.new_path(s.spark, "scd1")
    snapshots = [df.drop("_ingested_at") for df in adapter.customer_snapshots(s.spark, s.sf_dir)]
    for day, rows in zip(("2001-08-01", "2001-08-02"), snapshots):
        ingest.land_parquet(rows, f"{base}/landing", day)
    waiting = ingest.with_snapshot_date(
        ingest.scan_stream(s.spark, f"{base}/landing", snapshots[0].schema))
    valid = silver.route_customers(waiting).valid
    stream.upsert_scd1(
        valid, f"{base}/table", valid.schema, ["customer_id"], ["_snapshot_date"], f"{base}/checkpoint"
    )
    return versioned.current(s.spark, f"{base}/table", valid.schema).drop("_snapshot_date")


@register
def products_backlog(s):
    """Two product snapshots read together; the later valid row of a code wins."""
    base = stage.new_path(s.spark, "landing")
    snapshots = adapter.product_snapshots(s.spark, s.sf_dir)
    for day, rows in zip(("2001-08-01", "2001-08-02"), snapshots):
        ingest.land_parquet(rows, base, day)
    landed = ingest.with_snapshot_date(ingest.scan(s.spark, base, snapshots[0].schema))
    return silver.clean_products(landed, ["_snapshot_date"]).drop("_snapshot_date")


@register
def stream_products(s):
    """Products appended to bronze by a stream, with the date of their snapshot."""
    base = stage.new_path(s.spark, "stream")
    snapshots = adapter.product_snapshots(s.spark, s.sf_dir)
    for day, rows in zip(("2001-08-01", "2001-08-02"), snapshots):
        ingest.land_parquet(rows, f"{base}/landing", day)
        files = ingest.scan_stream(s.spark, f"{base}/landing", snapshots[0].schema)
        stream.append(ingest.with_lineage(ingest.with_snapshot_date(files)), f"{base}/table", f"{base}/checkpoint")
    stored = s.spark.read.parquet(f"{base}/table")
    return stored.select("stock_code", "description", "category", "avg_unit_price",
                         F.col("_snapshot_date").alias("snapshot_date"))


@register
def stream_lineage(s):
    """Rows per landing folder, as the lineage column of streamed bronze tells it."""
    made = _streamed(s, lambda rows: rows)
    folder = F.regexp_extract("_source_file", "run_date=([0-9-]+)", 1).alias("run_date")
    return made.groupBy(folder).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("_ingested_at").alias("stamped_rows"))


def _snapshot(s, source, schema):
    path = stage.new_path(s.spark, "landing")
    rows = ingest.conform(ingest.extract_snapshot(source, schema), schema)
    ingest.land_parquet(rows, path, "2001-08-02")
    return ingest.scan(s.spark, path, schema)


@register
def snapshot_products(s):
    source = s.raw_products
    return _snapshot(s, source, schemas.table(*[
        (f.name, f.dataType, not f.nullable) for f in schemas.RAW_PRODUCTS if f.name in source.columns]))


@register
def snapshot_customers(s):
    source = adapter.customer_snapshots(s.spark, s.sf_dir)[1]
    return _snapshot(s, source, schemas.table(*[
        (f.name, f.dataType, not f.nullable) for f in schemas.RAW_CUSTOMERS if f.name in source.columns]))


@register
def full_refresh_table(s):
    """A table replaced by one of another schema; readers see the new one only."""
    base = stage.new_path(s.spark, "refreshed")
    versioned.publish_next(s.raw_products, base)
    versioned.publish_next(dims.product_dimension(s.raw_transactions), base)
    return versioned.current(s.spark, base)


@register
def run_records(s):
    """What a run logs: parameters and metrics, without the time."""
    errors = forecast.metrics(_backtest(s, None)).select("n_skus_trained")
    params = {"n_skus": "all", "forecast_horizon_weeks": fixed.FORECAST_HORIZON_WEEKS}
    return gate.record_run(s.spark, "demand_forecast", "1", "run", params, {}, adapter.NOW).unionByName(
        gate.metric_rows("demand_forecast", "1", "run", errors, adapter.NOW))


def _job(s, modes):
    """Extract and daily job over two days of landed files; the last day once per mode."""
    root = stage.new_path(s.spark, "lake")
    landing, control = f"{root}/landing", f"{root}/control"
    source = stage.table(s.raw_transactions, "source")
    products = adapter.with_all_columns(s.raw_products, schemas.RAW_PRODUCTS)
    snapshots = adapter.customer_snapshots(s.spark, s.sf_dir)
    parts = source.where(F.col("invoice_date") <= F.lit(MARK).cast("timestamp")), source
    for day, rows, customers in zip(("2001-08-01", "2001-08-02"), parts, snapshots):
        extract.transactions(rows, landing, control, day)
        extract.snapshot(adapter.with_all_columns(customers, schemas.RAW_CUSTOMERS), "customers", landing, day)
        extract.snapshot(products, "products", landing, day)
        lake = pipeline.run(s.spark, landing, f"{root}/out", adapter.AS_OF)
    return {"incremental": lake} | {m: pipeline.run(s.spark, landing, f"{root}/out", adapter.AS_OF, m) for m in modes}


@register
def pipeline_silver(s):
    """Clean transactions after two daily runs of the whole job, and the customers with them."""
    made = pipeline.transactions(s.spark, _job(s, [])["incremental"])
    return made.drop("_ingested_at", "_source_file", "_transformed_at")


@register
def pipeline_kpis(s):
    """The published KPI table after two daily runs, and after a full refresh."""
    made = [lake.published(s.spark, "gold", "daily_kpis").withColumn("mode", F.lit(mode))
            for mode, lake in _job(s, ["full_refresh"]).items()]
    return contracts.union_all(made).drop("_rebuilt_at")


@register
def kmeans_check(s):
    """What any good clustering must meet: all customers, four labels, cost not above fixed centres."""
    features = _features(s)
    standard = segment.standardise(segment.stored_histogram(features))
    fitted = segment.predict(standard, segment.fit(standard))
    segments = _segments(features, fitted)
    counts = segments.agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("cluster_id").alias("clusters"),
        F.count_distinct("customer_segment").alias("labels"))
    fixed_cost = segment.cost(segment.predict(standard, FIXED_CENTRES)).scalar()
    return counts.withColumn("not_worse", segment.cost(fitted).scalar() <= fixed_cost + 1e-9)
