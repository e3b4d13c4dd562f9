"""Table contracts.

A Spark file read turns every column nullable, so ``nullable=False`` here is a
declaration that ``contracts.check_contract`` enforces, not something a scan does.
"""

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
F64, TS, DATE = T.DoubleType(), T.TimestampType(), T.DateType()
PRICE = T.DecimalType(10, 2)
LINE_AMOUNT = T.DecimalType(12, 2)
TOTAL = T.DecimalType(14, 2)
# Four digits before the point: a day can hold more cancelled than completed orders.
RATE = T.DecimalType(9, 4)


def table(*columns):
    """Build a StructType from (name, type[, required[, comment]]) tuples."""
    fields = []
    for name, dtype, *rest in columns:
        required = bool(rest and rest[0])
        meta = {"comment": rest[1]} if len(rest) > 1 else {}
        fields.append(T.StructField(name, dtype, not required, meta))
    return T.StructType(fields)


RAW_TRANSACTIONS = table(
    ("invoice_no", S, True),
    ("stock_code", S, True),
    ("description", S),
    ("quantity", I, True),
    ("invoice_date", TS, True),
    ("unit_price", PRICE, True),
    ("customer_id", L),
    ("country", S),
)

RAW_CUSTOMERS = table(
    ("customer_id", L, True),
    ("full_name", S),
    ("email", S),
    ("phone", S),
    ("date_of_birth", DATE),
    ("registration_date", DATE),
    ("loyalty_tier", S),
    ("is_wholesaler", B),
    ("preferred_store_id", S),
    ("marketing_opt_in", B),
)

RAW_PRODUCTS = table(
    ("stock_code", S, True),
    ("description", S),
    ("category", S),
    ("avg_unit_price", PRICE),
    ("cost_price", PRICE),
    ("weight_grams", I),
    ("is_active", B),
    ("supplier_id", S),
    ("first_listed_date", DATE),
)

STORES = table(
    ("store_id", S, True),
    ("store_name", S),
    ("country", S),
    ("region", S),
    ("timezone", S),
    ("currency_code", S),
    ("is_active", B),
    ("opened_date", DATE),
)

WATERMARKS = table(("pipeline_name", S, True), ("last_watermark_value", TS, True))

LINEAGE = table(("_ingested_at", TS), ("_source_file", S))
SNAPSHOT = table(("_snapshot_date", DATE, False, "run date of the landing folder"))

SILVER_TRANSACTIONS = T.StructType(
    RAW_TRANSACTIONS.fields
    + LINEAGE.fields
    + table(
        ("line_total", LINE_AMOUNT),
        ("invoice_year", I),
        ("invoice_month", I),
        ("invoice_week", I, False, "ISO week; early January may belong to week 52 or 53"),
        ("_transformed_at", TS),
    ).fields
)

CUSTOMER_360 = table(
    ("customer_id", L, True),
    ("full_name", S),
    ("loyalty_tier", S),
    ("total_revenue_lifetime", TOTAL),
    ("total_orders", L),
    ("avg_order_value", PRICE),
    ("days_since_last_purchase", I),
    ("days_since_first_purchase", I),
    ("favourite_category", S),
    ("country", S),
    ("rfm_recency_score", I),
    ("rfm_frequency_score", I),
    ("rfm_monetary_score", I),
    ("customer_segment", S),
    ("churn_risk_score", T.FloatType(), False, "no rule fills it; always null"),
    ("_rebuilt_at", TS),
)

DAILY_KPIS = table(
    ("report_date", DATE, True),
    ("total_revenue", TOTAL),
    ("total_orders", L),
    ("unique_customers", L),
    ("total_units_sold", L),
    ("avg_unit_price", PRICE),
    ("avg_basket_value", PRICE),
    ("new_customers", L),
    ("returning_customers", L),
    ("cancelled_orders", L),
    ("top_category_by_revenue", S),
    ("cancellation_rate", RATE, False, "cancelled invoices / completed invoices of the day"),
    ("_rebuilt_at", TS),
)

DEMAND_FORECAST = table(
    ("stock_code", S, True, "SKU being forecast"),
    ("forecast_date", DATE, True, "Monday of the forecast week"),
    ("predicted_units", F64, False, "point forecast, never below zero"),
    ("lower_bound_80", F64, False, "lower edge of the 80 % band, never below zero"),
    ("upper_bound_80", F64, False, "upper edge of the 80 % band"),
    ("model_version", S, False, "version of the model that made the row"),
    ("run_id", S, False, "run that made the row"),
    ("generated_at", TS, False, "time the row was made"),
)

CUSTOMER_SEGMENTS = table(
    ("customer_id", L, True),
    ("cluster_id", I, True),
    ("customer_segment", S),
    ("run_id", S),
    ("segmented_at", TS),
)

RUNS = table(
    ("model", S, True),
    ("version", S, True),
    ("run_id", S, True),
    ("kind", S, True, "param or metric"),
    ("key", S, True),
    ("value", S),
    ("logged_at", TS),
)

THRESHOLDS = table(
    ("model", S, True), ("metric", S, True), ("op", S, True), ("threshold", F64, True)
)

EVENT_LOG = table(
    ("timestamp", TS, True),
    ("level", S, True),
    ("message", S),
    ("origin", T.StructType([T.StructField("flow_name", S), T.StructField("batch_id", S)])),
    ("error", S, False, "JSON text"),
)

PRIMARY_KEYS = {
    "transactions": ["invoice_no", "stock_code"],
    "customers": ["customer_id"],
    "products": ["stock_code"],
    "stores": ["store_id"],
    "pipeline_watermarks": ["pipeline_name"],
}
