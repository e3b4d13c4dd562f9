"""Word lists, patterns, thresholds and lookup tables the results depend on."""

# Rules a clean transaction meets.
TRANSACTION_RULES = {
    "quantity_positive": "quantity > 0",
    "unit_price_non_negative": "unit_price >= 0",
    "invoice_date_not_null": "invoice_date IS NOT NULL",
    "invoice_no_not_null": "invoice_no IS NOT NULL",
    "stock_code_not_null": "stock_code IS NOT NULL",
}
# The stricter price rule replaces unit_price_non_negative on request.
STRICT_PRICE_RULE = {"unit_price_positive": "unit_price > 0"}

CUSTOMER_RULES = {
    "customer_id_not_null": "customer_id IS NOT NULL",
    "loyalty_tier_valid": "loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')",
}

PRODUCT_RULES = {
    "stock_code_not_null": "stock_code IS NOT NULL",
    "avg_unit_price_positive": "avg_unit_price > 0",
}

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"

NULL_CUSTOMER = "customer_id IS NULL"
INVALID_EMAIL = "invalid_email"
CANCEL_PREFIX = "C"
UNCATEGORIZED = "Uncategorized"

SLOW_MOVER_DAYS = 90
RFM_TILES = 5

TOP_N_SKUS = 50
FORECAST_HORIZON_WEEKS = 12
HOLDOUT_WEEKS = 4
MIN_TRAIN_WEEKS = 8
MAPE_SHIFT = 1e-6
MAPE_FLOOR = 2.220446049250313e-16
# Half-width of a central 80 % band of the normal distribution, in standard deviations.
Z_80 = 1.2815515655446004

SEGMENT_NAMES = ["Champions", "Loyal Customers", "At Risk", "Lost Customers"]
KMEANS_SEED = 42
KMEANS_STARTS = 10

# (model, metric, operator, threshold) used when a caller passes no thresholds.
GATE_THRESHOLDS = [
    ("segmentation", "silhouette_score", ">=", 0.05),
    ("demand_forecast", "mean_mape", "<=", 5.0),
]

# (country, store_id, region, timezone)
COUNTRY_STORES = [
    ("United Kingdom", "UK-001", "EMEA", "Europe/London"),
    ("Germany", "DE-001", "EMEA", "Europe/Berlin"),
    ("France", "FR-001", "EMEA", "Europe/Paris"),
    ("EIRE", "IE-001", "EMEA", "Europe/Dublin"),
    ("Spain", "ES-001", "EMEA", "Europe/Madrid"),
    ("Netherlands", "NL-001", "EMEA", "Europe/Amsterdam"),
    ("Belgium", "BE-001", "EMEA", "Europe/Brussels"),
    ("Switzerland", "CH-001", "EMEA", "Europe/Zurich"),
    ("Australia", "AU-001", "APAC", "Australia/Sydney"),
    ("Japan", "JP-001", "APAC", "Asia/Tokyo"),
    ("USA", "US-001", "Americas", "America/New_York"),
    ("Canada", "CA-001", "Americas", "America/Toronto"),
]
DEFAULT_STORE_ID = "XX-001"

# Currency by country; every other country trades in the default.
COUNTRY_CURRENCY = {
    "United Kingdom": "GBP",
    "EIRE": "GBP",
    "Australia": "AUD",
    "Japan": "JPY",
    "USA": "USD",
    "Canada": "USD",
}
DEFAULT_CURRENCY = "EUR"

# Header spellings of raw extracts.
RAW_HEADERS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

WATERMARK_START = "1900-01-01 00:00:00"
MAX_STOCK_CODE_LENGTH = 10

# Characters that the text columns of the source database hold at most.
TEXT_LIMITS = {
    "transactions": {"invoice_no": 20, "stock_code": 20, "description": 255, "country": 100},
    "customers": {"full_name": 150, "email": 255, "phone": 50, "loyalty_tier": 20, "preferred_store_id": 20},
    "products": {"stock_code": 20, "description": 255, "category": 100, "supplier_id": 20},
    "stores": {"store_id": 20, "store_name": 255, "country": 100, "region": 50, "timezone": 50, "currency_code": 3},
    "pipeline_watermarks": {"pipeline_name": 100},
}
