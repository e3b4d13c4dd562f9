"""The test tables seen as a shop: orders, lines and parts become raw retail tables.

The mapping plants every case the cleaning rules know: cancelled invoices, returns with a
negative quantity, negative prices, lines without a date, cancellations on days without a
sale, guests without customer id, give-aways at price zero, codes in lower case or sold for
a month only, bad and padded e-mail addresses, unknown loyalty tiers, uncategorised and
unlisted products, and a second snapshot. It only derives values; every row of the tables takes part.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.operators import contracts

AS_OF = "2001-08-02"
NOW = "2024-01-31 00:00:00"

# Nations that stand for countries of the store list; the others keep their own name.
NATION_COUNTRY = {
    "NATION_0": "United Kingdom",
    "NATION_1": "Germany",
    "NATION_2": "France",
    "NATION_3": "EIRE",
    "NATION_4": "Australia",
    "NATION_5": "Japan",
    "NATION_6": "USA",
    "NATION_7": "Canada",
}

PRICE_SQL = "CAST(CASE WHEN p_type = 'PROMO' AND p_size <= 3 THEN 0 ELSE p_retailprice END AS DECIMAL(10,2))"

# Some parts are sold under a code per month, which is long and has few weeks of sales; a
# few codes were typed in lower case with blanks around.
CODE_SQL = """CASE WHEN l_linenumber = 3 AND l_orderkey % 61 = 0 THEN ' sku' || CAST(l_partkey AS STRING) || ' '
    WHEN l_partkey % 40 = 0 THEN 'SKU' || CAST(l_partkey AS STRING) || '-'
         || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)
    ELSE 'SKU' || CAST(l_partkey AS STRING) END"""

# Some cancellations fall on days without a sale; a few lines have no date.
DATE_SQL = """CASE WHEN l_linenumber = 1 AND _returned AND l_orderkey % 50 = 0
         THEN make_date(1990, 1, CAST(1 + l_orderkey % 28 AS INT))
    WHEN l_linenumber = 2 AND l_orderkey % 83 = 0 THEN NULL ELSE o_orderdate END"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose scan has fewer splits than there are cores, dealt over all of them.

    The lines meet four tables before their first shuffle; one file of one row group would
    do all of that in one task. A scan of many splits is left as it is.
    """
    rows = read(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _country():
    chain = F
    for nation, country in NATION_COUNTRY.items():
        chain = chain.when(F.col("n_name") == nation, F.lit(country))
    return chain.otherwise(F.col("n_name"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw transaction line per lineitem."""
    # What a row needs of a table is derived before the joins: less is shuffled by them.
    lines = read_spread(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.expr("l_returnflag = 'R'").alias("_returned"),
        F.expr("CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN -l_quantity"
               " ELSE l_quantity END AS INT)").alias("quantity"),
    )
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.expr("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'"
               " THEN NULL ELSE o_custkey END").alias("customer_id"),
    )
    part = read(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("description"), F.expr(PRICE_SQL).alias("_price"))
    supplier, nation = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    # Each table joins the lines on its own, so that its file size decides on a broadcast.
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(part, lines.l_partkey == part.p_partkey)
        .join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            F.expr("CASE WHEN _returned AND l_linenumber = 1 THEN 'C' ELSE '' END"
                   " || CAST(l_orderkey AS STRING)").alias("invoice_no"),
            F.expr(CODE_SQL).alias("stock_code"),
            "description",
            "quantity",
            F.expr(DATE_SQL).cast("timestamp").alias("invoice_date"),
            F.expr("CAST(CASE WHEN l_linenumber = 3 AND l_orderkey % 89 = 0 THEN -1 ELSE _price END"
                   " AS DECIMAL(10,2))").alias("unit_price"),
            "customer_id",
            _country().alias("country"),
        )
    )


def customer_snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two full daily snapshots; the second one promotes the customers with a high balance."""
    nation = read(spark, sf_dir, "nation")
    customer = read(spark, sf_dir, "customer")
    base = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "c_name").alias("full_name"),
        F.expr("""CASE WHEN c_acctbal < 0 THEN 'not-an-email'
                       WHEN n_name = 'NATION_9' THEN NULL
                       WHEN c_mktsegment = 'MACHINERY' THEN 'USER' || CAST(c_custkey AS STRING) || '@EXAMPLE.COM'
                       WHEN c_mktsegment = 'FURNITURE' THEN ' user' || CAST(c_custkey AS STRING) || '@example.com '
                       ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END""").alias("email"),
        F.expr("""CASE n_regionkey WHEN 0 THEN 'gold' WHEN 1 THEN 'Silver' WHEN 2 THEN 'BRONZE '
                       WHEN 3 THEN 'Platinum' ELSE 'Diamond' END""").alias("loyalty_tier"),
        F.expr("c_acctbal > 9000").alias("is_wholesaler"),
        F.expr("c_mktsegment = 'AUTOMOBILE'").alias("marketing_opt_in"),
        "c_acctbal",
    )
    first = base.withColumn("_ingested_at", F.expr("TIMESTAMP '2001-08-01 00:00:00'"))
    second = base.withColumn(
        "loyalty_tier", F.expr("CASE WHEN c_acctbal >= 8000 THEN ' platinum' ELSE loyalty_tier END")
    ).withColumn("_ingested_at", F.expr("TIMESTAMP '2001-08-02 00:00:00'"))
    return [first.drop("c_acctbal"), second.drop("c_acctbal")]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.union_all(customer_snapshots(spark, sf_dir))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue: one brand is not listed, and each region adds a product nobody bought."""
    listed = read(spark, sf_dir, "part").where("p_brand <> 'Brand#13'").select(
        F.expr("'SKU' || CAST(p_partkey AS STRING)").alias("stock_code"),
        F.expr("' ' || p_name").alias("description"),
        F.expr("CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_brand = 'Brand#2' THEN ' '"
               " ELSE p_type END").alias("category"),
        F.expr(PRICE_SQL).alias("avg_unit_price"),
    )
    unsold = read(spark, sf_dir, "region").select(
        F.expr("'SKU-U' || CAST(r_regionkey AS STRING)").alias("stock_code"),
        F.lit("never sold").alias("description"),
        F.lit("UNSOLD").alias("category"),
        F.expr("CAST(1 AS DECIMAL(10,2))").alias("avg_unit_price"),
    )
    return contracts.union_all([listed, unsold]).withColumn(
        "_ingested_at", F.expr("TIMESTAMP '2001-08-02 00:00:00'")
    )


def product_snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two full daily snapshots; on the first one all was dearer and of another category."""
    second = products(spark, sf_dir).drop("_ingested_at")
    first = second.withColumns({
        "category": F.lit("EARLIER"),
        "avg_unit_price": (F.col("avg_unit_price") + 1).cast("decimal(10,2)"),
    })
    return [first, second]


def raw_extract_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Lines as text in two parts that spell the customer column differently.

    Some dates, quantities and stock codes are missing or are not what they should be.
    """
    lines, orders = read_spread(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    text = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.expr("CAST(l_orderkey AS STRING)").alias("Invoice"),
        F.expr("CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN NULL"
               " ELSE 'sku' || CAST(l_partkey AS STRING) END").alias("StockCode"),
        F.col("l_shipdate").cast("date").cast("string").alias("Description"),
        F.expr("CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS DECIMAL(10,1)) AS STRING) END")
        .alias("Quantity"),
        F.expr("CASE WHEN l_linenumber = 6 THEN 'unknown'"
               " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 08:26:00' END").alias("InvoiceDate"),
        F.expr("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)").alias("Price"),
        F.expr("CAST(o_custkey AS STRING) || '.0'").alias("_customer"),
        F.col("o_orderpriority").alias("Country"),
        "o_orderstatus",
    )
    open_orders = F.col("o_orderstatus") == "O"
    return [
        text.where(open_orders).withColumnRenamed("_customer", "Customer ID").drop("o_orderstatus"),
        text.where(~open_orders).withColumnRenamed("_customer", "CustomerID").drop("o_orderstatus"),
    ]


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as pipeline log rows with a nested origin and an error document."""
    return read(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.expr("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END")
        .alias("level"),
        F.expr("event_type || ' ' || CAST(event_id AS STRING)").alias("message"),
        F.struct(
            F.expr("CASE WHEN value < 5 THEN NULL ELSE 'flow_' || CAST(user_id AS STRING) END")
            .alias("flow_name"),
            F.expr("CAST(event_id AS STRING)").alias("batch_id"),
        ).alias("origin"),
        F.expr("""CASE WHEN event_type <> 'error' THEN NULL
                       WHEN value < 10 THEN 'broken ' || props
                       ELSE '{"exceptions":[{"class_name":"Outer","message":"event ' || CAST(event_id AS STRING)
                            || '"},{"class_name":"Inner","message":"user ' || CAST(user_id AS STRING) || '"}]}'
                  END""").alias("error"),
    )


def with_all_columns(df: DataFrame, schema) -> DataFrame:
    """The declared columns of a raw table; those the test tables lack are null."""
    return df.select([
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema
    ])
