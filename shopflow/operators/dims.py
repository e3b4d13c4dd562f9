"""Dimension tables derived from the transactions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow import schemas
from shopflow.functions import columns as C, fixed_values as fixed


def customer_keys(tx: DataFrame) -> DataFrame:
    return tx.where("customer_id IS NOT NULL").select("customer_id").distinct()


def customer_country(tx: DataFrame) -> DataFrame:
    """Every customer with their most frequent known country, or null; ties to the first name."""
    lines = tx.where("customer_id IS NOT NULL").groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("lines")
    )
    modal = F.min(F.when(
        F.col("country").isNotNull(),
        F.struct((-F.col("lines")).alias("_desc"), F.col("country").alias("name")),
    ))
    return lines.groupBy("customer_id").agg(modal["name"].alias("country"))


def modal_country(tx: DataFrame) -> DataFrame:
    return customer_country(tx).where("country IS NOT NULL")


def product_dimension(tx: DataFrame, max_length: int = fixed.MAX_STOCK_CODE_LENGTH) -> DataFrame:
    """Per SKU the most frequent description, the mean price and the first day seen.

    One scan: lines shrink to (SKU, description) rows, and those to SKUs.
    """
    per_text = (
        tx.where(F.length("stock_code") <= max_length)
        .groupBy("stock_code", "description")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("unit_price").alias("price"),
            F.count("unit_price").alias("prices"),
            F.min("invoice_date").alias("first"),
        )
    )
    modal = F.min(F.when(
        F.col("description").isNotNull(),
        F.struct((-F.col("lines")).alias("_desc"), F.col("description").alias("text")),
    ))
    return (
        per_text.groupBy("stock_code")
        .agg(
            modal.alias("modal"), F.sum("price").alias("price"),
            F.sum("prices").alias("prices"), F.min("first").alias("first"),
        )
        .select(
            "stock_code",
            F.coalesce("modal.text", F.lit("")).alias("description"),
            F.try_divide("price", "prices").cast(schemas.PRICE).alias("avg_unit_price"),
            F.to_date("first").alias("first_listed_date"),
        )
    )


def stores(spark: SparkSession) -> DataFrame:
    """The fixed store list with its currency rule."""
    listed = spark.createDataFrame(
        fixed.COUNTRY_STORES, "country string, store_id string, region string, timezone string"
    )
    return listed.select(
        "store_id",
        F.concat("country", F.lit(" Online Store")).alias("store_name"),
        "country",
        "region",
        "timezone",
        C.currency_of().alias("currency_code"),
        F.lit(True).alias("is_active"),
        F.lit(None).cast("date").alias("opened_date"),
    )


def preferred_store(tx: DataFrame, stores: DataFrame) -> DataFrame:
    """Store of each customer's modal country; countries without one get the default.

    Of several stores in one country the one of the least id counts, so a customer has one
    row. The join is a plain one: the size of ``stores`` decides how it runs.
    """
    by_country = stores.groupBy("country").agg(F.min("store_id").alias("store_id"))
    return customer_country(tx).join(by_country, "country", "left").select(
        "customer_id",
        F.coalesce("store_id", F.lit(fixed.DEFAULT_STORE_ID)).alias("preferred_store_id"),
    )
