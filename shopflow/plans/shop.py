"""The tables of one shop, built lazily from the test tables and kept for one query."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shopflow.operators import gold, silver
from shopflow.sources import adapter, stage


class Shop:
    """Raw tables, clean tables, and clean transactions stored as a table.

    ``transactions`` is the lazy plan from the raw files. A job that reads the clean
    transactions several times takes ``stored_transactions``, as a lakehouse job reads its
    silver table, so that the raw joins and the deduplication run once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # The files hold zone-less times that mean UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return adapter.transactions(self.spark, self.sf_dir)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return adapter.customers(self.spark, self.sf_dir)

    @cached_property
    def raw_products(self) -> DataFrame:
        return adapter.products(self.spark, self.sf_dir)

    @cached_property
    def event_log(self) -> DataFrame:
        return adapter.event_log(self.spark, self.sf_dir)

    @cached_property
    def routed(self) -> silver.Routed:
        return silver.route_transactions(self.raw_transactions)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.transactions(self.raw_transactions).drop("_transformed_at")

    @cached_property
    def stored_transactions(self) -> DataFrame:
        return stage.table(self.transactions, "silver-transactions")

    @cached_property
    def stored_raw(self) -> DataFrame:
        """Raw transactions stored once, for a job that needs two of their routes."""
        return stage.table(self.raw_transactions, "raw-transactions")

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers(self.raw_customers).drop("_transformed_at")

    @cached_property
    def products(self) -> DataFrame:
        return silver.clean_products(self.raw_products)

    @cached_property
    def customer_360(self) -> DataFrame:
        """Customer 360 stored once, for jobs that cluster the customers and read them again."""
        made = gold.customer_360(self.stored_transactions, self.customers, self.products, adapter.AS_OF)
        return stage.table(made, "customer-360")
