"""Tables bucketed by a key, so that joins and aggregations on it need no shuffle."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from shopflow.sources import stage

BUCKETS = 32


def store(df: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` once, bucketed and sorted by ``key``, and return the stored table.

    Tables that meet by this key must have the same number of buckets. The shuffle by the
    key happens here, once; a task then writes the one file of its bucket.
    """
    spark = df.sparkSession
    path = stage.new_path(spark, name)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
