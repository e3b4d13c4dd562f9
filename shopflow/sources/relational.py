"""Tables behind JDBC."""

from pyspark.sql import DataFrame, SparkSession

from shopflow.operators import contracts

SINK_BATCH_ROWS = 10_000


def source_options(url: str, table: str, column: str | None = None, lower=None, upper=None,
                   partitions: int | None = None, fetch_rows: int = SINK_BATCH_ROWS) -> dict:
    """Reader options. With a column and bounds the read is split into ranges of it."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def sink_options(url: str, table: str, connections: int = 8) -> dict:
    """Writer options: truncate instead of drop, fixed batches, a bound on connections."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(SINK_BATCH_ROWS),
        "numPartitions": str(connections),
    }


def jdbc_source(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                **split) -> DataFrame:
    """A table by name. Filters and column choice made on the result reach the database."""
    options = source_options(url, table, **split) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()


def jdbc_sink(df: DataFrame, url: str, table: str, properties: dict | None = None,
              connections: int = 8, limits: dict | None = None) -> None:
    """Truncate the table and load it again; its definition and grants stay.

    With ``limits`` (see ``fixed_values.TEXT_LIMITS``) a text that does not fit stops the
    load with its column's name. To keep a loaded table whole, look at ``text_lengths`` first.
    """
    if limits:
        df = contracts.fit_text(df, limits)
    options = sink_options(url, table, connections) | (properties or {})
    df.write.format("jdbc").mode("overwrite").options(**options).save()
