"""One row per key, chosen by a total order.

``row_number() = 1`` lets Spark plan a partial WindowGroupLimit below the shuffle: each
task keeps one row per key before anything moves. A key that holds a third of all rows
reaches its reducer as one row per map task.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window


def _one_per_key(df, keys, order, direction):
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = Window.partitionBy(*keys).orderBy(
        *[direction(c) for c in [*order, *rest] if c not in keys]
    )
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row smallest by ``order`` (nulls first), then by the other columns."""
    return _one_per_key(df, keys, order, F.asc_nulls_first)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row largest by ``order`` (nulls lowest), then by the other columns."""
    return _one_per_key(df, keys, order, F.desc_nulls_last)
