"""Lookup of a fact table in a dimension that may be small or large."""

from pyspark.sql import DataFrame


def lookup(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """``fact`` left join ``dim`` on one column; ``dim`` has one row per key.

    Left to Spark on purpose: a dimension whose size is below the broadcast threshold is
    broadcast and the facts stay; a larger one is shuffled, and adaptive execution splits
    the fact rows of a hot key, with one copy of its dimension row per part.
    """
    return fact.join(dim, on, "left")
