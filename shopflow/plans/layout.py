"""Where the tables of one lakehouse live, and what every job holds to."""

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopflow.sources import stage, versioned


JOB_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


@dataclass(frozen=True)
class Layout:
    """Folders of a lakehouse: tables of one generation, and models beside all of them."""

    root: str

    def table(self, layer: str, name: str) -> str:
        if layer == "ml":
            return f"{self.root.rpartition('/')[0]}/ml/{name}"
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def published(self, spark: SparkSession, layer: str, name: str) -> DataFrame | None:
        """The newest complete version of a gold or ml table, None when there is none."""
        return versioned.current(spark, self.table(layer, name))


def open_layout(spark: SparkSession, out_dir: str, mode: str) -> Layout:
    """The newest complete generation, or a new one on a full refresh.

    A full refresh starts new tables and new checkpoints. The generation before stays the
    current one until ``complete`` marks the new one; a refresh that stopped on the way is
    left behind. A very first run that stopped is gone on with.
    """
    if mode not in ("incremental", "full_refresh"):
        raise ValueError(f"mode is incremental or full_refresh, not {mode}")
    begun = versioned.numbers(spark, out_dir, "generation=", completed=False)
    done = versioned.numbers(spark, out_dir, "generation=")
    if mode == "full_refresh":
        number = begun[-1] + 1 if begun else 0
    else:
        number = (done or begun or [0])[-1]
    return Layout(f"{out_dir}/generation={number}")


def complete(spark: SparkSession, lake: Layout) -> None:
    versioned.mark_complete(spark, lake.root)


@contextmanager
def job(spark: SparkSession):
    """Run a job in UTC, whatever zone the session is in, and drop what it staged.

    Times are stored as whole microseconds: Parquet keeps no bounds of the older 12-byte form,
    so that scans could not skip by them, and it takes longer to write.
    """
    kept = {k: spark.conf.get(k) for k in JOB_CONF}
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    try:
        with stage.scope(spark):
            yield
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
