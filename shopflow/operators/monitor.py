"""Reading a pipeline's event log."""

from pyspark.sql import DataFrame, functions as F

from shopflow.functions import columns as C

ERROR_DOCUMENT = "exceptions ARRAY<STRUCT<class_name: STRING, message: STRING>>"


def recent_errors(events: DataFrame, now, minutes: int = 30, n: int = 5,
                  levels=("ERROR",)) -> DataFrame:
    """The ``n`` newest events of the given levels within the last ``minutes`` minutes."""
    since = C.stamp(now) - F.make_dt_interval(mins=F.lit(minutes))
    return (
        events.where(F.col("level").isin(*levels) & (F.col("timestamp") >= since))
        .select(
            "timestamp",
            F.coalesce("origin.flow_name", F.lit("N/A")).alias("flow_name"),
            F.coalesce("origin.batch_id", F.lit("")).alias("batch_id"),
            "level", "message", "error",
        )
        .orderBy(F.desc("timestamp"), "message")
        .limit(n)
    )


def explode_exceptions(events: DataFrame) -> DataFrame:
    """One row per exception; text that is not the expected document stays as one message."""
    document = F.from_json("error", ERROR_DOCUMENT)
    return (
        events.where("error IS NOT NULL")
        .withColumn("exception", F.explode_outer(document["exceptions"]))
        .select(
            "timestamp", "level",
            F.coalesce("origin.flow_name", F.lit("N/A")).alias("flow_name"),
            F.col("exception.class_name").alias("class_name"),
            F.when(F.col("exception").isNull(), F.col("error"))
            .otherwise(F.coalesce("exception.message", F.lit(""))).alias("message"),
        )
    )
