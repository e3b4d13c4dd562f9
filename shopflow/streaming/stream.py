"""Streaming stages. The row-wise cleaning functions are the batch ones."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions import columns as C
from shopflow.operators import dedupe as dedupe_rows, silver
from shopflow.sources import partitions, stage, versioned

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State without a time bound outgrows executor memory; RocksDB spills it to disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def drain(writer, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop. Output files commit exactly once."""
    query = (
        writer.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return drain(df.writeStream, path, checkpoint)


def append_by(df: DataFrame, column: str, path: str, checkpoint: str) -> StreamingQuery:
    """Several tables from one scan: one folder per value of ``column``."""
    return drain(df.writeStream.partitionBy(column), path, checkpoint)


def dedupe(df: DataFrame, keys: list[str], watermark: tuple[str, str] | None = None,
           splits: int = 1) -> DataFrame:
    """First arrival per key.

    Without a watermark the result is exact and the state grows with the keys. With
    ``(time column, delay)`` state is dropped after the delay, and a copy that comes later
    than that passes.

    A stream has no map-side combine: all copies of a key go to the task that holds its
    state. With ``splits`` above 1 a first pass drops copies per (key, group of input
    tasks), so the task of a hot key gets at most ``splits`` rows of it. The first pass
    keeps its own state, about as much again.
    """
    if watermark is not None:
        df = df.withWatermark(*watermark)

    def once(rows, columns):
        if watermark is None:
            return rows.dropDuplicates(columns)
        return rows.dropDuplicatesWithinWatermark(columns)

    if splits > 1:
        df = df.withColumn("_split", F.spark_partition_id() % splits)
        df = once(df, [*keys, "_split"]).drop("_split")
    return once(df, keys)


def silver_transactions(bronze: DataFrame, now=None, watermark: tuple[str, str] | None = None,
                        splits: int = 1) -> DataFrame:
    valid = silver.route_transactions(bronze).valid
    once = dedupe(valid, ["invoice_no", "stock_code"], watermark, splits)
    return silver.enrich_transactions(once, now)


def rejected_sides(bronze: DataFrame, route, reasons: dict, now=None) -> DataFrame:
    """All rows that leave the main path, with their route and reason, in one frame.

    ``route`` names the table of a row; ``reasons`` maps a route to its reason column.
    """
    reason = F
    for name, column in reasons.items():
        reason = reason.when(F.col("route") == name, column)
    stamp = C.stamp(now)
    return (
        bronze.withColumn("route", route)
        .where("route <> 'valid'")
        .withColumn("reason", reason)
        .withColumn("routed_at", stamp)
    )


def for_each_batch(rows: DataFrame, write, checkpoint: str) -> StreamingQuery:
    """Hand every batch, with its number, to ``write``; it must give the same when repeated."""
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_batch(rows: DataFrame, base: str, batch_id: int) -> None:
    """One folder per batch: a batch that is repeated replaces its own rows only."""
    rows.write.mode("overwrite").parquet(f"{base}/batch={batch_id}")


def key_part(key: str, tail: int = 6):
    """Partition of a key: the key without its last ``tail`` signs.

    Equal keys share it whatever their date, and numbers given out in order keep the keys
    of a batch in few partitions.
    """
    return F.concat(F.lit("p"), F.substring(F.col(key), F.lit(1), F.greatest(F.length(key) - tail, F.lit(0))))


# A batch with more partitions than this is compared with all stored keys.
MAX_PARTS = 1000
# A batch of fewer rows is brought together by key, so that it is written as few files; so is
# one with more key hashes on several rows than MAX_SHARED.
FEW_ROWS = 100_000
MAX_SHARED = 1_000_000
# Up to this many partitions every task writes its own file into each: nothing is shuffled.
FEW_PARTS = 128


def stored_rows(spark: SparkSession, base: str, columns: T.StructType, batches: list[int],
                parts: list[str] | None) -> DataFrame:
    """Stored columns of some batches; with ``parts``, only files of these partitions are opened."""
    schema = T.StructType([*columns.fields, T.StructField("_part", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/batch={n}" for n in batches])
    return rows if parts is None else rows.where(F.col("_part").isin(parts))


def parts_of(rows: DataFrame) -> list[str] | None:
    """Partitions of keys that rows touch, None when there are more than MAX_PARTS."""
    found = [r[0] for r in rows.select("_part").distinct().limit(MAX_PARTS + 1).collect()]
    return found if len(found) <= MAX_PARTS else None


def append_batch(batch: DataFrame, batch_id: int, base: str, keys: list[str], order: list[str],
                 finish=lambda df: df, tail: int = 6) -> None:
    """Append the rows of a batch whose key no earlier batch stored, the first by ``order``.

    Within a batch the choice is the batch rule, so it does not depend on arrival; between
    batches what was stored stays. Rows are stored by the ``key_part`` of the first key, so
    only files that may hold the batch's keys are opened, and of these only the key columns.
    """
    spark = batch.sparkSession
    found = batch.groupBy(key_part(keys[0], tail).alias("_part")).count().limit(MAX_PARTS + 1).collect()
    parts = [r[0] for r in found] if len(found) <= MAX_PARTS else None
    earlier = [n for n in versioned.numbers(spark, base, "batch=") if n < batch_id]
    stored = None
    if earlier:
        wanted = T.StructType([batch.schema[k] for k in keys])
        stored = stored_rows(spark, base, wanted, earlier, parts).select(keys)
    if parts is None or sum(r[1] for r in found) >= FEW_ROWS:
        once = _first_copies(batch, stored, keys, order)
    else:
        once = _unmet(stage.table(dedupe_rows.first_per_key(batch, keys, order), "batch"), stored, keys)
    made = finish(once).withColumn("_part", key_part(keys[0], tail))
    if parts is None or len(parts) > FEW_PARTS:
        # A number that is given is kept: neighbours are not put together into tasks that
        # write most of the files one after the other.
        made = made.repartition(_tasks(spark), "_part")
    made.write.mode("overwrite").partitionBy("_part").parquet(f"{base}/batch={batch_id}")


def _first_copies(batch, stored, keys, order):
    """The first row by ``order`` of each key of a batch that is not among the stored keys.

    A key whose hash stands on one row only, stored ones included, has no copy: its row stays
    where it is. Only the others, mostly few, are shuffled and compared as they are.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    seen = batch.select(hashed) if stored is None else batch.select(hashed).unionByName(stored.select(hashed))
    shared = stage.table(seen.groupBy("_hash").count().where("count > 1").select("_hash"), "shared")
    some = shared.count()
    if some == 0:
        return batch
    if some > MAX_SHARED:
        return _unmet(stage.table(dedupe_rows.first_per_key(batch, keys, order), "batch"), stored, keys)

    def rows(df, how):
        return df.withColumn("_hash", hashed).join(F.broadcast(shared), "_hash", how).drop("_hash")

    copies = dedupe_rows.first_per_key(rows(batch, "left_semi"), keys, order)
    unmet = _unmet(copies, None if stored is None else rows(stored, "left_semi"), keys)
    return rows(batch, "left_anti").unionByName(unmet)


def _unmet(once, stored, keys):
    """Rows of a batch whose key is not stored."""
    if stored is None:
        return once
    # The batch is the smaller side: stored keys are reduced to those it has. They are
    # stored, so that their size decides whether the batch has to be shuffled to meet them.
    met = stage.table(stored.join(once.select(keys), keys, "left_semi"), "met")
    return once.join(met, keys, "left_anti").select(once.columns)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def append_first(rows: DataFrame, base: str, keys: list[str], order: list[str], checkpoint: str,
                 finish=lambda df: df, tail: int = 6) -> StreamingQuery:
    """``append_batch`` for every batch of a stream."""
    return for_each_batch(
        rows, lambda batch, n: append_batch(batch, n, base, keys, order, finish, tail), checkpoint)


def merge_buckets(batch: DataFrame, base: str, schema: T.StructType, keys: list[str], order: list[str],
                  buckets: int = 64) -> None:
    """The latest row per key of the table and the batch; untouched buckets are not rewritten.

    The table is partitioned by a hash of its keys (``_bucket``), and a batch replaces the
    buckets of its own keys only. Merging a batch once more changes nothing.
    """
    spark, whole = batch.sparkSession, bucketed(schema)
    latest = silver.scd1_latest(batch.select(schema.names), keys, order)
    rows = stage.table(latest.withColumn("_bucket", bucket_of(keys, buckets)), "batch")
    stored = partitions.read(spark, base, whole)
    if stored is not None:
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]
        rows = silver.scd1_latest(stored.where(F.col("_bucket").isin(touched)).unionByName(rows), keys, order)
    partitions.swap(rows, base, whole)


def bucketed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_buckets(rows: DataFrame, base: str, schema: T.StructType, keys: list[str], order: list[str],
                   checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """``merge_buckets`` for every batch of a stream."""
    return for_each_batch(
        rows, lambda batch, n: merge_buckets(batch, base, schema, keys, order, buckets), checkpoint)


def merge_scd1(batch: DataFrame, base: str, schema: T.StructType, keys: list[str], order: list[str],
               batch_id: int) -> None:
    """The version after ``batch``: the latest row per key of it and the version before."""
    spark = batch.sparkSession
    rows = batch.select(schema.names)
    stored = versioned.current(spark, base, schema, before=batch_id)
    if stored is not None:
        rows = stored.unionByName(rows)
    versioned.publish(silver.scd1_latest(rows, keys, order), base, batch_id)
    versioned.prune(spark, base)


def upsert_scd1(stream: DataFrame, base: str, schema: T.StructType, keys: list[str],
                order: list[str], checkpoint: str) -> StreamingQuery:
    """Latest row per key over all batches, as versions of a table.

    A batch reads the newest version below its own number, so repeating it after a crash
    gives the same table again.
    """

    return for_each_batch(
        stream, lambda batch, n: merge_scd1(batch, base, schema, keys, order, n), checkpoint
    )
