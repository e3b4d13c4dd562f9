"""Extracting, landing and normalising tables."""

import re
from typing import NamedTuple
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from shopflow import schemas
from shopflow.functions import columns as C, fixed_values as fixed
from shopflow.operators import contracts, dedupe

# ---- file scans and sinks -------------------------------------------------------------


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet below ``path`` with exactly the declared columns; folder names add none."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def scan_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """The same as a stream that finds new files by listing the folder.

    ``max_files`` bounds a batch. With ``archive``, files move there once their batch is
    done, so that a listing only ever finds what is new.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def with_lineage(df: DataFrame, now=None) -> DataFrame:
    """Ingest time and source file of a file scan."""
    return df.withColumn("_ingested_at", C.stamp(now)).withColumn(
        "_source_file", F.col("_metadata.file_path")
    )


def with_snapshot_date(df: DataFrame) -> DataFrame:
    """Run date of the landing folder a row was read from; null outside such a folder.

    Snapshots that wait for one run share its ingest time, so only this tells their order.
    """
    day = F.regexp_extract(F.col("_metadata.file_path"), r"run_date=(\d{4}-\d{2}-\d{2})", 1)
    return df.withColumn("_snapshot_date", day.try_cast("date"))


def land_parquet(df: DataFrame, path: str, run_date, part: str | None = None) -> str:
    """Write under the month and day of the run, not of the rows. Returns the folder.

    Running a day again replaces that day's folder, or only the named part of it. Nothing
    else is touched, and a stream that lists ``path`` sees a new snapshot as new files.
    """
    day = str(run_date)
    target = f"{path}/year={day[:4]}/month={day[5:7]}/run_date={day}"
    if part is not None:
        target = f"{target}/part={part}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return target


def landing_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of all run dates, in order; parts of a day are inside its folder."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/run_date=*")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)
    return sorted(f.getPath().toString() for f in found or [])


def landing_violations(spark: SparkSession, path: str, schema: T.StructType, known=()) -> list[tuple[str, str]]:
    """(folder, problems) of landing folders whose files lack or mistype a declared column.

    Reads the footers of every folder but the ``known`` ones. A scan with a declared schema
    would read a missing column as null without notice, and stop at a mistyped one.
    """
    found = []
    for folder in landing_folders(spark, path):
        if folder not in known:
            landed = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(folder)
            problems = contracts.schema_differences(landed, schema)
            if problems:
                found.append((folder, "; ".join(problems)))
    return found


def check_landed(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Raise ContractError when any landing folder breaks the contract."""
    found = landing_violations(spark, path, schema)
    if found:
        raise contracts.ContractError("; ".join(f"{folder}: {problems}" for folder, problems in found))


def outside(folders: list[str]):
    """Condition on a file scan: rows of files that lie in none of the folders.

    It is on file metadata alone, so such files are not opened.
    """
    path = F.col("_metadata.file_path")
    kept = F.lit(True)
    for folder in folders:
        plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", folder)
        kept = kept & ~path.contains(quote(plain, safe="/=:@!$&'()*+,;") + "/")
    return kept


def full_refresh(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Replace a stored table, schema included; enforces the contract when one is given."""
    if schema is not None:
        df = contracts.enforce(df, schema)
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_csv_typed(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Text keeps its blanks, which the writer would trim by default."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **keep).csv(path)


# ---- high-water marks -----------------------------------------------------------------
# Marks are handled as text: a literal made from text keeps every digit of the timestamp
# and does not pass through the driver's time zone.


class Increment(NamedTuple):
    rows: DataFrame
    watermarks: DataFrame
    low: str
    high: str | None


def read_watermark(watermarks: DataFrame, name: str) -> str:
    """The mark of one pipeline, or the start of time when it has none."""
    found = (
        watermarks.where(F.col("pipeline_name") == name)
        .select(F.col("last_watermark_value").cast("string").alias("mark"))
        .head()
    )
    return found.mark if found else fixed.WATERMARK_START


def next_watermark(source: DataFrame, low: str, column: str = "invoice_date") -> str | None:
    """The newest time above ``low``; the filter lets a scan skip what is older."""
    newer = source.where(F.col(column) > F.lit(low).cast("timestamp"))
    return newer.agg(F.max(column).cast("string").alias("mark")).head().mark


def extract_increment(source: DataFrame, low: str, high: str | None,
                      column: str = "invoice_date") -> DataFrame:
    """Rows in ``(low, high]``; both bounds reach a Parquet or JDBC scan as filters."""
    after = F.col(column) > F.lit(low).cast("timestamp")
    rows = source.where(after)
    if high is not None:
        rows = rows.where(F.col(column) <= F.lit(high).cast("timestamp"))
    return rows.select(schemas.RAW_TRANSACTIONS.names)


def extract_late(source: DataFrame, landed: DataFrame, low: str, high: str | None, overlap: str,
                 column: str = "invoice_date") -> DataFrame:
    """Rows in ``(low - overlap, high]`` that are not landed yet, each as often as it is missing.

    Rows that reach the source late, at or below the mark, are taken as long as they are not
    older than the overlap. Rows are compared as a whole and counted, so equal rows of the
    source all land, and a run repeated after a crash lands nothing twice. Both sides are
    cut to the window before they are compared; rows newer than all that is landed there
    cannot be landed and are not compared.
    """
    start = F.lit(low).cast("timestamp") - F.expr(f"INTERVAL {overlap}")

    def window(df):
        rows = df.where(F.col(column) > start)
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high).cast("timestamp"))
        else:
            rows = rows.where(F.col(column) <= F.lit(low).cast("timestamp"))
        return rows.select(schemas.RAW_TRANSACTIONS.names)

    top = window(landed).agg(F.max(F.unix_micros(column)).alias("top")).head().top
    if top is None:
        return window(source)
    comparable = F.col(column) <= F.timestamp_micros(F.lit(top))
    late = window(source).where(comparable).exceptAll(window(landed))
    return late.unionByName(window(source).where(~comparable))


def upsert_watermark(watermarks: DataFrame, name: str, value: str) -> DataFrame:
    """Set the mark of one pipeline, adding the row when there is none."""
    row = watermarks.sparkSession.range(1).select(
        F.lit(name).alias("pipeline_name"),
        F.lit(value).cast("timestamp").alias("last_watermark_value"),
        F.lit(1).alias("_new"),
    )
    both = watermarks.withColumn("_new", F.lit(0)).unionByName(row)
    return dedupe.last_per_key(both, ["pipeline_name"], ["_new"]).drop("_new")


def run_increment(source: DataFrame, watermarks: DataFrame, name: str) -> Increment:
    """The new rows and the watermark table to store once they are safely written.

    The high mark is read first and bounds the copy, so rows that arrive in between are
    left for the next run instead of being copied twice.
    """
    low = read_watermark(watermarks, name)
    high = next_watermark(source, low)
    marks = watermarks if high is None else upsert_watermark(watermarks, name, high)
    return Increment(extract_increment(source, low, high), marks, low, high)


def extract_snapshot(source: DataFrame, schema: T.StructType) -> DataFrame:
    return source.select(schema.names)


# ---- conversion and clean-up ----------------------------------------------------------


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns and types. Decimals are rounded half up; other misfits become null."""
    types = dict(df.dtypes)

    def cast(f):
        if types[f.name] == "string" and isinstance(f.dataType, T.IntegralType):
            return C.whole_number(f.name, f.dataType)
        return F.col(f.name).try_cast(f.dataType)

    return df.select([cast(f).alias(f.name) for f in schema])


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Yearly parts as one table; a column one part lacks is null there."""
    combined, *others = parts
    for part in others:
        combined = combined.unionByName(part, allowMissingColumns=True)
    return combined


def normalise_raw(raw: DataFrame) -> DataFrame:
    """Snake-case headers, parsed types, and no rows without date or stock code.

    Both spellings of the customer column may be present, as after ``union_parts``.
    """
    picked = {}
    for header, name in fixed.RAW_HEADERS.items():
        if header in raw.columns:
            picked.setdefault(name, []).append(F.col(f"`{header}`"))
    df = raw.select([F.coalesce(*cols).alias(name) for name, cols in picked.items()])
    parsed = {
        "invoice_date": F.try_to_timestamp("invoice_date"),
        "quantity": C.whole_number("quantity", "int"),
        "unit_price": F.col("unit_price").try_cast(schemas.PRICE),
        "customer_id": C.whole_number("customer_id", "bigint"),
    }
    return df.withColumns(parsed).na.drop(subset=["invoice_date", "stock_code"])


def canonical_keys(df: DataFrame, columns=("invoice_no", "stock_code", "store_id", "pipeline_name")) -> DataFrame:
    """Trim and upper-case the string keys a table has."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.upper(F.trim(c)) for c in present})


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by an explicit sequence."""
    return dedupe.last_per_key(df, keys, order)


def keep_last_counted(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, Observation, Observation]:
    """``keep_last``, with counts of all and of kept rows (``rows``) that its write fills."""
    before, after = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    return keep_last(df.observe(before, rows), keys, order).observe(after, rows), before, after


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows ``keep_last`` drops."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped_rows"))


# ---- profiles -------------------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return contracts.union_all(counts)


def profile_transactions(tx: DataFrame) -> DataFrame:
    """Rows, date range, distinct customers, SKUs and countries, cancelled lines."""
    return tx.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("stock_code").alias("skus"),
        F.count_distinct("country").alias("countries"),
        F.count_if(C.is_cancelled()).alias("cancelled_lines"),
    )
