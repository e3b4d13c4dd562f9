"""Schema contracts and data-quality rules."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from shopflow.functions import columns as C


class ContractError(ValueError):
    """A table does not have the declared columns, types or required values."""


def schema_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """Missing, unknown and differently typed columns. Nothing is read."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    return (
        [f"missing column {n}" for n in want if n not in have]
        + [f"unknown column {n}" for n in have if n not in want]
        + [
            f"column {n} is {have[n].simpleString()}, declared {want[n].simpleString()}"
            for n in want
            if n in have and have[n] != want[n]
        ]
    )


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, null_rows) per required column, from one aggregate over the table."""
    required = [f.name for f in schema if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_rows")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand on several rows, or hold a null, with the number of rows."""
    broken = F.lit(False)
    for k in keys:
        broken = broken | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | broken)


def check_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Return ``df``, or raise ContractError naming a few of the keys that are not unique."""
    # A key on several rows has a hash on several rows, which is less to group by.
    broken = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    hashes = df.groupBy(F.xxhash64(*keys)).agg(F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("nulls"))
    if hashes.where("rows > 1 OR nulls > 0").count() == 0:
        return df
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise ContractError(f"{name}: not unique by {', '.join(keys)}: {[tuple(r) for r in bad]}")
    return df


def check_contract(df: DataFrame, schema: T.StructType, nulls: bool = True) -> DataFrame:
    """Return ``df`` in declared column order, or raise ContractError."""
    problems = schema_differences(df, schema)
    if not problems and nulls and any(not f.nullable for f in schema):
        bad = null_violations(df, schema).where("null_rows > 0").collect()
        problems = [f"{r.null_rows} nulls in required column {r.column_name}" for r in bad]
    if problems:
        raise ContractError("; ".join(problems))
    return df.select([f.name for f in schema])


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in declared order; the job that reads it fails on a null in a required column.

    The check rides along in the projection of the write, so it costs no pass of its own
    and nothing is committed when it fails.
    """
    checked = check_contract(df, schema, nulls=False)

    def required(name):
        fail = F.raise_error(F.lit(f"null in required column {name}"))
        return F.coalesce(F.col(name), fail).alias(name)

    return checked.select([f.name if f.nullable else required(f.name) for f in schema])


def text_lengths(df: DataFrame, limits: dict) -> DataFrame:
    """(column_name, max_length, longest, too_long_rows) per limited column, in one pass."""
    def measured(name, limit):
        length = F.length(name)
        return F.struct(F.lit(name).alias("column_name"), F.lit(limit).alias("max_length"), F.max(length).alias("longest"),
                        F.count_if(length > limit).alias("too_long_rows"))

    found = df.agg(F.array(*[measured(c, n) for c, n in limits.items() if c in df.columns]).alias("found"))
    return found.select(F.inline("found"))


def fit_text(df: DataFrame, limits: dict) -> DataFrame:
    """The same rows; the job that reads them fails on a text beyond its limit.

    As in ``enforce``, the check rides along in the projection of the write: a database would
    refuse the row or cut the text after others had been written.
    """
    def fitting(name):
        if name not in limits:
            return F.col(name)
        fail = F.raise_error(F.lit(f"text of more than {limits[name]} characters in column {name}"))
        return F.when(F.length(name) > limits[name], fail).otherwise(F.col(name)).alias(name)

    return df.select([fitting(c) for c in df.columns])


def expect_all(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """Split into rows meeting every rule and rows with the names of the broken ones."""
    kept = df.where(C.passes_all(rules))
    failed = df.withColumn("failed_rules", C.failed_rules(rules)).where("size(failed_rules) > 0")
    return kept, failed


def expectation_report(df: DataFrame, rules: dict) -> DataFrame:
    """(rule, passed_rows, failed_rows) for every rule, in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~C.passes(rule)).alias(name) for name, rule in rules.items()],
    )
    return counts.unpivot(["_rows"], list(rules), "rule", "failed_rows").select(
        "rule", (F.col("_rows") - F.col("failed_rows")).alias("passed_rows"), "failed_rows"
    )


def watch_rules(df: DataFrame, rules: dict) -> tuple[DataFrame, Observation]:
    """The same rows, and counts per rule that the next action on them fills.

    The counts ride along in the job that writes the rows, so they cost no pass of their own.
    """
    seen = Observation()
    return df.observe(
        seen, F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~C.passes(rule)).alias(name) for name, rule in rules.items()]), seen


def watched_report(spark: SparkSession, seen: Observation, rules: dict) -> DataFrame:
    """What ``expectation_report`` gives, from the counts of a finished write."""
    counts = seen.get
    rows = [(name, counts["_rows"] - counts[name], counts[name]) for name in rules]
    return spark.createDataFrame(rows, "rule string, passed_rows long, failed_rows long")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
