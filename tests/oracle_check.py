"""Run registered queries and their SQL side by side and compare columns, types and values.

    python tests/oracle_check.py [folder of test tables] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def session(cores="local[8]", partitions=8):
    return (
        SparkSession.builder.master(cores)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _duck_type(spark_type):
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK[spark_type]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def compare(spark, con, folder, fn, sql):
    """Empty text when both sides agree, else the first difference."""
    df = fn(spark, folder)
    names = sorted(df.columns)
    df = df.select(names)
    left = _sorted(df.collect())
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return f"columns {names} != {sorted(described)}"
    types = [
        f"{n}: {t} != {described[n]}" for n, t in df.dtypes
        if _duck_type(t) != described[n].replace(" ", "")
    ]
    if types:
        return f"types {types}"
    columns = ", ".join(f'"{n}"' for n in names)
    right = _sorted(con.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{names}: {a} != {b}"
    return ""


def main():
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries), set(sqls) - set(queries)
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name in sqls:
                result = compare(spark, con, folder, queries[name], sqls[name])
            else:
                rows = queries[name](spark, folder).count()
                result = "" if rows else "no rows"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(result)
        mark = "no sql" if name not in sqls else "ok"
        print(f"{name:32s} {time.time() - start:6.2f}s {result or mark}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
