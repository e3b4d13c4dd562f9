"""Jobs that need one step several times run it once, on stored rows."""

import pytest
from pyspark.sql import functions as F

from shopflow.plans import queries, shop
from shopflow.plans.queries import QUERIES
from shopflow.sources import stage


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A tiny shop: 20 customers, 60 orders of two lines over 20 weeks."""
    base = str(tmp_path_factory.mktemp("tables"))
    made = {
        "region": spark.range(2).selectExpr("CAST(id AS INT) r_regionkey", "'R' || id r_name"),
        "nation": spark.range(3).selectExpr("CAST(id AS INT) n_nationkey", "'NATION_' || id n_name", "CAST(id % 2 AS INT) n_regionkey"),
        "customer": spark.range(20).selectExpr(
            "id c_custkey", "'C' || id c_name", "CAST(id % 3 AS INT) c_nationkey", "DOUBLE(100 + id) c_acctbal", "'BUILDING' c_mktsegment"),
        "supplier": spark.range(4).selectExpr("id s_suppkey", "'S' || id s_name", "CAST(id % 3 AS INT) s_nationkey", "1D s_acctbal"),
        "part": spark.range(5).selectExpr(
            "id p_partkey", "'P' || id p_name", "'Brand#' || (id + 20) p_brand", "'T' || id p_type", "CAST(9 AS INT) p_size",
            "DOUBLE(10 + id) p_retailprice"),
        "orders": spark.range(60).selectExpr(
            "id o_orderkey", "id % 20 o_custkey", "'O' o_orderstatus", "1D o_totalprice",
            "CAST(date_add(DATE '1998-03-02', CAST(id * 7 % 140 AS INT)) AS TIMESTAMP) o_orderdate", "'1-URGENT' o_orderpriority"),
        "lineitem": spark.range(120).selectExpr(
            "id % 60 l_orderkey", "id % 5 l_partkey", "id % 4 l_suppkey", "CAST(1 + id DIV 60 AS INT) l_linenumber",
            "DOUBLE(1 + id % 7) l_quantity", "5D l_extendedprice", "0D l_discount", "0D l_tax",
            "CASE WHEN id % 50 = 1 THEN 'R' ELSE 'N' END l_returnflag", "'F' l_linestatus", "TIMESTAMP '1998-05-01' l_shipdate"),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("name", ["customer_360_segments", "gate_summary", "gate_promote", "daily_kpis_incremental"])
def test_raw_lines_are_joined_once(spark, tables, monkeypatch, name):
    reads, table = [], stage.table

    def recorded(df, to):
        reads.append(any("lineitem.parquet" in f for f in df.inputFiles()))
        return table(df, to)

    monkeypatch.setattr(stage, "table", recorded)
    made = QUERIES[name](spark, tables)
    reads.append(any("lineitem.parquet" in f for f in made.inputFiles()))
    assert sum(reads) == 1
    assert made.count() > 0


def test_segments_are_filled_in_and_nothing_else_changes(spark, tables):
    s = shop.Shop(spark, tables)
    whole = s.customer_360.drop("customer_segment")
    made = QUERIES["customer_360_segments"](spark, tables)
    assert whole.columns and made.drop("customer_segment").exceptAll(whole.drop("_rebuilt_at").select(
        made.drop("customer_segment").columns)).count() == 0
    named = queries._segments(*queries._fixed_model(s))
    assert made.where(F.col("customer_segment").isNotNull()).count() == named.count() > 0
