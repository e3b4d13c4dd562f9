import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopflow.operators import gold, ranking
from shopflow.sources import stage


def same_as_window(df, scores, tiles):
    made = ranking.ntile(df, "id", scores, tiles)
    for name, key in scores.items():
        made = made.withColumn(f"want_{name}", F.ntile(tiles).over(Window.orderBy(F.asc_nulls_first(key), "id")))
    return sum(made.where(F.col(s) != F.col(f"want_{s}")).count() for s in scores) == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 6, 20, 1003])
def test_ntile_equals_the_window(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(10 * n + 1), n)
    rows = [(i, rng.choice([1, 1, 1, None, 3]), rng.randint(-10**9, 10**9), rng.choice([None, 0.5, 2.5])) for i in ids]
    df = spark.createDataFrame(rows, "id long, heavy long, spread long, some double").cache()
    assert same_as_window(df, {"a": F.col("heavy"), "b": -F.col("spread"), "c": F.col("some")}, 5)


def test_many_rows_with_nulls_and_one_heavy_value(spark):
    value = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, 5).otherwise(F.hash("id") % 1000)
    df = stage.table(spark.range(300_000).withColumn("v", value.cast("long")), "many")
    assert same_as_window(df, {"s": F.col("v")}, 5)


def test_one_value_for_all_rows(spark):
    assert same_as_window(spark.range(500).withColumn("v", F.lit(7)), {"s": F.col("v")}, 5)


@pytest.mark.parametrize("few, ranges", [(1, 2), (3, 8), (50, 1024)])
def test_many_steps_of_counting(spark, monkeypatch, few, ranges):
    """With few rows and cuts per step, values, ties and nulls are all narrowed down."""
    monkeypatch.setattr(ranking, "FEW", few)
    monkeypatch.setattr(ranking, "RANGES", ranges)
    rng = random.Random(few)
    wide = [-2**63, 2**63 - 1, 0, 1, 2, 5]
    rows = [(i * 7919 % 10007, rng.choice([None, 1, 1, 1, 9]), rng.choice([None, 0.1, 0.2, 1e300, -1e-300, 5.0]),
             rng.choice(wide), rng.randint(0, 10**6)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, heavy long, some double, wide long, spread long").cache()
    assert same_as_window(df, {f"of_{c}": F.col(c) for c in ("heavy", "some", "wide", "spread")}, 5)


def test_nothing_is_sorted_or_dealt_by_range(spark):
    df = stage.table(spark.range(20_000).withColumn("v", F.col("id") % 17), "some")
    plan = ranking.ntile(df, "id", {"s": F.col("v")}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_text_has_no_tiles(spark):
    with pytest.raises(TypeError, match="string"):
        ranking.ntile(spark.range(3).withColumn("v", F.lit("a")), "id", {"s": F.col("v")}, 5)


def test_scores_of_null_measures(spark):
    rows = [(i, None if i % 4 == 0 else i, i, None) for i in range(20)]
    measures = spark.createDataFrame(
        rows, "customer_id long, days_since_last_purchase int, total_orders long, total_revenue_lifetime decimal(14,2)")
    got = {r.customer_id: r for r in gold.rfm_scores(measures).collect()}
    assert got[0].rfm_recency_score == 1 and got[19].rfm_frequency_score == 5
    assert [got[i].rfm_monetary_score for i in range(20)] == [1 + i // 4 for i in range(20)]
