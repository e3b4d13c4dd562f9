from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from rows import D, day, ts

from shopflow import schemas
from shopflow.operators import contracts, forecast

MONDAY = day("2010-01-04")


def series(spark, units_by_sku):
    rows = [
        (sku, MONDAY + timedelta(weeks=i), u)
        for sku, units in units_by_sku.items() for i, u in enumerate(units) if u is not None
    ]
    return spark.createDataFrame(rows, "stock_code string, week_start date, units_sold long")


def test_top_skus_breaks_ties_by_code(spark):
    tx = spark.createDataFrame([(c,) for c in "CCBBAAD"], "stock_code string")
    assert [tuple(r) for r in forecast.top_skus(tx, 2).collect()] == [("A", 2), ("B", 2)]


def test_weeks_start_on_monday(spark):
    tx = spark.createDataFrame([
        ("A", ts("2010-12-05 23:59"), 2), ("A", ts("2010-12-06 00:00"), 3), ("A", ts("2010-12-12 10:00"), 4),
        ("B", ts("2010-12-12 10:00"), 9),
    ], "stock_code string, invoice_date timestamp, quantity int")
    only_a = spark.createDataFrame([("A",)], "stock_code string")
    rows = {tuple(r) for r in forecast.weekly_sales(tx, only_a).collect()}
    assert rows == {("A", day("2010-11-29"), 2), ("A", day("2010-12-06"), 7)}


def test_missing_weeks_are_zero(spark):
    filled = forecast.fill_weeks(series(spark, {"A": [5, None, None, 7], "B": [1]}))
    rows = sorted(tuple(r) for r in filled.collect())
    assert [r[2] for r in rows] == [5, 0, 0, 7, 1]
    assert [r[1] for r in rows[:4]] == [MONDAY + timedelta(weeks=i) for i in range(4)]


def test_split_holds_out_the_last_weeks(spark):
    made = forecast.split(series(spark, {"A": list(range(1, 11))})).orderBy("week_start").collect()
    assert [r.is_train for r in made] == [True] * 6 + [False] * 4
    assert [r.week_no for r in made] == list(range(10))


def test_short_series_are_skipped_with_a_reason(spark):
    weekly = series(spark, {"LONG": [1] * 12, "SHORT": [1] * 11, "ONE": [1]})
    rows = {(r.stock_code, r.train_weeks) for r in forecast.skipped(weekly).collect()}
    assert rows == {("SHORT", 7), ("ONE", 0)}
    for fitted in (forecast.fit(weekly, 4), forecast.refit(weekly)):
        assert [r.stock_code for r in fitted.collect()] == ["LONG"]


def test_constant_series_is_forecast_exactly(spark):
    weekly = series(spark, {"A": [10] * 120})
    errors = forecast.backtest(weekly, forecast.fit(weekly, 4)).first()
    assert errors.mae == pytest.approx(0, abs=1e-9) and errors.mape == pytest.approx(0, abs=1e-9)
    rows = forecast.predict(forecast.refit(weekly)).orderBy("forecast_date").collect()
    assert [r.forecast_date for r in rows] == [MONDAY + timedelta(weeks=120 + i) for i in range(12)]
    for r in rows:
        assert r.predicted_units == pytest.approx(10)
        assert r.lower_bound_80 == pytest.approx(10, abs=1e-5)
        assert r.upper_bound_80 == pytest.approx(10, abs=1e-5)


def test_seasonal_series_is_followed(spark):
    weeks = [MONDAY + timedelta(weeks=i) for i in range(156)]
    units = [300 if w.month == 12 else 100 for w in weeks]
    fitted = forecast.refit(series(spark, {"A": units}))
    index = fitted.first().month_index
    assert sum(index) / 12 == pytest.approx(1)
    assert index[11] / index[5] == pytest.approx(3, rel=0.1)


def test_unseen_months_have_the_neutral_index(spark):
    fitted = forecast.refit(series(spark, {"A": [10] * 13}))
    assert fitted.first().month_index == pytest.approx([1.0] * 12)


def test_falling_series_never_goes_below_zero(spark):
    weekly = series(spark, {"A": [max(0, 100 - 3 * i) for i in range(40)]})
    rows = forecast.predict(forecast.refit(weekly)).collect()
    assert len(rows) == 12
    assert all(0 <= r.lower_bound_80 <= r.predicted_units <= r.upper_bound_80 for r in rows)


def test_series_without_train_sales_is_fitted(spark):
    weekly = series(spark, {"A": [0] * 10 + [5] * 4})
    assert forecast.backtest(weekly, forecast.fit(weekly, 4)).first().mae == pytest.approx(5, abs=1e-3)


def test_mape_is_shifted_away_from_zero(spark):
    weekly = series(spark, {"A": [10] * 100 + [0, 0, 0, 0]})
    error = forecast.backtest(weekly, forecast.fit(weekly, 4)).first()
    assert error.mae == pytest.approx(10) and error.mape == pytest.approx(10 / 1e-6)


def test_gold_rows_meet_the_contract(spark):
    params = forecast.refit(series(spark, {"A": [10] * 20}))
    rows = forecast.to_gold(forecast.predict(params), "3", "r1")
    checked = contracts.check_contract(rows, schemas.DEMAND_FORECAST)
    assert checked.count() == 12 and checked.columns == schemas.DEMAND_FORECAST.names


def test_series_of_all_skus_moves_once_by_sku(spark):
    tx = spark.createDataFrame(
        [("A", ts("2010-12-05 23:59"), 2)], "stock_code string, invoice_date timestamp, quantity int"
    )
    made = forecast.predict(forecast.refit(forecast.weekly_for(tx, None)))
    plan = made._jdf.queryExecution().executedPlan().toString()
    # One shuffle for the weekly totals and one to bring a SKU's weeks together.
    assert plan.count("Exchange hashpartitioning") == 2


def test_series_are_dealt_over_all_tasks(spark):
    days = [(f"S{i}", "2024-01-01", 1) for i in range(200)]
    weekly = spark.createDataFrame(days, "stock_code string, week_start string, units_sold long").withColumn(
        "week_start", F.col("week_start").cast("date"))
    observed = forecast.observe(weekly)
    assert observed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
