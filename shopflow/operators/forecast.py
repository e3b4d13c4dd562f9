"""Weekly demand per SKU: trend times month index, fitted with aggregates only.

After the weekly totals are shuffled by SKU, every later step works inside a SKU's own
series, so nothing moves again. Bounds and line are found on the weeks with sales; the
calendar weeks in between exist only between two operators of one stage.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from shopflow import schemas
from shopflow.functions import columns as C, fixed_values as fixed


def top_skus(tx: DataFrame, n: int = fixed.TOP_N_SKUS) -> DataFrame:
    """The ``n`` SKUs with most lines; ties go to the lower code."""
    return (
        tx.groupBy("stock_code")
        .agg(F.count(F.lit(1)).alias("tx_count"))
        .orderBy(F.desc("tx_count"), "stock_code")
        .limit(n)
    )


def weekly_sales(tx: DataFrame, skus: DataFrame | None = None) -> DataFrame:
    """Units per SKU and Monday week, for the given SKUs or for all."""
    if skus is not None:
        tx = tx.join(skus.select("stock_code"), "stock_code", "left_semi")
    week = F.to_date(F.date_trunc("week", "invoice_date"))
    return tx.groupBy("stock_code", week.alias("week_start")).agg(
        F.sum("quantity").alias("units_sold")
    )


def observe(weekly: DataFrame, holdout: int = 0) -> DataFrame:
    """Weekly rows with the bounds of their SKU's series and the week of the next sale.

    All per-SKU facts are found here, on weeks with sales; the weeks without are only
    generated afterwards and never sorted or shuffled. The weeks of a task grow to several
    times their size on the way, so the tasks keep their number instead of being put
    together until each of them shuffles the usual size.
    """
    tasks = int(weekly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weekly = weekly.repartition(tasks, "stock_code")
    sku = Window.partitionBy("stock_code")
    return weekly.withColumns({
        "first_week": F.min("week_start").over(sku),
        "last_week": F.max("week_start").over(sku),
        "_next": F.lead("week_start").over(sku.orderBy("week_start")),
    }).withColumns({
        "train_weeks": (F.datediff("last_week", "first_week") / 7).cast("long") + 1 - holdout,
        "week_no": (F.datediff("week_start", "first_week") / 7).cast("int"),
    })


def every_week(observed: DataFrame) -> DataFrame:
    """One row per calendar week between first and last week; weeks without sales count 0.

    Each observed week is stretched up to the one before the next observed week, which
    needs no calendar table and no join. Other columns are carried along.
    """
    gap = F.coalesce((F.datediff("_next", "week_start") / 7).cast("int"), F.lit(1))
    steps = observed.withColumn("_step", F.explode(F.sequence(F.lit(0), gap - 1)))
    return steps.withColumns({
        "week_start": F.date_add("week_start", F.col("_step") * 7),
        "week_no": F.col("week_no") + F.col("_step"),
        "units_sold": F.when(F.col("_step") == 0, F.col("units_sold")).otherwise(F.lit(0)).cast("long"),
    }).withColumn("is_train", F.col("week_no") < F.col("train_weeks")).drop("_step", "_next")


def fill_weeks(weekly: DataFrame) -> DataFrame:
    return every_week(observe(weekly)).select("stock_code", "week_start", "units_sold")


def split(weekly: DataFrame, holdout: int = fixed.HOLDOUT_WEEKS) -> DataFrame:
    """Filled series, weeks numbered from 0, all but a SKU's last ones marked as training."""
    return every_week(observe(weekly, holdout)).select(
        "stock_code", "week_start", "units_sold", "week_no", "is_train"
    )


def skipped(weekly: DataFrame, holdout: int = fixed.HOLDOUT_WEEKS,
            min_weeks: int = fixed.MIN_TRAIN_WEEKS) -> DataFrame:
    """SKUs with too little history to fit, with the reason."""
    weeks = F.datediff(F.max("week_start"), F.min("week_start")) / 7 + 1 - holdout
    return (
        weekly.groupBy("stock_code")
        .agg(F.greatest(weeks.cast("long"), F.lit(0)).alias("train_weeks"))
        .where(F.col("train_weeks") < min_weeks)
        .withColumn("reason", F.lit(f"fewer than {min_weeks} training weeks"))
    )


def _trend(week_no):
    """Line through the training weeks, held above a tenth of their mean level."""
    line = F.col("intercept") + F.col("slope") * week_no
    return F.greatest(line, F.col("floor"))


def _lines(observed: DataFrame) -> DataFrame:
    """Add slope, intercept and floor of the least-squares line over the training weeks.

    Week numbers are 0 to n - 1 without gaps, so only sums with units need the rows. All
    sums are integers: the line does not depend on the order of the rows.
    """
    sku = Window.partitionBy("stock_code")
    train = F.col("week_no") < F.col("train_weeks")
    n, t, y = F.col("train_weeks"), F.col("week_no").cast("long"), F.col("units_sold")
    sum_t, sum_tt = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    spread = n * sum_tt - sum_t * sum_t
    return observed.withColumns({
        "_y": F.coalesce(F.sum(F.when(train, y)).over(sku), F.lit(0)),
        "_ty": F.coalesce(F.sum(F.when(train, t * y)).over(sku), F.lit(0)),
    }).withColumn(
        "slope", F.when(spread != 0, (n * F.col("_ty") - sum_t * F.col("_y")) / spread).otherwise(0.0)
    ).withColumns({
        "intercept": (F.col("_y") - F.col("slope") * sum_t) / n,
        "floor": F.greatest(F.col("_y") / n * 0.1, F.lit(1e-6)),
    }).drop("_y", "_ty")


def fit(weekly: DataFrame, holdout: int = 0, min_weeks: int = fixed.MIN_TRAIN_WEEKS) -> DataFrame:
    """Fitted parameters, one row per SKU with at least ``min_weeks`` training weeks.

    ``month_index`` holds January to December, scaled to mean 1; months without training
    weeks count as 1 before scaling. ``sigma`` is the spread of the training residuals.
    """
    lines = _lines(observe(weekly, holdout).where(F.col("train_weeks") >= min_weeks))
    weeks = every_week(lines).where("is_train").withColumn("trend", _trend(F.col("week_no")))
    line = ["slope", "intercept", "floor", "train_weeks", "first_week", "last_week"]
    y, trend = F.col("units_sold"), F.col("trend")
    monthly = weeks.groupBy("stock_code", F.month("week_start").alias("month")).agg(
        *[F.max(c).alias(c) for c in line],
        F.avg(y / trend).alias("ratio"),
        F.sum(y).alias("y"),
        F.sum(y * y).alias("yy"),
        F.sum(y * trend).alias("yt"),
        F.sum(trend).alias("t"),
        F.sum(trend * trend).alias("tt"),
    )
    months = F.collect_list(F.struct("month", "ratio", "y", "yy", "yt", "t", "tt"))
    return (
        monthly.groupBy("stock_code")
        .agg(
            *[F.max(c).alias(c) for c in line],
            F.sum("ratio").alias("_ratios"),
            F.count(F.lit(1)).alias("_seen"),
            months.alias("_months"),
        )
        .withColumn("_mean", (F.col("_ratios") + 12 - F.col("_seen")) / 12)
        .withColumn("scale", F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0))
        .withColumn("_index", F.map_from_entries(
            F.transform("_months", lambda m: F.struct(m["month"], m["ratio"] / F.col("scale")))
        ))
        .withColumn("month_index", F.transform(
            F.sequence(F.lit(1), F.lit(12)),
            lambda m: F.coalesce(F.try_element_at("_index", m), 1 / F.col("scale")),
        ))
        .withColumn("sigma", _residual_spread())
        .select("stock_code", *line, "scale", "month_index", "sigma")
    )


def _residual_spread():
    """Population deviation of units - trend * index, from the sums per month."""

    def total(term):
        return F.aggregate("_months", F.lit(0.0), lambda acc, m: acc + term(m, m["ratio"] / F.col("scale")))

    first = total(lambda m, c: m["y"] - c * m["t"]) / F.col("train_weeks")
    second = total(lambda m, c: m["yy"] - 2 * c * m["yt"] + c * c * m["tt"]) / F.col("train_weeks")
    return F.sqrt(F.greatest(second - first * first, F.lit(0.0)))


def refit(weekly: DataFrame, holdout: int = fixed.HOLDOUT_WEEKS,
          min_weeks: int = fixed.MIN_TRAIN_WEEKS) -> DataFrame:
    """Fit on all weeks the SKUs that have enough weeks before the holdout."""
    return fit(weekly, 0, min_weeks + holdout)


def _point(week_no, date):
    return _trend(week_no) * F.element_at("month_index", F.month(date))


def backtest(weekly: DataFrame, params: DataFrame, holdout: int = fixed.HOLDOUT_WEEKS) -> DataFrame:
    """Mean absolute and mean absolute percentage error over each SKU's last weeks."""
    held = every_week(observe(weekly, holdout)).where("NOT is_train").select(
        "stock_code", "week_start", "week_no", "units_sold"
    )
    scored = held.join(params, "stock_code").withColumn(
        "yhat", F.greatest(_point(F.col("week_no"), "week_start"), F.lit(0.0))
    )
    error = F.abs(F.col("units_sold") - F.col("yhat"))
    shifted = F.abs(F.col("units_sold") + F.lit(fixed.MAPE_SHIFT))
    return scored.groupBy("stock_code").agg(
        F.avg(error).alias("mae"),
        F.avg(error / F.greatest(shifted, F.lit(fixed.MAPE_FLOOR))).alias("mape"),
    )


def metrics(backtested: DataFrame) -> DataFrame:
    return backtested.agg(
        F.avg("mae").alias("mean_mae"),
        F.avg("mape").alias("mean_mape"),
        F.count(F.lit(1)).alias("n_skus_trained"),
    )


def predict(params: DataFrame, horizon: int = fixed.FORECAST_HORIZON_WEEKS) -> DataFrame:
    """The ``horizon`` Mondays after a SKU's last week, with an 80 % band clipped at zero.

    ``params`` come from a fit on all weeks.
    """
    future = params.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "forecast_date", F.date_add("last_week", F.col("_ahead") * 7)
    )
    point = _point(F.col("train_weeks") - 1 + F.col("_ahead"), "forecast_date")
    band = F.col("sigma") * F.lit(fixed.Z_80)

    def clipped(c):
        return F.greatest(c, F.lit(0.0))

    return future.select(
        "stock_code",
        "forecast_date",
        clipped(point).alias("predicted_units"),
        clipped(point - band).alias("lower_bound_80"),
        clipped(point + band).alias("upper_bound_80"),
    )


def to_gold(predicted: DataFrame, model_version: str, run_id: str, now=None) -> DataFrame:
    return predicted.withColumns({
        "model_version": F.lit(model_version),
        "run_id": F.lit(run_id),
        "generated_at": C.stamp(now),
    }).select(schemas.DEMAND_FORECAST.names)


def weekly_for(tx: DataFrame, n: int | None = None) -> DataFrame:
    """Weekly units of all SKUs, or of the ``n`` busiest ones."""
    return weekly_sales(tx, None if n is None else top_skus(tx, n))
