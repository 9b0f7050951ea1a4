"""Recall forecasts for all categories in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recall_lens.operators.timeseries import OVERALL

# `exponential_smoothing` starts at the last value and blends it with itself, which leaves the last value.
# `smoothed` is the smoother proper: it runs through all months of a category, from the first to the last.
METHODS = ("moving_average", "last_value", "exponential_smoothing", "smoothed", "linear_trend")
SMOOTHING = 0.3
ALIGNMENTS = ("month_start", "month_end")


def monthly_spine(series: DataFrame, alignment: str = "month_start") -> DataFrame:
    """Gap-free monthly values per category with at least two rows; short ranges reach back to three months.

    `month_start` sets the observations on the spine. `month_end` counts months by their last day, as a calendar of
    month ends does: the last month is left out and no observation, dated on a first, meets it, so all values are 0.
    """
    if alignment not in ALIGNMENTS:
        raise ValueError(f"Unknown alignment: {alignment}")
    ranges = (
        series.groupBy("category")
        .agg(
            F.count("*").alias("n_rows"),
            F.avg("total_recalls").alias("baseline"),
            F.min("date").alias("first"),
            F.max("date").alias("last"),
        )
        .filter(F.col("n_rows") >= 2)
    )
    first = F.when(F.datediff("last", "first") < 60, F.add_months("last", -2)).otherwise(F.col("first"))
    last = F.col("last") if alignment == "month_start" else F.add_months("last", -1)
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    spine = ranges.select("category", "baseline", F.explode(months).alias("month"))
    if alignment == "month_end":
        return spine.withColumn("value", F.lit(0.0))
    observed = series.groupBy("category", F.trunc("date", "MM").alias("month")).agg(
        F.sum("total_recalls").alias("observed")
    )
    return spine.join(observed, ["category", "month"], "left").select(
        "category", "baseline", "month", F.coalesce("observed", F.lit(0.0)).alias("value")
    )


def _rescued(spine: DataFrame) -> DataFrame:
    """An all-zero series is rebuilt: from its category's mean over the last three months, else a one at the end."""
    whole = Window.partitionBy("category")
    placed = spine.withColumns(
        {
            "from_end": F.row_number().over(whole.orderBy(F.col("month").desc())),
            "length": F.count("*").over(whole),
            "sum": F.sum("value").over(whole),
        }
    )
    k = F.least("length", F.lit(3))
    from_mean = F.when(
        F.col("from_end") <= k, F.col("baseline") * F.pow(F.lit(0.9), F.col("from_end") - 1) / k
    ).otherwise(F.lit(0.0))
    last_one = F.when(F.col("from_end") == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    rebuilt = F.when(F.col("baseline") > 0, from_mean).otherwise(last_one)
    return placed.withColumn("value", F.when(F.col("sum") == 0, rebuilt).otherwise(F.col("value")))


def _smoothed(values: Column, weight: float) -> Column:
    """The last level of a list of values in order: each value moves the level by `weight` of its distance from it."""
    step = lambda level, value: F.coalesce(level + weight * (value - level), value)
    return F.aggregate(values, F.lit(None).cast("double"), step)


def forecast(
    series: DataFrame,
    periods: int = 12,
    method: str = "moving_average",
    alignment: str = "month_start",
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Forecast of every category: month end, value, and bounds at 0.7 and 1.3 of it.

    `smoothing` is the weight of the newest value in the method `smoothed`, over 0 and up to 1, which leaves the last value.
    """
    if method not in METHODS:
        raise ValueError(f"no such method: {method}")
    if not 0 < smoothing <= 1:
        raise ValueError(f"smoothing is {smoothing}; it must be over 0 and up to 1")
    values = _rescued(monthly_spine(series, alignment))
    recent = F.col("from_end") <= 3
    position = F.col("length") - F.col("from_end")
    fit = (F.when(recent, F.col("value")), position)
    shape = values.groupBy("category").agg(
        F.count("*").alias("length"),
        F.max("month").alias("last_month"),
        F.sum("value").alias("sum"),
        F.avg("value").alias("mean"),
        F.avg(F.when(recent, F.col("value"))).alias("recent_mean"),
        F.max(F.when(F.col("from_end") == 1, F.col("value"))).alias("last_value"),
        # as many as a category has months
        F.sort_array(F.collect_list(F.struct("month", "value"))).alias("months"),
        F.regr_slope(*fit).alias("slope"),
        F.regr_intercept(*fit).alias("intercept"),
    )
    steps = shape.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    if method == "moving_average":
        value = F.when(F.col("recent_mean") == 0, F.col("mean")).otherwise(F.col("recent_mean"))
    elif method == "linear_trend":
        line = F.col("intercept") + F.col("slope") * (F.col("length") + F.col("step") - 1)
        value = F.greatest(line, F.lit(0.0), F.col("recent_mean") * 0.5)
    elif method == "smoothed":
        value = _smoothed(F.transform("months", lambda m: m["value"]), smoothing)
    else:
        value = F.col("last_value")
    value = F.when(F.col("length") == 1, F.col("last_value")).otherwise(value)
    # The methods are flat or floored, so a forecast is all zero exactly when one step is.
    value = F.when((value == 0) & (F.col("sum") > 0) & (F.col("recent_mean") > 0), F.col("recent_mean")).otherwise(value)
    value = F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))
    return steps.select(
        F.last_day(F.add_months("last_month", F.col("step"))).alias("date"),
        "category",
        value.alias("forecasted_recalls"),
        (value * 0.7).alias("lower_bound"),
        (value * 1.3).alias("upper_bound"),
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Rounded total per category (half to even), the grand total, and the leading single category marked."""
    totals = forecasts.groupBy("category").agg(
        F.bround(F.round(F.sum("forecasted_recalls"), 9), 0).cast("long").alias("total_forecasted_recalls")
    )
    single = F.when(F.col("category") != OVERALL, F.struct("total_forecasted_recalls", "category"))
    figures = totals.agg(
        F.struct(F.sum("total_forecasted_recalls").alias("grand"), F.max(single).alias("top")).alias("f")
    )
    return (
        totals.withColumn("f", figures.scalar())
        .select(
            "category",
            "total_forecasted_recalls",
            F.col("f.grand").alias("grand_total"),
            F.coalesce(F.col("category") == F.col("f.top.category"), F.lit(False)).alias("is_leader"),
        )
        .orderBy(F.col("total_forecasted_recalls").desc(), "category")
    )


def history_and_forecast(series: DataFrame, forecasts: DataFrame) -> DataFrame:
    """History and forecast as one table with a `kind` column, for the categories that have a forecast."""
    history = series.join(forecasts.select("category").distinct(), "category", "left_semi").select(
        F.lit("history").alias("kind"),
        "category",
        "date",
        F.col("total_recalls").alias("recalls"),
        F.lit(None).cast("double").alias("lower_bound"),
        F.lit(None).cast("double").alias("upper_bound"),
    )
    ahead = forecasts.select(
        F.lit("forecast").alias("kind"),
        "category",
        "date",
        F.col("forecasted_recalls").alias("recalls"),
        "lower_bound",
        "upper_bound",
    )
    return history.unionByName(ahead)
