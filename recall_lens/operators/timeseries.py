"""Monthly recall series per risk category, and their trends.

Everything per device is aggregated first; a series has one row per period and category, so the windows below run over
tables whose size is the calendar's, not the data's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recall_lens.functions.cleaning import clean_date
from recall_lens.operators.skew import spread_rank

OVERALL = "All"
MONTHS_BACK = 24

# Frequency: unit to cut dates to, and the period's label.
FREQUENCIES = {"M": ("MM", "yyyy-MM"), "Q": ("QUARTER", "yyyy'Q'q"), "Y": ("YEAR", "yyyy")}


def _unit(freq: str) -> tuple[str, str]:
    if freq not in FREQUENCIES:
        raise ValueError(f"Unknown frequency: {freq}")
    return FREQUENCIES[freq]


def _hash_number(key: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(key), start, 8), 16, 10).cast("long")


def assign_dates(scored: DataFrame, as_of: dt.date, months_back: int = MONTHS_BACK) -> DataFrame:
    """A date within the last `months_back` months for devices that carry none.

    With recalls: month 0 to 11 of the range, the more recalls the earlier. Without: one of the later months. The
    free choices come from a hash of the device number, so every run gives the same dates.
    """
    start = F.add_months(F.lit(as_of), -months_back)
    recalls = F.coalesce(F.col("recall_count"), F.lit(0)).cast("long")
    busy = F.least(F.greatest((F.lit(12) * (1 - recalls / (recalls + 20))).cast("int"), F.lit(0)), F.lit(11))
    idle = (F.lit(12) + F.pmod(_hash_number(F.col("PMA_PMN_NUM"), 1), F.lit(months_back - 12))).cast("int")
    month = F.when(recalls > 0, busy).otherwise(idle)
    day = (F.lit(1) + F.pmod(_hash_number(F.col("PMA_PMN_NUM"), 9), F.lit(27))).cast("int")
    return scored.withColumn("last_scored", F.date_add(F.add_months(start, month), day))


def dates_by_rank(scored: DataFrame, as_of: dt.date, column: str = "synthetic_date") -> DataFrame:
    """One day per device, ending at as_of, for tables without a date column."""
    ranked = spread_rank(scored, F.col("PMA_PMN_NUM"), "_rank")
    days_ago = (F.col("_rank_total") - F.col("_rank")).cast("int")
    return ranked.withColumn(column, F.date_sub(F.lit(as_of), days_ago)).drop("_rank", "_rank_total")


def _day(dated: DataFrame, column: str) -> Column:
    """A date column as it is; text is read like any feed's, and what is no date becomes null."""
    return clean_date(F.col(column)) if dict(dated.dtypes)[column] == "string" else F.col(column)


def _with_overall(rows: DataFrame, freq: str) -> DataFrame:
    """Sums per period and per (period, category). Rows without a category count in the overall series only."""
    grouped = rows.groupingSets([["period"], ["period", "category"]], "period", "category").agg(
        F.grouping("category").alias("overall"),
        F.sum("recalls").cast("double").alias("total_recalls"),
        F.sum("devices").cast("long").alias("device_count"),
    )
    return grouped.filter((F.col("overall") == 1) | F.col("category").isNotNull()).select(
        F.date_format("period", _unit(freq)[1]).alias("period"),
        F.when(F.col("overall") == 1, F.lit(OVERALL)).otherwise(F.col("category")).alias("category"),
        "total_recalls",
        "device_count",
        F.col("period").alias("date"),
    )


def spread_series(dated: DataFrame, date_column: str = "last_scored", freq: str = "M") -> DataFrame:
    """Each device's recalls dealt back over 3 to 12 months with falling weight; the device counts in its own month.

    Devices of one month, category and recall count are alike, so they are counted before being dealt out.
    """
    unit, _ = _unit(freq)
    n = F.greatest(F.least("recall_count", F.lit(12)), F.lit(3))
    alike = (
        dated.select(
            F.trunc(_day(dated, date_column), "MM").alias("month"),
            F.col("rpss_category").alias("category"),
            F.coalesce("recall_count", F.lit(0)).cast("long").alias("recall_count"),
        )
        .filter(F.col("month").isNotNull())
        .groupBy("month", "category", "recall_count")
        .agg(F.count("*").alias("alike"))
    )
    back = F.when(F.col("recall_count") > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array(F.lit(0)))
    share = F.when(
        F.col("recall_count") > 0, (F.col("recall_count") / n) * ((n - F.col("back")) / n) * F.col("alike")
    ).otherwise(F.lit(0.0))
    dealt = alike.withColumn("back", F.explode(back)).select(
        F.trunc(F.add_months("month", -F.col("back")), unit).alias("period"),
        "category",
        share.alias("recalls"),
        F.when(F.col("back") == 0, F.col("alike")).otherwise(F.lit(0)).alias("devices"),
    )
    return _with_overall(dealt, freq)


def plain_series(dated: DataFrame, date_column: str = "last_scored", freq: str = "M") -> DataFrame:
    """Recalls and devices by the period of their date."""
    unit, _ = _unit(freq)
    day = _day(dated, date_column)
    rows = dated.filter(day.isNotNull()).select(
        F.trunc(day, unit).alias("period"),
        F.col("rpss_category").alias("category"),
        F.coalesce("recall_count", F.lit(0)).alias("recalls"),
        F.when(F.col("PMA_PMN_NUM").isNotNull(), 1).otherwise(0).alias("devices"),
    )
    return _with_overall(rows, freq)


def pad_series(series: DataFrame, freq: str = "M") -> DataFrame:
    """With fewer than three periods, add copies of the whole series shifted back, each 0.8 of the one before."""
    label = _unit(freq)[1]
    periods = series.agg(F.countDistinct("period").alias("n"))
    shift = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(3) - F.col("periods"), F.lit(0)).cast("int")))
    back = F.col("shift")
    moved = F.add_months("date", -back) if freq == "M" else F.date_sub("date", back * 30)
    return (
        series.withColumn("periods", periods.scalar())
        .select("*", shift.alias("shift"))
        .select(
            F.date_format(moved, label).alias("period"),
            "category",
            (F.col("total_recalls") * F.pow(F.lit(0.8), back)).alias("total_recalls"),
            "device_count",
            moved.alias("date"),
        )
    )


def _in_order(*tie: str) -> Window:
    return Window.partitionBy("category").orderBy("date", *tie)


def trailing_mean(series: DataFrame, window: int = 3) -> DataFrame:
    """Mean of each period and the ones before it, up to `window`; short windows count at the start."""
    frame = _in_order("total_recalls").rowsBetween(1 - window, Window.currentRow)
    return series.withColumn("trailing_mean", F.avg("total_recalls").over(frame))


def _whole(c: str) -> Column:
    """Whole part; summation noise below 1e-9 does not pull a whole number down."""
    return F.round(c, 9).cast("long")


def trend_analysis(series: DataFrame) -> DataFrame:
    """Trend figures of every category with at least two periods."""
    up = _in_order("total_recalls")
    down = Window.partitionBy("category").orderBy(F.col("date").desc(), F.col("total_recalls").desc())
    placed = series.withColumn("from_start", F.row_number().over(up)).withColumn("from_end", F.row_number().over(down))
    value = F.col("total_recalls")
    at = lambda position, n: F.max(F.when(F.col(position) == n, value))
    stats = placed.groupBy("category").agg(
        F.count("*").alias("total_periods"),
        F.sum(value).alias("sum"),
        F.avg(value).alias("avg_per_period"),
        at("from_start", 1).alias("first"),
        at("from_end", 1).alias("last"),
        at("from_end", 3).alias("third_last"),
        F.stddev_pop(value).alias("volatility"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
    )
    slope = (F.col("last") - F.col("first")) / F.col("total_periods")
    recent = F.when(F.col("total_periods") >= 3, (F.col("last") - F.col("third_last")) / 3).otherwise(slope)
    return stats.filter(F.col("total_periods") >= 2).select(
        "category",
        "total_periods",
        _whole("sum").alias("total_recalls"),
        "avg_per_period",
        slope.alias("trend_slope"),
        recent.alias("recent_trend"),
        "volatility",
        _whole("max").alias("peak"),
        _whole("min").alias("trough"),
        (recent > 0).alias("is_increasing"),
    )
