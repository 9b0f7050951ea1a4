from __future__ import annotations

import datetime as dt
import statistics
from collections import defaultdict

import numpy as np
import pytest

from recall_lens.operators import forecasting, timeseries

DATED = "PMA_PMN_NUM string, rpss_category string, recall_count long, last_scored date"
SERIES = "period string, category string, total_recalls double, device_count long, date date"
ROWS = [
    ("a", "Low", 0, dt.date(2024, 1, 31)),
    ("b", "Low", 1, dt.date(2024, 3, 31)),
    ("c", "High", 3, dt.date(2024, 3, 31)),
    ("d", "High", 12, dt.date(2024, 5, 30)),
    ("e", None, 13, dt.date(2024, 5, 1)),
    ("f", "Low", None, dt.date(2024, 5, 1)),
    ("g", "Low", 4, None),
]


def month_back(day, n):
    index = day.year * 12 + day.month - 1 - n
    return dt.date(index // 12, index % 12 + 1, 1)


def spread_by_hand(rows):
    recalls, devices = defaultdict(float), defaultdict(int)
    for _, category, count, day in rows:
        if day is None:
            continue
        count = count or 0
        n = max(min(count, 12), 3) if count else 1
        for m in range(n):
            for c in {"All", category} - {None}:
                recalls[month_back(day, m), c] += count / n * (n - m) / n
                devices[month_back(day, m), c] += m == 0
    return {k: (round(recalls[k], 9), devices[k]) for k in recalls}


def as_dict(df):
    return {(r["date"], r["category"]): (round(r["total_recalls"], 9), r["device_count"]) for r in df.collect()}


def test_spread_series(spark):
    series = timeseries.spread_series(spark.createDataFrame(ROWS, DATED))
    assert as_dict(series) == spread_by_hand(ROWS)
    total = sum(r["total_recalls"] for r in series.filter("category = 'All'").collect())
    share = lambda c: c * (max(min(c, 12), 3) + 1) / (2 * max(min(c, 12), 3))
    assert total == pytest.approx(sum(share(c) for c in (1, 3, 12, 13)))


def test_quarters(spark):
    series = timeseries.plain_series(spark.createDataFrame(ROWS, DATED), freq="Q")
    found = {(r["period"], r["category"]): (r["total_recalls"], r["device_count"]) for r in series.collect()}
    assert found == {
        ("2024Q1", "All"): (4, 3), ("2024Q1", "Low"): (1, 2), ("2024Q1", "High"): (3, 1),
        ("2024Q2", "All"): (25, 3), ("2024Q2", "High"): (12, 1), ("2024Q2", "Low"): (0, 1),
    }
    with pytest.raises(ValueError):
        timeseries.plain_series(spark.createDataFrame(ROWS, DATED), freq="W")


@pytest.mark.parametrize("months, copies", [(1, 3), (2, 2), (3, 1), (4, 1)])
def test_padding(spark, months, copies):
    rows = [(f"2024-{m:02d}", "All", 10.0, 1, dt.date(2024, m, 1)) for m in range(1, months + 1)]
    padded = timeseries.pad_series(spark.createDataFrame(rows, SERIES))
    assert padded.count() == months * copies
    shifted = padded.filter("date < '2024-01-01'").orderBy("date").collect()
    if months == 1:
        assert [(r["period"], round(r["total_recalls"], 6)) for r in shifted] == [("2023-11", 6.4), ("2023-12", 8.0)]


def series_of(spark, **categories):
    rows = []
    for category, values in categories.items():
        for i, v in enumerate(values):
            day = month_back(dt.date(2024, 1, 1), -i)
            rows.append((day.strftime("%Y-%m"), category, float(v), 1, day))
    return spark.createDataFrame(rows, SERIES)


def test_trend(spark):
    found = {r["category"]: r for r in timeseries.trend_analysis(
        series_of(spark, All=[1, 4, 2.5, 8], Low=[5, 2], One=[3])).collect()}
    assert set(found) == {"All", "Low"}
    a = found["All"]
    assert (a["total_periods"], a["total_recalls"], a["peak"], a["trough"], a["is_increasing"]) == (4, 15, 8, 1, True)
    assert a["trend_slope"] == pytest.approx(7 / 4) and a["recent_trend"] == pytest.approx(4 / 3)
    assert a["volatility"] == pytest.approx(statistics.pstdev([1, 4, 2.5, 8]))
    assert found["Low"]["recent_trend"] == found["Low"]["trend_slope"] == pytest.approx(-1.5)


def test_trailing_mean(spark):
    rows = timeseries.trailing_mean(series_of(spark, All=[3, 6, 9, 0])).orderBy("date").collect()
    assert [r["trailing_mean"] for r in rows] == [3.0, 4.5, 6.0, 5.0]


def values_of(series, category, **options):
    rows = forecasting.forecast(series, 4, **options).filter(f"category = '{category}'").orderBy("date").collect()
    return [r["forecasted_recalls"] for r in rows], rows


def test_forecast_methods(spark):
    series = series_of(spark, All=[1, 2, 9, 4], Zero=[0, 0, 0], Late=[6, 3, 0], Fall=[90, 30, 1], One=[3])
    assert values_of(series, "All")[0] == pytest.approx([5.0] * 4)
    assert values_of(series, "All", method="last_value")[0] == [4.0] * 4
    assert values_of(series, "All", method="exponential_smoothing")[0] == [4.0] * 4
    line = np.polyval(np.polyfit([1, 2, 3], [2, 9, 4], 1), [4, 5, 6, 7])
    assert values_of(series, "All", method="linear_trend")[0] == pytest.approx(list(np.maximum(line, 2.5)))
    assert values_of(series, "Late", method="last_value")[0] == pytest.approx([3.0] * 4)
    assert values_of(series, "Fall", method="linear_trend")[0] == pytest.approx([121 / 6] * 4)
    assert values_of(series, "Zero")[0] == pytest.approx([1 / 3] * 4)
    assert values_of(series, "One")[0] == []
    _, rows = values_of(series, "All")
    assert [r["date"] for r in rows][:2] == [dt.date(2024, 5, 31), dt.date(2024, 6, 30)]
    assert rows[0]["lower_bound"] == pytest.approx(3.5) and rows[0]["upper_bound"] == pytest.approx(6.5)


def test_month_end_alignment_sees_no_observation(spark):
    series = series_of(spark, All=[5, 6, 7, 8])
    spine = forecasting.monthly_spine(series, "month_end").orderBy("month").collect()
    assert [r["value"] for r in spine] == [0.0, 0.0, 0.0]
    expected = sum(6.5 * 0.9**i / 3 for i in range(3)) / 3
    found, rows = values_of(series, "All", alignment="month_end")
    assert found == pytest.approx([expected] * 4)
    assert rows[0]["date"] == dt.date(2024, 4, 30)


def test_gaps_and_short_ranges(spark):
    rows = [("2024-01", "All", 4.0, 1, dt.date(2024, 1, 1)), ("2024-04", "All", 6.0, 1, dt.date(2024, 4, 1))]
    spine = forecasting.monthly_spine(spark.createDataFrame(rows, SERIES)).orderBy("month").collect()
    assert [r["value"] for r in spine] == [4.0, 0.0, 0.0, 6.0]
    short = forecasting.monthly_spine(series_of(spark, All=[2, 3])).orderBy("month").collect()
    assert [r["value"] for r in short] == [0.0, 2.0, 3.0]


def test_unknown_options(spark):
    series = series_of(spark, All=[1, 2, 3])
    with pytest.raises(ValueError):
        forecasting.forecast(series, 3, "arima")
    with pytest.raises(ValueError):
        forecasting.forecast(series, 3, alignment="week")


def test_summary_and_history(spark):
    series = series_of(spark, All=[1, 2, 9, 4], Low=[1, 1, 1], High=[2, 2, 2.5], One=[3])
    ahead = forecasting.forecast(series, 3)
    rows = forecasting.forecast_summary(ahead).collect()
    assert [(r["category"], r["total_forecasted_recalls"], r["is_leader"]) for r in rows] == [
        ("All", 15, False), ("High", 6, True), ("Low", 3, False),
    ]
    assert {r["grand_total"] for r in rows} == {24}
    both = forecasting.history_and_forecast(series, ahead)
    assert {(r["kind"], r["n"]) for r in both.groupBy("kind").count().withColumnRenamed("count", "n").collect()} == {
        ("history", 10), ("forecast", 9),
    }


def test_assigned_dates(spark):
    rows = [(f"K{i}", "Low", c, None) for i, c in enumerate([0, None, 0, 0, 1, 5, 20, 1000])]
    df = spark.createDataFrame(rows, DATED).drop("last_scored")
    found = {r["PMA_PMN_NUM"]: r["last_scored"] for r in timeseries.assign_dates(df, dt.date(2025, 1, 1)).collect()}
    assert all(dt.date(2024, 1, 2) <= found[f"K{i}"] <= dt.date(2024, 12, 28) for i in range(4))
    months = [(found[f"K{i}"].year, found[f"K{i}"].month) for i in range(4, 8)]
    assert months == [(2023, 12), (2023, 10), (2023, 7), (2023, 1)]
    again = timeseries.assign_dates(df.repartition(3), dt.date(2025, 1, 1)).collect()
    assert {r["PMA_PMN_NUM"]: r["last_scored"] for r in again} == found


def test_dates_by_rank(spark):
    df = spark.range(500).selectExpr("concat('K', id) AS PMA_PMN_NUM")
    days = sorted(r["synthetic_date"] for r in timeseries.dates_by_rank(df, dt.date(2025, 1, 1)).collect())
    assert days == [dt.date(2025, 1, 1) - dt.timedelta(days=i) for i in range(499, -1, -1)]
