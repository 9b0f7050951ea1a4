from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recall_lens.functions.display import percent, short_number
from recall_lens.operators import analytics
from recall_lens.operators.analytics import DeviceFilter
from recall_lens.plans.dashboard import dashboard

SCHEMA = (
    "PMA_PMN_NUM string, recall_count long, total_adverse_events long, unique_manufacturers long, "
    "device_class double, root_cause_description string, rpss double, rpss_category string"
)
ROWS = [
    ("a", 3, 100, 1, 1.0, "Design", 0.2, "Low"),
    ("b", None, None, 1, 2.0, "Design", 0.6, "High"),
    ("c", 0, 5, 1, 2.0, "Other", 0.9, "Critical"),
    ("d", 7, 2_000_000, 2, None, None, 0.3, None),
    ("e", 1, 4, 2, 3.0, "Software", None, "Medium"),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def keys(df):
    return sorted(r["PMA_PMN_NUM"] for r in df.collect())


@pytest.mark.parametrize(
    "chosen, expected",
    [
        (DeviceFilter(), "abcd"),
        (DeviceFilter(categories=["All", "Low"]), "abcd"),
        (DeviceFilter(categories=["Low", "Medium"], score=(0, 1)), "a"),
        (DeviceFilter(classes=[2.0]), "bc"),
        (DeviceFilter(causes=["Design"]), "ab"),
        (DeviceFilter(score=(0.2, 0.6)), "abd"),
        (DeviceFilter(min_recalls=1), "ad"),
        (DeviceFilter(missing_recalls_are_zero=False), "acd"),
        (DeviceFilter(categories=["nothing"]), ""),
    ],
)
def test_filters(scored, chosen, expected):
    assert keys(scored.filter(chosen.to_column())) == list(expected)
    assert analytics.filtered_count(scored, chosen).first()["cnt"] == len(expected)


def test_summary(scored):
    row = analytics.summary_stats(scored).first()
    assert (row["total_devices"], row["total_recalls"], row["total_adverse"]) == (5, 11, 2_000_109)
    assert (row["critical_count"], row["high_count"], row["medium_count"], row["low_count"]) == (1, 1, 1, 1)
    assert row["avg_rpss"] == pytest.approx(0.5) and row["max_adverse_single_device"] == 2_000_000


def test_distribution_keeps_missing_category(scored):
    rows = {r["rpss_category"]: (r["count"], r["total_recalls"]) for r in
            analytics.risk_distribution(scored, DeviceFilter()).collect()}
    assert rows == {"Low": (1, 3), "High": (1, 0), "Critical": (1, 0), None: (1, 7)}


def test_share_lists_all_categories(scored):
    rows = analytics.risk_share(scored, DeviceFilter(categories=["Low", "High"])).orderBy("position").collect()
    assert [(r["rpss_category"], r["count"], r["share_text"]) for r in rows] == [
        ("Low", 1, "50.0%"), ("Medium", 0, "0.0%"), ("High", 1, "50.0%"), ("Critical", 0, "0.0%"),
    ]
    empty = analytics.risk_share(scored, DeviceFilter(categories=["none"])).collect()
    assert [r["share"] for r in empty] == [0.0] * 4


def test_cause_impact(scored):
    assert analytics.root_cause_impact(scored, DeviceFilter()).count() == 0
    rows = analytics.root_cause_impact(scored, DeviceFilter(), min_devices=0).collect()
    assert [(r["root_cause_description"], r["device_count"]) for r in rows] == [("Design", 2)]


def test_kpis(scored):
    row = analytics.kpis(scored, DeviceFilter()).first()
    assert (row["devices_matching"], row["devices_delta"], row["critical_count"]) == (4, -1, 1)
    assert row["critical_pct"] == pytest.approx(25.0) and row["adverse_text"] == "2.00M"
    assert analytics.kpis(scored, DeviceFilter(), mean_of_first=1).first()["avg_rpss"] == pytest.approx(0.9)
    empty = analytics.kpis(scored, DeviceFilter(categories=["none"])).first()
    assert (empty["devices_matching"], empty["avg_rpss"], empty["avg_recalls"]) == (0, 0.0, 0.0)


def test_options_and_bands(scored):
    assert analytics.filter_options(scored).count() == 4
    bands = {r["band"]: r["devices"] for r in analytics.score_bands(scored).collect()}
    assert bands == {"Low": 1, "Medium": 1, "High": 1, "Critical": 1, None: 1}


def test_display(spark):
    df = spark.createDataFrame([(2_500_000_000,), (1_250_000,), (999,), (1_000_000,)], "x long")
    assert [r[0] for r in df.select(short_number(F.col("x"))).collect()] == ["2.50B", "1.25M", "999", "1,000,000"]
    assert df.select(percent(F.lit(0.1234))).first()[0] == "12.3%"


def test_dashboard_shares_one_filter(scored):
    board = dashboard(scored, DeviceFilter(min_recalls=1), limit=1)
    assert keys(board.devices) == ["d"] and board.matching.first()["cnt"] == 2
    assert sum(r["count"] for r in board.distribution.collect()) == 2
    assert board.kpis.first()["devices_matching"] == 2 and board.causes.count() == 0
    assert sum(r["count"] for r in board.share.collect()) == 1
