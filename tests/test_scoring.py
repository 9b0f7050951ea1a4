from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recall_lens.functions.scoring import CAUSE_SEVERITY, cause_severity, class_weight, risk_category
from recall_lens.operators.scoring import score_components, score_devices

ROLLUP = (
    "PMA_PMN_NUM string, recall_count long, total_adverse_events long, unique_manufacturers long, "
    "device_class double, first_event_date date, last_event_date date, root_cause_description string"
)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


ROWS = [
    ("top", 9, 900, 1, 3.0, day(0), day(1), "Software design"),
    ("mid", 4, 100, 0, 2.9, day(0), day(10), "LABELING DESIGN"),
    ("low", 0, 0, 5, None, None, None, "Packaging"),
    ("same day", 1, 40, 4, 1.0, day(5), day(5), "Another cause"),
    ("backwards", 2, 10, 2, 7.0, day(9), day(3), None),
]


def by_hand(rows):
    severity = {"Software design": 0.95, "LABELING DESIGN": 0.9, "Packaging": 0.6, "Another cause": 0.5, None: 0.5}
    weight = lambda c: {3: 1.0, 2: 0.7, 1: 0.4}.get(int(c), 0.5) if c is not None else 0.5

    def raw(r):
        span = (r[6] - r[5]).days if r[5] and r[6] else 0
        return (float(r[1]), severity[r[7]], r[2] / max(r[3], 1), 1 / span if span > 0 else 0.0, weight(r[4]))

    raws = [raw(r) for r in rows]
    columns = list(zip(*raws))
    scaled = [
        [0.0 if min(c) == max(c) else (x - min(c)) / (max(c) - min(c) + 1e-9) for c, x in zip(columns, r)] for r in raws
    ]
    return {
        r[0]: min(max(sum(x * w for x, w in zip(s, (0.3, 0.3, 0.2, 0.1, 0.1))), 0), 1) for r, s in zip(rows, scaled)
    }


def test_scores_and_categories(spark):
    found = {r["PMA_PMN_NUM"]: r for r in score_devices(spark.createDataFrame(ROWS, ROLLUP)).collect()}
    for name, expected in by_hand(ROWS).items():
        assert found[name]["rpss"] == pytest.approx(expected, abs=1e-12)
        assert 0 <= found[name]["rpss"] <= 1
    assert found["top"]["rpss_category"] == "Critical"
    assert found["low"]["rpss_category"] == "Low"


def test_single_device_scores_zero(spark):
    row = score_devices(spark.createDataFrame(ROWS[:1], ROLLUP)).first()
    assert (row["rpss"], row["rpss_category"]) == (0.0, "Low")


def test_equal_columns_scale_to_zero(spark):
    rows = [("a", 2, 5, 1, 1.0, day(0), day(4), "Software"), ("b", 2, 5, 1, 1.0, day(0), day(4), "Design")]
    for r in score_components(spark.createDataFrame(rows, ROLLUP)).collect():
        assert r["recurrence_score"] == r["adverse_density_score"] == r["recency_score"] == 0.0


def test_no_devices(spark):
    assert score_devices(spark.createDataFrame([], ROLLUP)).count() == 0


def test_severity_order(spark):
    texts = [k.upper() for k, _ in CAUSE_SEVERITY] + ["Labeling design", "Another cause", "nothing known", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string").select(cause_severity(F.col("c")).alias("s"))
    expected = [
        next((s for k, s in CAUSE_SEVERITY if t is not None and k in t.lower()), 0.5) for t in texts
    ]
    assert [r["s"] for r in df.collect()] == expected
    assert expected[-4:] == [0.9, 0.5, 0.5, 0.5]


def test_class_weight(spark):
    df = spark.createDataFrame([(3.0,), (2.9,), (1.0,), (4.0,), (None,), (float("nan"),)], "c double")
    assert [r[0] for r in df.select(class_weight(F.col("c"))).collect()] == [1.0, 0.7, 0.4, 0.5, 0.5, 0.5]


def test_category_bounds(spark):
    scores = [0.0, 0.25, 0.2500001, 0.5, 0.75, 0.7500001, 1.0, float("nan"), None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    ladder = [r[0] for r in df.select(risk_category(F.col("s"))).collect()]
    assert ladder == ["Low", "Low", "Medium", "Medium", "High", "Critical", "Critical", "Critical", "Critical"]
    bands = [r[0] for r in df.select(risk_category(F.col("s"), zero_is_null=True)).collect()]
    assert bands[:2] == [None, "Low"] and bands[-2:] == [None, None]
