"""Score expressions: cause severity, class weight, category ladder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cause text and its severity, tried in this order, matched as part of the lower-cased text.
CAUSE_SEVERITY = (
    ("software design", 0.95),
    ("software", 0.95),
    ("device design", 0.90),
    ("design", 0.90),
    ("process control", 0.80),
    ("manufacturing", 0.80),
    ("nonconforming material/component", 0.75),
    ("packaging", 0.60),
    ("labeling", 0.45),
    ("mixed-up of materials/components", 0.40),
    ("equipment maintenance", 0.40),
    ("other", 0.50),
    ("under investigation by firm", 0.55),
)
DEFAULT_SEVERITY = 0.50

# Device class and its weight.
CLASS_WEIGHT = ((3, 1.0), (2, 0.7), (1, 0.4))
DEFAULT_CLASS_WEIGHT = 0.5

# Component and its share of the score.
SCORE_WEIGHTS = (
    ("recurrence_score", 0.30),
    ("reason_severity_score", 0.30),
    ("adverse_density_score", 0.20),
    ("recency_score", 0.10),
    ("device_class_score", 0.10),
)

# Upper bound of each category, inclusive; above the last one is Critical.
CATEGORY_BOUNDS = (("Low", 0.25), ("Medium", 0.50), ("High", 0.75))
TOP_CATEGORY = "Critical"
CATEGORIES = ("Low", "Medium", "High", "Critical")


def _ladder(steps: list[tuple[Column, Column]], default: Column) -> Column:
    (first, value), *rest = steps
    return reduce(lambda acc, s: acc.when(s[0], s[1]), rest, F.when(first, value)).otherwise(default)


def cause_severity(cause: Column) -> Column:
    text = F.lower(cause)
    return _ladder([(text.contains(k), F.lit(s)) for k, s in CAUSE_SEVERITY], F.lit(DEFAULT_SEVERITY))


def class_weight(device_class: Column) -> Column:
    whole = device_class.try_cast("int")
    return _ladder([(whole == k, F.lit(w)) for k, w in CLASS_WEIGHT], F.lit(DEFAULT_CLASS_WEIGHT))


def risk_category(score: Column, zero_is_null: bool = False) -> Column:
    """Category of a score. A missing score falls through to the top one, unless zero_is_null asks for open bins."""
    ladder = _ladder([(score <= b, F.lit(c)) for c, b in CATEGORY_BOUNDS], F.lit(TOP_CATEGORY))
    if zero_is_null:
        return F.when((score > 0) & (score <= 1), ladder)
    return ladder


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Scaled to [0, 1); a column of equal values becomes zero."""
    return F.when(low == high, F.lit(0.0)).otherwise((x - low) / (high - low + F.lit(1e-9)))
