"""Recall risk score of a device: five features, scaled over all devices, weighted, banded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recall_lens.functions.scoring import (
    SCORE_WEIGHTS,
    cause_severity,
    class_weight,
    min_max,
    risk_category,
)
from recall_lens.operators.skew import stage

FEATURES = (
    ("recurrence_raw", "recurrence_score"),
    ("root_cause_raw", "reason_severity_score"),
    ("density_raw", "adverse_density_score"),
    ("recency_raw", "recency_score"),
    ("device_class_raw", "device_class_score"),
)

# The columns of a scoring run.
SCORED_COLUMNS = (
    "PMA_PMN_NUM",
    "recall_count",
    "total_adverse_events",
    "unique_manufacturers",
    "device_class",
    "root_cause_description",
    "rpss",
    "rpss_category",
)


def raw_features(rollup: DataFrame) -> DataFrame:
    span = F.coalesce(F.datediff("last_event_date", "first_event_date"), F.lit(0))
    return rollup.withColumns(
        {
            "recurrence_raw": F.col("recall_count").cast("double"),
            "root_cause_raw": cause_severity(F.col("root_cause_description")),
            "density_raw": F.col("total_adverse_events") / F.greatest("unique_manufacturers", F.lit(1)),
            "timespan_days": span,
            "recency_raw": F.when(span <= 0, F.lit(0.0)).otherwise(F.lit(1.0) / F.nullif(span, F.lit(0))),
            "device_class_raw": class_weight(F.col("device_class")),
        }
    )


def score_components(rollup: DataFrame) -> DataFrame:
    """Raw and scaled features. The rollup is written once; both the limits and the rows are read from it."""
    raw = raw_features(stage(rollup, "device-rollup"))
    limits = raw.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_min") for c, _ in FEATURES], *[F.max(c).alias(f"{c}_max") for c, _ in FEATURES]
        ).alias("limits")
    )
    scaled = raw.withColumn("limits", limits.scalar())
    return scaled.withColumns(
        {s: min_max(F.col(c), F.col(f"limits.{c}_min"), F.col(f"limits.{c}_max")) for c, s in FEATURES}
    ).drop("limits")


def score_devices(rollup: DataFrame) -> DataFrame:
    components = score_components(rollup)
    total = sum((F.col(c) * w for c, w in SCORE_WEIGHTS[1:]), F.col(SCORE_WEIGHTS[0][0]) * SCORE_WEIGHTS[0][1])
    clipped = F.when(total < 0, F.lit(0.0)).when(total > 1, F.lit(1.0)).otherwise(total)
    return components.withColumn("rpss", clipped).select(
        *SCORED_COLUMNS[:-1], risk_category(F.col("rpss")).alias("rpss_category")
    )
