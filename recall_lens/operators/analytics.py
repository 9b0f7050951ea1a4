"""Questions asked of the published scores: filters, totals, distribution, causes, key figures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recall_lens.functions.display import percent, short_number
from recall_lens.functions.scoring import CATEGORIES, risk_category
from recall_lens.operators.publish import SCORED_COLUMNS, top_devices

ALL = "All"


@dataclass(frozen=True)
class DeviceFilter:
    """The dashboard's choices; an empty list or one with 'All' leaves a column free."""

    categories: Sequence[str] = ()
    classes: Sequence[float | str] = ()
    causes: Sequence[str] = ()
    score: tuple[float, float] = (0.0, 1.0)
    min_recalls: int = 0
    missing_recalls_are_zero: bool = True

    def to_column(self) -> Column:
        recalls = F.col("recall_count")
        if self.missing_recalls_are_zero:
            recalls = F.coalesce(recalls, F.lit(0))
        condition = F.col("rpss").between(*self.score) & (recalls >= self.min_recalls)
        for name, chosen in (
            ("rpss_category", self.categories),
            ("device_class", self.classes),
            ("root_cause_description", self.causes),
        ):
            if chosen and ALL not in chosen:
                condition = condition & F.col(name).isin(list(chosen))
        return condition


def _long_sum(c: str) -> Column:
    return F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0).cast("long"))


def _count_of(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def summary_stats(scored: DataFrame) -> DataFrame:
    category = F.col("rpss_category")
    return scored.agg(
        F.count("*").alias("total_devices"),
        F.avg("rpss").alias("avg_rpss"),
        _long_sum("recall_count").alias("total_recalls"),
        _long_sum("total_adverse_events").alias("total_adverse"),
        *[_count_of(category == c).alias(f"{c.lower()}_count") for c in reversed(CATEGORIES)],
        F.coalesce(F.max("total_adverse_events"), F.lit(0)).alias("max_adverse_single_device"),
    )


def filter_options(scored: DataFrame) -> DataFrame:
    return (
        scored.filter(F.col("rpss_category").isNotNull())
        .select("rpss_category", "device_class", "root_cause_description")
        .distinct()
    )


def filtered_devices(scored: DataFrame, chosen: DeviceFilter, limit: int = 1000) -> DataFrame:
    return top_devices(scored.filter(chosen.to_column()).select(*SCORED_COLUMNS), limit)


def filtered_count(scored: DataFrame, chosen: DeviceFilter) -> DataFrame:
    return scored.filter(chosen.to_column()).agg(F.count("*").alias("cnt"))


def risk_distribution(scored: DataFrame, chosen: DeviceFilter) -> DataFrame:
    return (
        scored.filter(chosen.to_column())
        .groupBy("rpss_category")
        .agg(
            F.count("*").alias("count"),
            _long_sum("recall_count").alias("total_recalls"),
            _long_sum("total_adverse_events").alias("total_adverse"),
        )
    )


def risk_share(scored: DataFrame, chosen: DeviceFilter) -> DataFrame:
    """All four categories in order with their share of the devices; absent ones count zero."""
    counted = scored.filter(chosen.to_column()).agg(
        *[_count_of(F.col("rpss_category") == c).alias(c) for c in CATEGORIES]
    )
    total = sum((F.col(c) for c in CATEGORIES[1:]), F.col(CATEGORIES[0]))
    rows = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("position"), F.lit(c).alias("rpss_category"), F.col(c).alias("count"))
                for i, c in enumerate(CATEGORIES)
            ]
        )
    )
    share = F.coalesce(F.col("count") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return (
        counted.select(total.alias("total"), rows)
        .withColumn("share", share)
        .select("position", "rpss_category", "count", "share", percent(share).alias("share_text"))
    )


def root_cause_impact(
    scored: DataFrame,
    chosen: DeviceFilter,
    min_devices: int = 5,
    top: int = 10,
    distinct_devices: bool = True,
) -> DataFrame:
    """Mean score and totals per root cause; 'Other' and missing causes are left out."""
    devices = F.countDistinct("PMA_PMN_NUM") if distinct_devices else F.count("PMA_PMN_NUM")
    return (
        scored.filter(chosen.to_column() & (F.col("root_cause_description") != "Other"))
        .groupBy("root_cause_description")
        .agg(
            F.avg("rpss").alias("avg_rpss"),
            devices.alias("device_count"),
            _long_sum("recall_count").alias("total_recalls"),
            _long_sum("total_adverse_events").alias("total_adverse"),
        )
        .filter(F.col("device_count") >= min_devices)
        .orderBy(F.col("avg_rpss").desc(), "root_cause_description")
        .limit(top)
    )


def kpis(scored: DataFrame, chosen: DeviceFilter, mean_of_first: int | None = None) -> DataFrame:
    """Key figures of the chosen devices against all, in one pass over the scores.

    mean_of_first limits the mean score to that many top rows, as a row-limited dashboard shows it.
    """
    hit = chosen.to_column()
    kept = F.when(hit, F.col("rpss"))
    figures = scored.agg(
        F.count("*").alias("devices"),
        F.avg("rpss").alias("baseline"),
        _count_of(hit).alias("matching"),
        F.coalesce(F.avg(kept), F.lit(0.0)).alias("mean"),
        _count_of(hit & (F.col("rpss_category") == "Critical")).alias("critical_count"),
        F.coalesce(F.sum(F.when(hit, F.col("recall_count").cast("long"))), F.lit(0)).alias("total_recalls"),
        F.coalesce(F.sum(F.when(hit, F.col("total_adverse_events").cast("long"))), F.lit(0)).alias("total_adverse"),
    )
    if mean_of_first is not None:
        first = filtered_devices(scored, chosen, mean_of_first).agg(F.coalesce(F.avg("rpss"), F.lit(0.0)).alias("m"))
        figures = figures.withColumn("mean", first.scalar())
    per_device = lambda c: F.coalesce(F.col(c) / F.nullif(F.col("matching"), F.lit(0)), F.lit(0.0))
    return figures.select(
        F.col("matching").alias("devices_matching"),
        (F.col("matching") - F.col("devices")).alias("devices_delta"),
        F.col("mean").alias("avg_rpss"),
        (F.col("mean") - F.col("baseline")).alias("avg_rpss_delta"),
        "critical_count",
        (per_device("critical_count") * 100).alias("critical_pct"),
        "total_recalls",
        per_device("total_recalls").alias("avg_recalls"),
        "total_adverse",
        per_device("total_adverse").alias("avg_adverse"),
        short_number(F.col("total_adverse")).alias("adverse_text"),
    )


def score_bands(scored: DataFrame) -> DataFrame:
    """Devices per half-open score band; a score of exactly zero falls in none."""
    return scored.groupBy(risk_category(F.col("rpss"), zero_is_null=True).alias("band")).agg(
        F.count("*").alias("devices"), F.min("rpss").alias("lowest"), F.max("rpss").alias("highest")
    )
