"""From scoring runs to the published table: one row per device, upsert, snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recall_lens.functions.display import NO_NAME
from recall_lens.operators.names import with_device_names
from recall_lens.operators.scoring import SCORED_COLUMNS
from recall_lens.operators.skew import unbroadcast
from recall_lens.operators.top import highest

KEY = "PMA_PMN_NUM"
SNAPSHOT_ROWS = 50_000
#: Longest list for which n rows of every partition are merged.
LONG_LIST = 5_000
# The columns of the snapshot file, in its order.
SNAPSHOT_COLUMNS = (
    "PMA_PMN_NUM",
    "rpss",
    "rpss_category",
    "recall_count",
    "total_adverse_events",
    "unique-manufacturers",
    "device_class",
    "root_cause_description",
    "last_scored",
    "device_name",
)


def dedup_staging(staged: DataFrame) -> DataFrame:
    """One row per device, the highest score first and the other columns as tie-break.

    An aggregate rather than a ranked window: a device staged many times is reduced before the shuffle.
    """
    rest = [c for c in staged.columns if c not in (KEY, "rpss")]
    best = F.max(F.struct("rpss", *rest)).alias("best")
    return staged.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(best).select(KEY, "best.*").select(*staged.columns)


def upsert_scores(target: DataFrame, source: DataFrame, scored_at: dt.datetime) -> DataFrame:
    """Target after the merge: source rows stamped with the run time, target rows without a match kept as they are."""
    fresh = dedup_staging(source.select(*SCORED_COLUMNS)).withColumn(
        "last_scored", F.lit(scored_at.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    return target.join(unbroadcast(fresh), KEY, "left_anti").select(*fresh.columns).unionByName(fresh)


def scored_view(published: DataFrame) -> DataFrame:
    """The nine published columns."""
    return published.select(
        "PMA_PMN_NUM", "rpss", "rpss_category", "recall_count", "total_adverse_events", "unique_manufacturers",
        "device_class", "root_cause_description", "last_scored",
    )


def top_devices(scored: DataFrame, n: int, by: str = "rpss") -> DataFrame:
    """The n highest devices, ties by device number; NaN ranks above all numbers and null below them.

    Spark's sorted limit merges n rows of every partition. For a long list rows below a threshold are left out first.
    """
    if n > LONG_LIST:
        return highest(scored, n, by, KEY)
    return scored.orderBy(F.col(by).desc_nulls_last(), KEY).limit(n)


def snapshot(published: DataFrame, names: DataFrame | None, rows: int = SNAPSHOT_ROWS) -> DataFrame:
    """The rows of the CSV snapshot: highest scores with names, manufacturer column renamed.

    Only the rows kept are joined with names. Without names every device shows the placeholder.
    """
    top = top_devices(scored_view(published), rows)
    named = top.withColumn("device_name", F.lit(NO_NAME)) if names is None else with_device_names(top, names)
    return named.withColumnRenamed("unique_manufacturers", "unique-manufacturers").select(
        *[F.col(f"`{c}`") for c in SNAPSHOT_COLUMNS]
    )
