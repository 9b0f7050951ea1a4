"""Score refresh: feeds to scores to the published table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from recall_lens.operators.publish import upsert_scores
from recall_lens.operators.rollup import device_rollup, device_rollup_exact
from recall_lens.operators.scoring import score_devices
from recall_lens.operators.skew import drop_staged, staged_so_far
from recall_lens.sinks.tables import write_version
from recall_lens.sources.testdata import Feeds


def score(feeds: Feeds, exact: bool = False) -> DataFrame:
    """Scores of all devices; `exact` leaves out the view's fan-out."""
    return score_devices(device_rollup_exact(feeds) if exact else device_rollup(feeds))


def refresh(
    spark: SparkSession, feeds: Feeds, root: str, scored_at: dt.datetime, view: str = "device_rpss"
) -> DataFrame:
    """Score, merge into the newest version under `root`, write the next version, point the view at it."""
    before = staged_so_far()
    source = score(feeds)
    published = write_version(
        spark, root, lambda target: upsert_scores(target, source, scored_at), source, scored_at, view
    )
    drop_staged(spark, before)
    return published
