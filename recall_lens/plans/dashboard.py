"""One filtered view of the scores: every answer shares the same condition over the same table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from recall_lens.operators import analytics
from recall_lens.operators.analytics import DeviceFilter


@dataclass(frozen=True)
class Dashboard:
    devices: DataFrame
    matching: DataFrame
    distribution: DataFrame
    share: DataFrame
    causes: DataFrame
    kpis: DataFrame


def dashboard(scored: DataFrame, chosen: DeviceFilter, limit: int = 1000) -> Dashboard:
    return Dashboard(
        devices=analytics.filtered_devices(scored, chosen, limit),
        matching=analytics.filtered_count(scored, chosen),
        distribution=analytics.risk_distribution(scored, chosen),
        share=analytics.risk_share(scored, chosen),
        causes=analytics.root_cause_impact(scored, chosen),
        kpis=analytics.kpis(scored, chosen),
    )
