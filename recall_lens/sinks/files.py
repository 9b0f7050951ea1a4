"""CSV files for people and spreadsheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"

PREDICTION_COLUMNS = (
    "PMA_PMN_NUM",
    "rpss_category",
    "recall_count",
    "recall_probability",
    "predicted_recall",
    "total_adverse_events",
)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Chosen columns as CSV with a header, one file per partition."""
    picked = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    picked.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """The capped snapshot as one UTF-8 file that starts with a byte order mark.

    One task writes it: the snapshot is limited to a fixed number of rows by its own definition.
    """
    first, *_ = snapshot.columns
    marked = snapshot.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    marked.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
