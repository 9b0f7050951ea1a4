"""Readers of published scores: table, database, CSV snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.functions.cleaning import NA_TOKENS, clean_date, to_number, with_alias
from recall_lens.sinks.files import BYTE_ORDER_MARK
from recall_lens.sources.encodings import USUAL, decoded, layouts

NUMERIC = ("rpss", "recall_count", "total_adverse_events", "device_class")


def read_scores(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Published scores; naming columns prunes the scan to them."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A table of an external database, read in parallel ranges of a numeric or date key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=options or {},
    )


def _snapshot_text(spark: SparkSession, path: str, encoding: str | tuple[str, ...]) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"')
    if isinstance(encoding, str):
        raw = reader.option("encoding", encoding).csv(path)
        return raw.toDF(*[c.removeprefix(BYTE_ORDER_MARK) for c in raw.columns])
    parts = [decoded(reader.option("encoding", found.read_as).csv(list(found.paths)), found) for found in layouts(spark, path, encoding)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_snapshot(spark: SparkSession, path: str, encoding: str | tuple[str, ...] = USUAL) -> DataFrame:
    """The CSV snapshot: byte order mark dropped, numbers and dates coerced, absent columns filled.

    Of several encodings each file has the first that fits it; a single one saves the pass that finds out.
    """
    raw = _snapshot_text(spark, path, encoding)
    cells = {c: F.when(~F.col(f"`{c}`").isin(list(NA_TOKENS)), F.col(f"`{c}`")) for c in raw.columns}
    df = raw.withColumns(cells)
    df = with_alias(df, "unique_manufacturers", ["unique-manufacturers"])
    numbers = [c for c in (*NUMERIC, "unique_manufacturers") if c in df.columns]
    df = df.withColumns({c: to_number(F.col(c).cast("string")) for c in numbers})
    if "last_scored" in df.columns:
        stamp = F.col("last_scored").try_cast("timestamp_ntz")
        df = df.withColumn("last_scored", F.coalesce(stamp, clean_date(F.col("last_scored")).cast("timestamp_ntz")))
    return with_alias(df, "device_name", [], F.col("PMA_PMN_NUM").cast("string"))
