"""Table writers: append, full refresh, create-or-replace, versioned upsert, views."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens.operators.publish import dedup_staging, scored_view


def append(df: DataFrame, path: str) -> None:
    """Add rows. A failing task fails the job, so no part of a load is lost unseen."""
    df.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table; loading a source twice leaves it as loading it once."""
    df.write.mode("overwrite").parquet(path)


def create_or_replace(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType) -> None:
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(table)


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    """Markers of finished versions; a version without one is a failed run and is passed over."""
    try:
        return spark.read.schema("version string").json(f"{root}/_finished")
    except AnalysisException as error:  # the folder appears with the first finished version
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> str | None:
    markers = _versions(spark, root)
    return None if markers is None else markers.agg(F.max("version")).first()[0]


def write_version(
    spark: SparkSession,
    root: str,
    merge: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    scored_at: dt.datetime,
    view: str,
) -> DataFrame:
    """Merge into the newest version and write the result beside it: readers of the old one are not disturbed.

    The table being read is never overwritten. The version counts once its marker is written, after the data. Two runs at
    once write folders of their own; the one whose name sorts last is read from then on.
    """
    newest = current_version(spark, root)
    if newest is None:
        stamp = F.lit(scored_at.isoformat(sep=" ")).cast("timestamp_ntz")
        merged = dedup_staging(source).withColumn("last_scored", stamp)
        number = 1
    else:
        merged = merge(spark.read.parquet(f"{root}/{newest}"))
        number = int(newest.removeprefix("v").partition("-")[0]) + 1
    version = f"v{number:010d}-{uuid.uuid4().hex[:12]}"
    scored_view(merged).write.mode("error").parquet(f"{root}/{version}")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{root}/_finished")
    published = spark.read.parquet(f"{root}/{version}")
    replace_view(published, view)
    return published
