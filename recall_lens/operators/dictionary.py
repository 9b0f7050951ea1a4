"""Ordered numbers for the distinct values of a column, however many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recall_lens.operators.skew import stage

#: monotonically_increasing_id holds the partition above this bit and the row's place below it.
_PLACE_BITS = 33


def ordered_codes(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Every distinct value of `column` that is not null, with its place (from 0) among them in ascending order.

    Values are dealt to ranges and sorted inside them; a range's first number is how many values the ranges before it hold.
    Only those counts, one for each range, are summed up in one task.
    """
    values = df.filter(F.col(f"`{column}`").isNotNull()).select(F.col(f"`{column}`").alias("value")).distinct()
    ranged = values.repartitionByRange("value").sortWithinPartitions("value").withColumn("at", F.monotonically_increasing_id())
    placed = stage(ranged, "values").withColumn("part", F.shiftright("at", _PLACE_BITS))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    number = F.col("first") + F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(firsts, "part").select(F.col("value").alias(column), number.alias(code))
