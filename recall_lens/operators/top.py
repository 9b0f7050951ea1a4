"""The rows that can be among the N highest, for an N too large for one task to merge N rows of every partition.

A mergeable quantile sketch of the order's first column gives a threshold a little below the N-th row, exact counts confirm
it, and only rows from the threshold on go further. Where many rows tie at the threshold, those above it are in for sure and
the same is done among the tied ones for the next part of the order: six bytes of the key after six bytes. What is left is
little more than N rows, which Spark's sorted limit puts in their exact order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketch; it errs by about 0.02 % of the rows.
SKETCH = 16_000
#: Rows that may be left for the sorted limit, as a multiple of N and besides.
TIMES, BESIDES = 1.5, 1000
#: Bytes of a key compared at once, and how many times; longer equal beginnings are left to the sorted limit.
KEY_BYTES, KEY_PARTS = 6, 6


def _kind(by: str) -> Column:
    """2 for NaN, 1 for a number and 0 for null: the order of the kinds."""
    c = F.col(by).cast("double")
    return F.when(F.isnan(c), 2).when(c.isNotNull(), 1).otherwise(0)


def _key_parts(key: str) -> Iterator[Column]:
    """The key's bytes, some at a time, as numbers that fall where the text rises; a missing key comes first."""
    data = F.col(key).cast("string").cast("binary")
    for i in range(KEY_PARTS):
        digits = F.rpad(F.hex(F.substring(data, 1 + i * KEY_BYTES, KEY_BYTES)), 2 * KEY_BYTES, "0")
        yield F.coalesce(-F.conv(digits, 16, 10).cast("double"), F.lit(1.0))


def _refine(df: DataFrame, value: Column, need: int, rows: int) -> tuple[Column, Column | None, int, int]:
    """The rows of `df` whose value can be among the `need` highest: (condition, condition of rows surely in, how many are
    still needed among the others, how many others)."""
    kept, slack = F.lit(True), 4.0 / SKETCH
    while rows > TIMES * need + BESIDES:
        share = max(0.0, 1.0 - need / rows - slack)
        left = df.filter(kept).select(value.alias("value"))
        sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH))
        limit = left.agg(F.kll_sketch_get_quantile_double(sketch, F.lit(share)).alias("limit")).first().limit
        above, tied = left.agg(F.count_if(F.col("value") > limit).alias("a"), F.count_if(F.col("value") == limit).alias("t")).first()
        if above + tied < need:
            slack *= 4
        elif above < need and tied > BESIDES + need / 2 and above + tied > TIMES * need + BESIDES:
            return kept & (value == limit), kept & (value > limit), need - above, tied
        elif above >= need and above + tied > 0.9 * rows:
            slack /= 4
            kept, rows = kept & (value >= limit), above + tied
        else:
            kept, rows = kept & (value >= limit), above + tied
    return kept, None, need, rows


def candidates(df: DataFrame, n: int, by: str, key: str) -> DataFrame:
    """Rows of `df` with all of the `n` highest by `by`, descending (NaN first, null last), and `key`, among them."""
    kinds = {r.kind: r.rows for r in df.groupBy(_kind(by).alias("kind")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    if n <= 0 or sum(kinds.values()) <= n:
        return df.filter(F.lit(n > 0))
    sure, need, kind = F.lit(False), n, 2
    while kinds.get(kind, 0) < need:
        need -= kinds.get(kind, 0)
        sure = sure | (_kind(by) == kind)
        kind -= 1
    open_, rows = _kind(by) == kind, kinds[kind]
    for value in ([F.col(by).cast("double")] if kind == 1 else []) + list(_key_parts(key)):
        kept, above, need, rows = _refine(df.filter(open_), value, need, rows)
        if above is not None:
            sure = sure | (open_ & above)
        open_ = open_ & kept
        if above is None:
            break
    return df.filter(sure | open_)


def highest(df: DataFrame, n: int, by: str, key: str) -> DataFrame:
    """The `n` highest rows in order, ties by `key`."""
    return candidates(df, n, by, key).orderBy(F.col(by).desc_nulls_last(), key).limit(n)
