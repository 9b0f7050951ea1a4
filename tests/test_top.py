"""Long top lists: exact, ties included, with little more than N rows in the last merge."""

import random

import pytest
from pyspark.sql import functions as F

from recall_lens.operators import top
from recall_lens.operators.publish import top_devices

N = 3_000


def order(row):
    key, value = row
    kind = 0 if value is None else 2 if value != value else 1
    return -kind, -(value if kind == 1 else 0), (key is not None, (key or "").encode())


def scores(kind, rng, rows=60_000):
    for i in range(rows):
        key = f"K{rng.randrange(10**9):09d}-{i}"
        if kind == "spread":
            yield key, rng.gauss(0, 1)
        elif kind == "few values":
            yield key, rng.choice([0.1, 0.2, 0.9])
        elif kind == "one value":
            yield "same beginning of every key" + key, 0.5
        elif kind == "null and nan":
            yield key, rng.choice([None, None, None, float("nan")]) if rng.random() < 0.98 else rng.random()
        elif kind == "mostly null":
            yield key, None if i % 100 else float("inf") * rng.choice([1, -1])


@pytest.mark.parametrize("kind", ["spread", "few values", "one value", "null and nan", "mostly null"])
def test_exact_and_small(spark, kind):
    rows = list(scores(kind, random.Random(7)))
    df = spark.createDataFrame(rows, "PMA_PMN_NUM string, rpss double")
    left = top.candidates(df, N, "rpss", "PMA_PMN_NUM")
    assert N <= left.count() <= top.TIMES * N + top.BESIDES + N
    found = [(r.PMA_PMN_NUM, repr(r.rpss)) for r in top.highest(df, N, "rpss", "PMA_PMN_NUM").collect()]
    assert found == [(k, repr(v)) for k, v in sorted(rows, key=order)[:N]]


def test_equal_rows_and_missing_keys(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, "é").alias("PMA_PMN_NUM"), F.lit(1.0).alias("rpss"))
    found = top.highest(df, N + 5, "rpss", "PMA_PMN_NUM").groupBy("PMA_PMN_NUM").count().collect()
    assert {r.PMA_PMN_NUM: r["count"] for r in found} == {None: 3000, "é": 5}


def test_fewer_rows_than_asked(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "PMA_PMN_NUM string, rpss double")
    assert [r.PMA_PMN_NUM for r in top_devices(df, 50_000).collect()] == ["a", "b"]
    assert top_devices(df.limit(0), 50_000).count() == 0
    assert top.highest(df, 0, "rpss", "PMA_PMN_NUM").count() == 0
