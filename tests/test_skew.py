from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recall_lens.operators.skew import hot_salted_join, hot_values, salted_join, shared_folder, spread_rank, spread_width, stage, unbroadcast


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    many = spark.range(400).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'c' || id % 5 END k", "id")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("c1", 3), ("c2", 4), (None, 5)], "k string, v int")
    expected = sorted(many.join(few, ["k"], how).collect(), key=str)
    assert sorted(salted_join(many, few, ["k"], ["id"], how, spread=6).collect(), key=str) == expected


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("spread", [1, 6])
def test_a_side_that_grows_is_never_broadcast(spark, spread):
    many = stage(spark.range(400).selectExpr("id % 5 AS k", "id"), "many")
    few = stage(spark.range(5).selectExpr("id AS k", "id AS v"), "few")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert "Broadcast" not in plan_of(salted_join(many, few, ["k"], ["id"], how, spread=spread))
    assert "BroadcastHashJoin" in plan_of(salted_join(many, few, ["k"], ["id"], spread=spread, bounded=True))
    hot = stage(hot_values(many, "k"), "hot")
    joined = plan_of(hot_salted_join(many, few, ["k"], hot, ["id"], spread=spread))
    assert joined.count("SortMergeJoin") == 1  # the list of hot values, at most 100, may be broadcast
    assert "Broadcast" not in plan_of(many.join(unbroadcast(few), "k"))


def test_hot_key_is_dealt_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = spark.range(8000).withColumn("k", F.lit("hot"))
        joined = salted_join(many, spark.createDataFrame([("hot", 1)], "k string, v int"), ["k"], ["id"], spread=32)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) >= 6 and max(r["count"] for r in per_task) < 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_values_and_their_join(spark):
    many = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE 'v' || id END x", "id")
    few = spark.range(0, 6000, 2).selectExpr("'v' || id AS x", "id AS v").union(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "x string, v long")
    )
    hot = hot_values(many, "x")
    assert [r["x"] for r in hot.collect()] == ["hot"]
    expected = sorted(many.join(few, "x").collect())
    assert sorted(hot_salted_join(many, few, ["x"], hot, ["id"], spread=5).collect()) == expected
    assert sorted(hot_salted_join(many, few, ["x"], hot.limit(0), ["id"], spread=5).collect()) == expected


def test_width_follows_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        widths = []
        for n in ("8", "200", "2000", "20000"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            widths.append(spread_width(spark))
        assert widths == [1, 3, 31, 32]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_spread_rank_is_exact(spark):
    df = spark.range(3000).selectExpr("id", "id % 3 AS g")
    ranked = spread_rank(df, F.col("id"), "r", ["g"])
    for g, rows in ranked.groupBy("g").agg(F.collect_list("r")).collect():
        assert sorted(rows) == list(range(1, 1001))
    totals = {r["r_total"] for r in spread_rank(df, F.col("id"), "r").collect()}
    assert totals == {3000}


def test_stage_cuts_lineage_in_the_shared_folder(spark):
    staged = stage(spark.range(10).withColumn("d", F.current_date()), "numbers")
    assert staged.count() == 10
    assert all(f.startswith("file:") and shared_folder(spark).split(":")[-1] in f for f in staged.inputFiles())
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)
