from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feed_rows import random_rows, spark_feeds
from recall_lens.operators import publish, skew
from recall_lens.operators.names import lookup_names, name_coverage, publish_names, with_device_names
from recall_lens.operators.publish import dedup_staging, snapshot, top_devices, upsert_scores
from recall_lens.plans.refresh import refresh, score
from recall_lens.sinks.files import write_csv, write_snapshot
from recall_lens.sinks.tables import append, create_if_absent, create_or_replace, full_refresh, write_version
from recall_lens.schemas import DEVICE_RPSS
from recall_lens.sources.scores import read_scores, read_snapshot

STAGED = (
    "PMA_PMN_NUM string, recall_count long, total_adverse_events long, unique_manufacturers long, "
    "device_class double, root_cause_description string, rpss double, rpss_category string"
)
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)


def row(key, score, recalls=1):
    return (key, recalls, 10, 2, 2.0, "Design", score, "Low")


def stamped(df, when):
    return df.withColumn("last_scored", F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz"))


def test_dedup_keeps_highest_score(spark):
    df = spark.createDataFrame([row("a", 0.1), row("a", 0.3), row("b", 0.2), row("b", 0.2, 5), row(None, 1.0)], STAGED)
    kept = {r["PMA_PMN_NUM"]: (r["rpss"], r["recall_count"]) for r in dedup_staging(df).collect()}
    assert kept == {"a": (0.3, 1), "b": (0.2, 5)}


def test_upsert_matched_new_and_target_only(spark):
    target = stamped(spark.createDataFrame([row("keep", 0.5), row("change", 0.1)], STAGED), OLD)
    source = spark.createDataFrame([row("change", 0.9), row("new", 0.4), row("new", 0.2)], STAGED)
    once = upsert_scores(target, source, NEW)
    found = {r["PMA_PMN_NUM"]: (r["rpss"], r["last_scored"]) for r in once.collect()}
    assert found == {"keep": (0.5, OLD), "change": (0.9, NEW), "new": (0.4, NEW)}
    twice = upsert_scores(once, source, NEW)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_versions_never_overwrite_what_is_read(spark, tmp_path):
    root = str(tmp_path / "scores")
    first = spark.createDataFrame([row("a", 0.1), row("b", 0.2)], STAGED)
    write_version(spark, root, lambda t: upsert_scores(t, first, OLD), first, OLD, "device_rpss_test")
    second = spark.createDataFrame([row("b", 0.7), row("c", 0.3)], STAGED)
    write_version(spark, root, lambda t: upsert_scores(t, second, NEW), second, NEW, "device_rpss_test")
    found = {r["PMA_PMN_NUM"]: (r["rpss"], r["last_scored"]) for r in spark.table("device_rpss_test").collect()}
    assert found == {"a": (0.1, OLD), "b": (0.7, NEW), "c": (0.3, NEW)}
    assert read_scores(spark, f"{root}/v0000000001-*", ["PMA_PMN_NUM"]).count() == 2


def test_append_and_refresh(spark, tmp_path):
    df = spark.createDataFrame([row("a", 0.1)], STAGED)
    for _ in range(2):
        append(df, str(tmp_path / "appended"))
        full_refresh(df, str(tmp_path / "refreshed"))
    assert spark.read.parquet(str(tmp_path / "appended")).count() == 2
    assert spark.read.parquet(str(tmp_path / "refreshed")).count() == 1


def test_catalog_tables(spark):
    create_if_absent(spark, "scores_absent", DEVICE_RPSS)
    create_if_absent(spark, "scores_absent", DEVICE_RPSS)
    assert spark.table("scores_absent").schema.names == DEVICE_RPSS.names
    for score in (0.1, 0.2):
        create_or_replace(spark.createDataFrame([row("a", score)], STAGED), "scores_replaced")
    assert [r["rpss"] for r in spark.table("scores_replaced").collect()] == [0.2]


def test_snapshot_round_trip(spark, tmp_path):
    scored = stamped(spark.createDataFrame([row("a", 0.1), row("b", 0.9), row("c", 0.9)], STAGED), NEW)
    names = spark.createDataFrame([("a", 'Stent "é"'), ("b", None)], "PMA_PMN_NUM string, device_name string")
    shot = snapshot(scored, names)
    assert {r["PMA_PMN_NUM"]: r["device_name"] for r in shot.collect()} == {"a": 'Stent "é"', "b": "—", "c": "—"}
    assert name_coverage(shot).first().asDict() == {"total_rows": 3, "named_rows": 1}
    assert [r["PMA_PMN_NUM"] for r in snapshot(scored, names, rows=2).collect()] == ["b", "c"]
    path = str(tmp_path / "snapshot")
    write_snapshot(shot, path)
    files = list((tmp_path / "snapshot").glob("*.csv"))
    assert len(files) == 1 and files[0].read_bytes().startswith(b"\xef\xbb\xbf")
    back = read_snapshot(spark, path)
    found = {r["PMA_PMN_NUM"]: (r["rpss"], r["unique_manufacturers"], r["device_name"]) for r in back.collect()}
    assert found["a"] == (0.1, 2, 'Stent "é"') and found["b"] == (0.9, 2, "—")
    assert {r["device_name"] for r in snapshot(scored, None).collect()} == {"—"}


def test_snapshot_without_optional_columns(spark, tmp_path):
    (tmp_path / "bare.csv").write_text("PMA_PMN_NUM,rpss,recall_count\nK1,0.5,3\nK2,NA,x\n")
    rows = {r["PMA_PMN_NUM"]: r for r in read_snapshot(spark, str(tmp_path / "bare.csv")).collect()}
    assert (rows["K1"]["device_name"], rows["K1"]["unique_manufacturers"], rows["K1"]["recall_count"]) == ("K1", 0, 3)
    assert rows["K2"]["rpss"] is None and rows["K2"]["recall_count"] is None


def test_named_columns_to_csv(spark, tmp_path):
    write_csv(spark.createDataFrame([row("a", 0.1)], STAGED), str(tmp_path / "out"), ["PMA_PMN_NUM", "rpss"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["PMA_PMN_NUM", "rpss"]


def test_name_lookup_falls_back_to_key(spark):
    scored = spark.createDataFrame([row("a", 0.1), row("b", 0.2)], STAGED)
    names = spark.createDataFrame([("a", "Pump")], "PMA_PMN_NUM string, device_name string")
    named = with_device_names(scored, names, F.col("PMA_PMN_NUM"))
    assert {r["PMA_PMN_NUM"]: r["device_name"] for r in named.collect()} == {"a": "Pump", "b": "b"}


def test_top_of_any_size_keeps_ties_nan_and_null_in_order(spark):
    rows = [row(f"k{i:05d}", None if i % 50 == 0 else float("nan") if i == 77 else (i * 37 % 400) / 400) for i in range(12000)]
    scored = spark.createDataFrame(rows, STAGED)
    order = sorted(rows, key=lambda r: (r[6] is None, r[6] == r[6], -(r[6] or 0) if r[6] == r[6] else 0, r[0]))
    for n in (1, 7, 9999, 10000, 11990, 50000):
        assert [r["PMA_PMN_NUM"] for r in top_devices(scored, n).collect()] == [r[0] for r in order[:n]]


def test_refresh_publishes_and_leaves_no_staged_tables(spark, tmp_path):
    feeds = spark_feeds(spark, random_rows(11))
    root = str(tmp_path / "published")
    first = refresh(spark, feeds, root, OLD)
    expected = {r["PMA_PMN_NUM"]: r["rpss"] for r in score(feeds).collect()}
    assert {r["PMA_PMN_NUM"]: r["rpss"] for r in first.collect()} == pytest.approx(expected)
    before = skew.staged_so_far()
    second = refresh(spark, feeds, root, NEW, view="device_rpss_again")
    assert skew.staged_so_far() == before
    assert {r["last_scored"] for r in second.collect()} == {NEW}
    assert spark.table("device_rpss_again").count() == len(expected)


def test_top_devices_breaks_ties_by_number(spark):
    scored = spark.createDataFrame([row("b", 0.5), row("a", 0.5), row("c", None), row("d", 0.9)], STAGED)
    assert [r["PMA_PMN_NUM"] for r in top_devices(scored, 3).collect()] == ["d", "a", "b"]


def test_published_names_are_looked_up(spark, tmp_path):
    names = spark.range(30_000).selectExpr("concat('K', lpad(id, 6, '0')) AS PMA_PMN_NUM", "if(id % 9 = 0, NULL, concat('name ', id)) AS device_name")
    publish_names(names, f"{tmp_path}/names")
    table = spark.read.parquet(f"{tmp_path}/names")
    asked = spark.createDataFrame([("K000010",), ("K000010",), ("K029999",), ("K000009",), ("unheard",), (None,)], "PMA_PMN_NUM string")
    found = lookup_names(table, asked)
    assert sorted((r[0] or "", r[1]) for r in found.collect()) == [("", None), ("K000009", None), ("K000010", "name 10"), ("K029999", "name 29999"), ("unheard", None)]
    assert "EqualTo(PMA_PMN_NUM,K000010)" in found._jdf.queryExecution().toString()
    many = lookup_names(table, table.select("PMA_PMN_NUM"))
    assert many.count() == 30_000 and many.filter("device_name IS NULL").count() == names.filter("device_name IS NULL").count()
    assert lookup_names(table, asked.limit(0)).count() == 0


def test_what_is_kept_follows_the_files(spark, tmp_path):
    before = skew.folder_state(spark, str(tmp_path))
    spark.range(1).write.parquet(f"{tmp_path}/t.parquet")
    after = skew.folder_state(spark, str(tmp_path))
    assert before != after == skew.folder_state(spark, str(tmp_path))
    assert skew.folder_state(spark, f"{tmp_path}/absent") == "absent"


def test_names_are_looked_up_without_a_broadcast(spark):
    table = skew.stage(spark.range(1000).selectExpr("concat('K', id) AS PMA_PMN_NUM", "concat('name ', id) AS device_name"), "names")
    found = lookup_names(table, table.select("PMA_PMN_NUM").unionByName(spark.createDataFrame([("unheard",)], "PMA_PMN_NUM string")))
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    assert found.count() == 1001 and found.filter("device_name IS NULL").count() == 1
