"""Commits of folders, bucketed merges, named loads and ingests as a whole, with writers that fail or meet."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recall_lens.operators.publish import upsert_scores
from recall_lens.plans import ingest as plan
from recall_lens.sinks.bucketed import BucketedTable
from recall_lens.sinks.ledger import FAILED, LOADED, REPLAYED, Ledger
from recall_lens.sinks.manifest import Conflict, Store
from recall_lens.sources.delimited import DelimitedFeed
from test_publish import NEW, OLD, STAGED, row

AT = dt.datetime(2025, 1, 1)


def test_commits_are_whole_and_numbered_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    assert store.current().number == 0
    first = spark.range(3)
    folder = store.write(first, "t")
    made = store.commit(store.current(), {"t": [folder]}, {"t": first.schema.jsonValue()}, why="first")
    assert (made.number, store.current().notes) == (1, {"why": "first"})
    second = store.write(spark.range(5), "t")
    assert store.table("t").count() == 3
    with pytest.raises(Conflict):
        store.commit(type(made)(), {"t": [second]}, made.schemas)
    assert store.table("t").count() == 3
    calls = []

    def meeting(last):
        calls.append(last.number)
        if len(calls) == 1:  # someone else commits in between
            store.commit(last, last.folders, last.schemas, why="other")
        return {**last.folders, "u": [second]}, {**last.schemas, "u": made.schemas["t"]}, {}

    assert store.update(meeting).number == 3 and calls == [1, 2]
    assert (store.table("t").count(), store.table("u").count()) == (3, 5)
    assert store.table("t", store.read(1)).count() == 3
    with pytest.raises(KeyError):
        store.table("absent")


def test_expired_folders_are_those_of_old_commits(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    schema = spark.range(1).schema.jsonValue()
    folders = [store.write(spark.range(i + 1), "t") for i in range(4)]
    for folder in folders:
        store.update(lambda last, f=folder: ({"t": [f]}, {"t": schema}, {}))
    assert store.expire(keep=2) == folders[:2]
    assert store.table("t").count() == 4
    assert store.table("t", store.read(3)).count() == 3
    assert store.update(lambda last: None).number == 4


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/scores", "PMA_PMN_NUM", buckets=16)
    all_rows = [row(f"K{i:04d}", i / 400) for i in range(400)]
    first = spark.createDataFrame(all_rows, STAGED)
    stamp = F.lit(OLD.isoformat(sep=" ")).cast("timestamp_ntz")
    made = table.merge(first, lambda old: first.withColumn("last_scored", stamp))
    assert made.notes["rewritten"] == [str(b) for b in range(16)]
    source = spark.createDataFrame([row("K0007", 0.9), row("K0300", 0.8), row("new", 0.1)], STAGED)
    made = table.merge(source, lambda old: upsert_scores(old, source, NEW))
    before = table.store.read(1)
    rewritten = set(made.notes["rewritten"])
    assert 1 <= len(rewritten) <= 3
    assert {b for b in made.folders if made.folders[b] != before.folders.get(b)} == rewritten
    found = {r.PMA_PMN_NUM: (r.rpss, r.last_scored) for r in table.read().collect()}
    whole = upsert_scores(first.withColumn("last_scored", stamp), source, NEW)
    assert found == {r.PMA_PMN_NUM: (r.rpss, r.last_scored) for r in whole.collect()}
    assert table.read(before).count() == 400
    assert {r.PMA_PMN_NUM: r.rpss for r in table.lookup(["K0007", "new", "absent"]).collect()} == {"K0007": 0.9, "new": 0.1}


def test_merge_that_would_lose_rows_is_refused(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/scores", "id", buckets=16)
    with pytest.raises(KeyError):
        table.read()
    with pytest.raises(ValueError):
        table.merge(spark.range(1), lambda old: spark.range(50))
    with pytest.raises(KeyError):
        table.read()
    table.merge(spark.range(50), lambda old: spark.range(50))
    gone = table.merge(spark.range(50), lambda old: old.filter("id < 3"))
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2] and len(gone.folders) <= 3


def test_loads_count_once(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/loads")
    assert ledger.attempts().count() == 0
    assert ledger.load("events", "2024", lambda: spark.range(10), AT).status == LOADED
    assert ledger.load("events", "2024", lambda: spark.range(10), AT).status == REPLAYED
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("torn file"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="torn file"):
        ledger.load("events", "2025", lambda: broken, AT)
    assert ledger.read("events").count() == 10
    assert ledger.load("events", "2025", lambda: spark.range(4).withColumn("more", F.lit(1)), AT).rows == 4
    rows = ledger.read("events")
    assert rows.count() == 14 and rows.filter("more = 1").count() == 4
    entered = {(r.load_id, r.status): (r.rows, r.error) for r in ledger.attempts().collect()}
    assert entered[("2024", LOADED)] == (10, None) and entered[("2024", REPLAYED)] == (None, None)
    assert entered[("2025", LOADED)] == (4, None) and "torn file" in entered[("2025", FAILED)][1]
    with pytest.raises(KeyError):
        ledger.read("other")


def test_two_loaders_at_once(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/loads")
    other = Ledger(spark, f"{tmp_path}/loads")

    def slow():
        assert other.load("events", "a", lambda: spark.range(2), AT).status == LOADED
        assert other.load("events", "b", lambda: spark.range(3), AT).status == LOADED
        return spark.range(2)

    assert ledger.load("events", "a", slow, AT).status == REPLAYED
    assert ledger.read("events").count() == 5


def test_ingest_that_fails_leaves_the_set_before(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "tables")
    feeds = []
    for name, text in {
        "pma": "PMANUMBER|PRODUCTCODE\nP1|A\n",
        "premarket_510k": "KNUMBER|PRODUCTCODE\nK1|A\nK2|A|x\n",
        "product_code": "PRODUCTCODE|DEVICENAME\nA|pump\n",
        "maude": "PMA_PMN_NUM|MDR_REPORT_KEY\nP1|1\n",
    }.items():
        (tmp_path / f"{name}.txt").write_text(text)
        feeds.append(DelimitedFeed(name, str(tmp_path / f"{name}.txt")))
    (tmp_path / "recall.json").write_text('{"results": [{"cfres_id": "1"}]}')
    made = plan.ingest_together(spark, feeds, str(tmp_path / "recall.json"), target)
    assert sorted(made.notes["written"]) == ["maude", "pma", "premarket_510k", "product_code", "quarantine/premarket_510k", "recall"]
    before = {n: sorted(map(tuple, getattr(plan.cleaned_feeds(spark, target), n).collect())) for n in ("pma", "recall", "maude")}
    (tmp_path / "pma.txt").write_text("PMANUMBER|PRODUCTCODE\nP9|Z\n")

    def torn(raw):
        return raw.withColumn("cfres_id", F.raise_error(F.lit("torn document")))

    monkeypatch.setattr(plan, "clean_recalls", torn)
    with pytest.raises(Exception, match="torn document"):
        plan.ingest_together(spark, feeds, str(tmp_path / "recall.json"), target)
    assert {n: sorted(map(tuple, getattr(plan.cleaned_feeds(spark, target), n).collect())) for n in before} == before
    monkeypatch.undo()
    (tmp_path / "premarket_510k.txt").unlink()
    made = plan.ingest_together(spark, feeds, str(tmp_path / "recall.json"), target)
    assert "premarket_510k" in made.folders and "quarantine/premarket_510k" not in made.folders
    assert [r.PMANUMBER for r in plan.cleaned_feeds(spark, target).pma.collect()] == ["P9"]
