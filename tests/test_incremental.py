"""A rollup kept up by loads equals one from scratch, whatever the loads hold."""

import pytest

from compare import same_rows
from feed_rows import random_rows, spark_feeds
from recall_lens.operators import incremental, rollup
from recall_lens.operators.incremental import RollupState
from recall_lens.operators.rollup import device_rollup, device_rollup_exact
from recall_lens.operators.skew import stage
from recall_lens.sinks.manifest import Conflict


def dicts(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize(("seed", "hot"), [(21, False), (22, True)])
def test_loads_equal_one(spark, tmp_path, seed, hot):
    rows = random_rows(seed, hot=hot)
    feeds = spark_feeds(spark, rows)
    state = RollupState(spark, f"{tmp_path}/state", buckets=4)
    of = lambda **some: spark_feeds(spark, {**rows, **some})
    for events, recalls in ((rows["maude"][:60], rows["recall"][:3]), (rows["maude"][40:], rows["recall"][2:])):
        load = of(maude=events, recall=recalls)
        state.add_events(load.maude)
        state.add_recalls(load.recall)
    same_rows(state.rollup(feeds), dicts(device_rollup(feeds)))
    same_rows(state.rollup_exact(feeds), dicts(device_rollup_exact(feeds)))
    before = dicts(state.rollup(feeds))
    state.add_events(feeds.maude)  # nothing new
    state.add_recalls(feeds.recall)
    same_rows(state.rollup(feeds), before)


def test_no_step_broadcasts_a_growing_table(spark, tmp_path, monkeypatch):
    feeds, plans = spark_feeds(spark, random_rows(25)), {}

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(rollup, "stage", noted)
    noted(device_rollup(feeds), "rollup")
    noted(device_rollup_exact(feeds), "exact")
    state = RollupState(spark, f"{tmp_path}/state", buckets=4)
    state.add_events(feeds.maude)
    state.add_recalls(feeds.recall)
    noted(state.sets.unseen(state.sets.read()), "unseen")
    noted(state.recalls.unseen(state.recalls.read()), "unseen recalls")
    assert {"rollup", "exact", "device-facts", "owned-sets", "shared-sets", "unseen"} <= set(plans)
    assert [label for label, plan in plans.items() if "Broadcast" in plan] == []
    assert max(plan.count("\n") for plan in plans.values()) < 250


def test_steps_stay_small_plans(spark, monkeypatch):
    """The driver plans a step again after each of its shuffles, so it is the largest plan that fills its heap."""
    plans = {}

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(rollup, "stage", noted)
    noted(device_rollup(spark_feeds(spark, random_rows(26))), "rollup")
    assert max(plan.count("Join") for plan in plans.values()) <= 6
    assert "ShuffledHashJoin" in plans["owned-sets"]


def test_a_load_into_an_empty_state_is_staged_once(spark, tmp_path, monkeypatch):
    load, staged = spark_feeds(spark, random_rows(27)), []
    monkeypatch.setattr(incremental, "stage", lambda df, label: staged.append(label) or stage(df, label))
    state = RollupState(spark, f"{tmp_path}/state", buckets=4)
    state.add_events(load.maude)
    state.add_recalls(load.recall)
    assert staged == ["load-sets", "load-recalls"]


def test_held_rows_are_not_rewritten(spark, tmp_path):
    rows = random_rows(23)
    state = RollupState(spark, f"{tmp_path}/state", buckets=4)
    first = state.add_events(spark_feeds(spark, {**rows, "maude": rows["maude"][:100]}).maude)
    second = state.add_events(spark_feeds(spark, {**rows, "maude": rows["maude"][100:]}).maude)
    assert all(second.folders[b][: len(f)] == f for b, f in first.folders.items())
    read = state.sets.store.spark.read.parquet
    fresh = sum(read(f"{state.sets.store.root}/{f}").count() for b, folders in second.folders.items() for f in folders[len(first.folders.get(b, [])) :])
    assert fresh < state.sets.read(first).count()


def test_loads_that_meet(spark, tmp_path):
    state = RollupState(spark, f"{tmp_path}/state", buckets=4)
    load = spark_feeds(spark, random_rows(24)).recall
    state.add_recalls(load)
    old = state.recalls.store.read(1)
    state.add_recalls(load.limit(0))
    with pytest.raises(Conflict):
        state.recalls.append(state.recalls.unseen(state.recalls.read().limit(0), old), old)
