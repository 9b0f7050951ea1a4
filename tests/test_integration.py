from __future__ import annotations

import datetime as dt
import re
import time
from pathlib import Path

import pytest

from compare import duck_records, same_rows
from feed_rows import LITERAL_VIEW, duck_feeds, random_rows, spark_feeds
from recall_lens.operators import integration, skew
from recall_lens.operators.integration import integrated_view, rollup_from_view
from recall_lens.operators.names import device_names, names_from_view
from recall_lens.operators.rollup import device_rollup, device_rollup_exact


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True)])
def test_view_equals_its_definition(spark, seed, hot):
    rows = random_rows(seed, hot=hot)
    view = integrated_view(spark_feeds(spark, rows))
    same_rows(view, duck_records(duck_feeds(rows), LITERAL_VIEW))


@pytest.mark.parametrize("seed, width", [(10, None), (11, 4)])
def test_view_is_the_same_when_codes_are_cut_into_many_cells(spark, monkeypatch, seed, width):
    monkeypatch.setattr(integration, "SLICE", 3)
    monkeypatch.setattr(integration, "MADE", 200)
    if width:
        monkeypatch.setattr(skew, "spread_width", lambda session: width)
    rows = random_rows(seed, hot=True)
    same_rows(integrated_view(spark_feeds(spark, rows)), duck_records(duck_feeds(rows), LITERAL_VIEW))


@pytest.mark.parametrize("seed, width", [(12, None), (13, 3)])
def test_view_is_the_same_when_values_are_looked_through_in_rounds(spark, monkeypatch, seed, width):
    monkeypatch.setattr(integration, "ROUND", 10)
    monkeypatch.setattr(integration, "SLICE", 3)
    if width:
        monkeypatch.setattr(skew, "spread_width", lambda session: width)
    rows = random_rows(seed, hot=True)
    same_rows(integrated_view(spark_feeds(spark, rows)), duck_records(duck_feeds(rows), LITERAL_VIEW))


def test_steps_of_the_view_leave_neither_shuffles_nor_sets(spark):
    """What a step shuffles is gone when the next begins, and the sets are deleted: disk holds the largest step only."""
    setting, shared = spark.conf.get(skew.REMOVED, None), Path(spark.conf.get("spark.checkpoint.dir"))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: set(re.findall(r"/(shuffle_\d+)_", manager.getAllFiles().mkString("\n")))
    feeds = spark_feeds(spark, random_rows(14, hot=True))
    before, staged = kept(), set(shared.glob("staged/*/*"))
    view = integrated_view(feeds)
    few = 4  # of the numbers that are collected: the tasks, and the values of each kind
    ends = time.monotonic() + 10  # files are removed in the background
    while len(kept() - before) > few and time.monotonic() < ends:
        time.sleep(0.2)
    assert len(kept() - before) <= few
    assert not [p for p in set(shared.glob("staged/*/*")) - staged if p.name.startswith("observed-sets")]
    assert "observed-sets" not in view._jdf.queryExecution().toString()
    assert spark.conf.get(skew.REMOVED, None) == setting


def test_pairs_of_the_view_are_never_shuffled_or_sorted(spark):
    """Nothing above the join that makes the pairs moves or sorts rows, so disk follows the feeds and not the pairs."""
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    view = integrated_view(spark_feeds(spark, random_rows(2, hot=True)))
    lines = view._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(re.match(r"[\s:|+*()\d-]*", line).group())
    made = [i for i, line in enumerate(lines) if re.search(r"SortMergeJoin(\(.*?\))? \[_code#\d+L?, _i#\d+, _j#\d+\],", line)]
    assert made
    above, least = [], depth(lines[made[0]])
    for line in reversed(lines[: made[0]]):
        if depth(line) < least:
            above.append(line)
            least = depth(line)
    assert len(above) > 5 and not [line for line in above if "Exchange" in line or "Sort " in line or "SortMergeJoin" in line]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before


@pytest.mark.parametrize("seed, hot", [(3, False), (4, True), (5, False)])
def test_linear_rollup_equals_summed_view(spark, seed, hot):
    feeds = spark_feeds(spark, random_rows(seed, hot=hot))
    expected = rollup_from_view(integrated_view(feeds)).collect()
    same_rows(device_rollup(feeds), [r.asDict() for r in expected])


def test_rollup_is_the_same_when_salted_and_repartitioned(spark, monkeypatch):
    rows = random_rows(6, hot=True)
    feeds = spark_feeds(spark, rows)
    expected = [r.asDict() for r in device_rollup(feeds).collect()]
    monkeypatch.setattr(skew, "spread_width", lambda session: 4)
    moved = type(feeds)(**{n: getattr(feeds, n).repartition(5) for n in rows})
    same_rows(device_rollup(moved), expected)
    same_rows(integrated_view(moved), duck_records(duck_feeds(rows), LITERAL_VIEW))


def test_one_code_holding_all_devices(spark):
    """1,500 approvals x 1,500 clearances of one code: linear work, equal to summing the 2.25 million pairs."""
    n, one = 1500, "C1"
    day = dt.date(2024, 1, 1)
    rows = {
        "pma": [(f"P{i}", "a", "g", "t", one) for i in range(n)],
        "premarket_510k": [(f"K{i}", "a", one, "T", "d") for i in range(n)],
        "product_code": [("s", one, "d", "2")],
        "maude": [
            (f"R{i % 900}", "Y", "N", day, "d", f"M{i % 7}", f"{'PK'[i % 2]}{i * i % n}") for i in range(6 * n)
        ],
        "recall": [
            (f"E{i % 40}", f"E{i % 40}", [f"P{i % n}", f"K{i * 3 % n}"], day, "Open", f"w{i % 3}", "Design")
            for i in range(n // 2)
        ],
    }
    expected = duck_records(
        duck_feeds(rows),
        """
        WITH e AS (SELECT PMA_PMN_NUM AS number, list_sort(list(DISTINCT MDR_REPORT_KEY)) AS x FROM maude GROUP BY ALL),
        t AS (SELECT DISTINCT unnest(k_numbers) AS number, res_event_number || reason_for_recall AS x FROM recall),
        r AS (SELECT number, list(x) AS x FROM t GROUP BY ALL),
        p AS (SELECT PMANUMBER AS number, coalesce(e.x, []) AS e, coalesce(r.x, []) AS r
              FROM pma LEFT JOIN e ON e.number = PMANUMBER LEFT JOIN r ON r.number = PMANUMBER),
        k AS (SELECT KNUMBER AS number, coalesce(e.x, []) AS e, coalesce(r.x, []) AS r
              FROM premarket_510k LEFT JOIN e ON e.number = KNUMBER LEFT JOIN r ON r.number = KNUMBER)
        SELECT p.number AS PMA_PMN_NUM, CAST(sum(
            (len(p.e) + len(k.e) - len(list_intersect(p.e, k.e)))
            * greatest(1, len(p.r) + len(k.r) - len(list_intersect(p.r, k.r)))) AS BIGINT) AS total_adverse_events
        FROM p, k GROUP BY ALL
        """,
    )
    rollup = device_rollup(spark_feeds(spark, rows))
    same_rows(rollup.select("PMA_PMN_NUM", "total_adverse_events"), expected)
    assert {r["recall_count"] for r in rollup.select("recall_count").collect()} == {40}


@pytest.mark.parametrize("seed", [7, 8])
def test_names_equal_greatest_name_of_view(spark, seed):
    feeds = spark_feeds(spark, random_rows(seed))
    expected = [r.asDict() for r in names_from_view(integrated_view(feeds)).collect()]
    same_rows(device_names(feeds, fallback=None), expected)
    filled = {r["PMA_PMN_NUM"]: r["device_name"] for r in device_names(feeds, "Unknown Device").collect()}
    assert all(filled[r["PMA_PMN_NUM"]] == (r["device_name"] or "Unknown Device") for r in expected)


def test_exact_rollup_counts_each_number_once(spark):
    rows = random_rows(9)
    found = {r["PMA_PMN_NUM"]: r for r in device_rollup_exact(spark_feeds(spark, rows)).collect()}
    numbers = {x[0] for x in rows["pma"] + rows["premarket_510k"] if x[0]}
    assert set(found) == numbers
    for n in numbers:
        own = [m for m in rows["maude"] if m[6] == n]
        assert found[n]["total_adverse_events"] == len({m[0] for m in own if m[0]})
        assert found[n]["unique_manufacturers"] == len({m[5] for m in own if m[5]})
        assert found[n]["recall_count"] == len({x[1] for x in rows["recall"] if x[1] and n in (x[2] or [])})
        days = [m[3] for m in own if m[3]]
        assert found[n]["first_event_date"] == (min(days) if days else None)


def test_no_pairwise_plan(spark):
    """The rollup must never join approvals with clearances, nor fall back to a nested loop."""
    plan = device_rollup(spark_feeds(spark, random_rows(3)))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
