"""Every registered query against its SQL twin, over the whole smallest tables."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from compare import duck_records, same_rows
from recall_lens.plans import queries as plans

FOLDER = entry_point.SMOKE_FOLDER
# the operators for training data have tests of their own
OWN = [n for n in entry_point.queries() if n not in plans.QUERIES]
QUERIES, ORACLE = plans.QUERIES, entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_registered_names():
    assert set(plans.QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.queries())
    assert all(n == "pipeline" or re.match(r"op\d+_", n) for n in OWN)


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(QUERIES)))
def test_equals_sql(spark, tables, name):
    records = duck_records(tables, ORACLE[name])
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(records[0])
    same_rows(found, records)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert name.startswith("ml_")
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[-2:] == ["rpss", "rpss_category"] and df.count() == 194
