"""Queries with exact answers against their SQL."""

import duckdb
import pytest

from recall_lens.llm import queries

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op2_repeats", "op6_quality_rules", "op8_near_duplicates"])
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = con.execute(queries.ORACLE[name])
    names = [d[0] for d in expected.description]
    found = queries.QUERIES[name](spark, FOLDER).select(*names)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
