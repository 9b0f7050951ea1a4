"""Feeds whose files, rows or members are not as the first of them promises."""

import datetime as dt
import json

from pyspark.sql import functions as F

from recall_lens.functions.cleaning import clean_date
from recall_lens.operators.names import device_names
from recall_lens.operators.skew import spread_rank
from recall_lens.operators.timeseries import dates_by_rank, plain_series, spread_series
from recall_lens.plans.ingest import ingest
from recall_lens.sources.delimited import DelimitedFeed, read_feeds, read_text
from recall_lens.sources.recall_feed import clean_recalls, flat_recalls, read_documents
from recall_lens.sources.testdata import feeds


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("KNUMBER|APPLICANT|DEVICENAME|PRODUCTCODE\nK1|app1|pump|AAA\n")
    (tmp_path / "b.txt").write_text("KNUMBER|DEVICENAME|PRODUCTCODE|APPLICANT\nK2|lens|BBB|app3\nK3|few\n")
    feed = DelimitedFeed("premarket_510k", str(tmp_path / "*.txt"))
    rows = {r.KNUMBER: r for r in read_feeds(spark, [feed])["premarket_510k"].collect()}
    assert (rows["K2"].APPLICANT, rows["K2"].DEVICENAME, rows["K2"].PRODUCTCODE) == ("app3", "lens", "BBB")
    assert (rows["K1"].APPLICANT, rows["K1"].PRODUCTCODE) == ("app1", "AAA")
    assert (rows["K3"].DEVICENAME, rows["K3"].APPLICANT) == ("few", None)


def test_rows_with_surplus_fields_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text("KNUMBER|APPLICANT|PRODUCTCODE\nK1|app|AAA\nK2|a|P|MP|AAA\nK3|b|BBB\n")
    feed = DelimitedFeed("premarket_510k", str(path))
    assert read_text(spark, feed).count() == 2
    target = str(tmp_path / "tables")
    assert ingest(spark, [feed], None, target) == ["premarket_510k", "quarantine/premarket_510k"]
    assert {r.KNUMBER for r in spark.read.parquet(f"{target}/premarket_510k").collect()} == {"K1", "K3"}
    assert [r._corrupt_record for r in spark.read.parquet(f"{target}/quarantine/premarket_510k").collect()] == ["K2|a|P|MP|AAA"]


def test_recall_members_of_any_shape(spark, tmp_path):
    openfda = {"device_name": "Pump", "registration_number": ["1", "2"]}
    recalls = [
        {"cfres_id": "1", "k_numbers": ["k1 ", "K2"], "openfda": openfda},
        {"cfres_id": "2", "k_numbers": "k3", "openfda": {}},
        {"cfres_id": "3", "k_numbers": None},
        {"cfres_id": "4"},
    ]
    (tmp_path / "r.json").write_text(json.dumps({"results": recalls}))
    raw = read_documents(spark, str(tmp_path / "r.json"))
    rows = {r.cfres_id: r for r in clean_recalls(raw).collect()}
    assert [rows[k].k_numbers for k in "1234"] == [["K1", "K2"], ["K3"], None, None]
    assert json.loads(rows["1"].openfda) == openfda
    flat = {r.cfres_id: r for r in flat_recalls(raw).collect()}
    assert json.loads(flat["1"].k_numbers) == ["k1 ", "K2"] and flat["2"].k_numbers == "k3"


def test_dates_of_many_layouts(spark):
    day = dt.date(2020, 1, 5)
    same = ["1/5/20", "January 5, 2020", "5 January 2020", "01-05-2020", "2020.01.05", "05JAN2020", "20200105 1030", "5 Jan 2020", "2020-01-05T10:30:00"]
    rows = spark.createDataFrame([(t,) for t in [*same, "13/45/2020", "1/5/99", "soon"]], "t string").select("t", clean_date(F.col("t")).alias("d"))
    got = {r.t: r.d for r in rows.collect()}
    assert all(got[t] == day for t in same)
    assert (got["13/45/2020"], got["1/5/99"], got["soon"]) == (None, dt.date(1999, 1, 5), None)


def test_series_of_text_dates(spark):
    rows = [("a", "01/05/2024", "High", 2), ("b", "no date", "High", 5), ("c", None, "Low", 1), ("d", "2024-01-09", "Low", 0)]
    scored = spark.createDataFrame(rows, "PMA_PMN_NUM string, last_scored string, rpss_category string, recall_count long")
    got = {(r.period, r.category): (r.total_recalls, r.device_count) for r in plain_series(scored).collect()}
    assert got == {("2024-01", "All"): (2.0, 2), ("2024-01", "High"): (2.0, 1), ("2024-01", "Low"): (0.0, 1)}
    assert spread_series(scored).count() > 0


def test_rows_without_a_key_are_ranked_last(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3), (None, 4)], "PMA_PMN_NUM string, x int")
    ranked = {r.x if r.PMA_PMN_NUM is None else (r.PMA_PMN_NUM, r.x): r.rank for r in spread_rank(rows, F.col("PMA_PMN_NUM"), "rank").collect()}
    assert sorted(ranked.values()) == [1, 2, 3, 4, 5] and {ranked[3], ranked[4]} == {4, 5}
    assert dates_by_rank(rows, dt.date(2025, 1, 1)).count() == 5
    within = spread_rank(rows.withColumn("g", F.when(F.col("x") > 1, 1)), F.col("PMA_PMN_NUM"), "rank", ["g"])
    assert sorted((r.g or 0, r.rank) for r in within.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3)]


def test_names_of_asked_devices_equal_all_names(spark):
    source = feeds(spark, "/root/testdata/sf0.001")
    whole = {r.PMA_PMN_NUM: r.device_name for r in device_names(source).collect()}
    asked = [*sorted(whole)[:15], "unheard of"]
    only = spark.createDataFrame([(a,) for a in asked], "PMA_PMN_NUM string")
    got = {r.PMA_PMN_NUM: r.device_name for r in device_names(source, only=only).collect()}
    assert set(got) == set(asked) and all(got[a] == whole[a] for a in asked[:-1])
