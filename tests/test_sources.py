from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens import schemas
from recall_lens.functions.cleaning import clean_date, clean_json_value, clean_text, to_number, truncate_columns
from recall_lens.operators.rollup import device_rollup
from recall_lens.operators.skew import stage
from recall_lens.plans.ingest import cleaned_feeds, ingest
from recall_lens.sources import testdata
from recall_lens.sources.contracts import bounded_text_columns, schema_contract
from recall_lens.sources.delimited import (
    CORRUPT,
    DelimitedFeed,
    adverse_events,
    path_exists,
    read_feeds,
    read_processed_csv,
    read_table,
    read_text,
)
from recall_lens.sources.recall_feed import clean_recalls, flat_recalls, read_documents, read_lines


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(make(F.col("c"))).collect()]


def test_clean_text(spark):
    values = [" a b ", "", "   ", "\t\n", "NA", "N/A", "NULL", "nan", "nana", None, " NA "]
    expected = ["a b", None, None, None, None, None, None, None, "nana", None, "NA"]
    assert column(spark, values, clean_text) == expected


def test_clean_date(spark):
    values = [
        "2024-02-29", "02/29/2024", "2/9/2024", "20240229", "29-Feb-2024", "2024-02-29 10:11:12", " 2024/02/29 ",
        "Feb 9, 2024", "13/45/2020", "2023-02-29", "soon", "", None,
    ]
    d, e = dt.date(2024, 2, 29), dt.date(2024, 2, 9)
    assert column(spark, values, clean_date) == [d, d, e, d, d, d, d, e, None, None, None, None, None]


def test_numbers(spark):
    assert column(spark, ["1", " 2.5 ", "1e3", "x", "", None], to_number) == [1.0, 2.5, 1000.0, None, None, None]


def test_truncation_counts_characters(spark):
    df = spark.createDataFrame([("ééééé", "abcdef", None)], "a string, b string, c string")
    assert truncate_columns(df, {"a": 3, "b": None, "c": 2, "absent": 1}).first() == ("ééé", "abcdef", None)


def test_json_values(spark):
    text = lambda c: clean_json_value(c, T.StringType())
    assert column(spark, ["", " ", "  ", " x ", None], text) == [None, None, "", "x", None]
    nested = T.ArrayType(T.StringType())
    df = spark.createDataFrame([(["K1", "K2"],), (None,), ([],)], "c array<string>")
    assert [r[0] for r in df.select(clean_json_value(F.col("c"), nested)).collect()] == ['["K1","K2"]', None, "[]"]


def test_adverse_event_file(spark, tmp_path):
    path = tmp_path / "maude.txt"
    lines = [
        "MDR_REPORT_KEY|PMA_PMN_NUM|DATE_OF_EVENT|MANUFACTURER_NAME|NOT_IN_TABLE",
        '1| p000001 |01/31/2024|5" tube Caf\xe9|x',
        "2|NA|13/45/2020|NULL|x",
        "3|K000002|2024-02-01|   |x",
    ]
    path.write_bytes("\n".join(lines).encode("latin-1"))
    rows = {r["MDR_REPORT_KEY"]: r for r in read_table(spark, adverse_events(str(path))).collect()}
    assert rows["1"].asDict() == {
        "MDR_REPORT_KEY": "1", "PMA_PMN_NUM": "P000001", "DATE_OF_EVENT": dt.date(2024, 1, 31),
        "MANUFACTURER_NAME": '5" tube Café',
    }
    assert (rows["2"]["PMA_PMN_NUM"], rows["2"]["DATE_OF_EVENT"], rows["2"]["MANUFACTURER_NAME"]) == (None, None, None)
    assert rows["3"]["MANUFACTURER_NAME"] is None


def test_quoted_feed_and_widths(spark, tmp_path):
    path = tmp_path / "k.txt"
    path.write_text('KNUMBER|DEVICENAME|PRODUCTCODE\nK1|"a|b ""c"""|abc\n' + "K" * 30 + f"|{'d' * 1200}|x\n")
    rows = sorted(read_table(spark, DelimitedFeed("premarket_510k", str(path))).collect())
    assert rows[0].asDict() == {"KNUMBER": "K1", "DEVICENAME": 'a|b "c"', "PRODUCTCODE": "ABC"}
    assert (len(rows[1]["KNUMBER"]), len(rows[1]["DEVICENAME"])) == (20, 1000)


def test_undecodable_bytes_keep_the_row(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_bytes(b"PMANUMBER|APPLICANT\nP1|caf\xe9 \x93q\x94\n")
    assert read_text(spark, DelimitedFeed("pma", str(path))).first()["APPLICANT"].startswith("caf�")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        feed = DelimitedFeed("pma", str(path), encoding="windows-1252")
        assert read_text(spark, feed).first()["APPLICANT"] == "café “q”"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_quarantine_keeps_raw_text(spark, tmp_path):
    names = schemas.TABLES["pma"].names
    path = tmp_path / "p.txt"
    path.write_text("|".join(names) + "\n" + "|".join(["v"] * len(names)) + "\nonly|two\n" + "|".join(["w"] * (len(names) + 2)) + "\n")
    rows = read_text(spark, DelimitedFeed("pma", str(path)), quarantine=True).cache()
    bad = [r[CORRUPT] for r in rows.collect() if r[CORRUPT]]
    rows.unpersist()
    assert bad == ["|".join(["w"] * (len(names) + 2))]


def test_feeds_skip_absent_and_union(spark, tmp_path):
    (tmp_path / "a.txt").write_text("PMANUMBER|APPLICANT\nP1|x\n")
    (tmp_path / "b.txt").write_text("PMANUMBER|TRADENAME\nP2|y\n")
    feeds = [DelimitedFeed("pma", str(tmp_path / n)) for n in ("a.txt", "b.txt", "absent.txt")]
    feeds.append(DelimitedFeed("product_code", str(tmp_path / "none.txt")))
    tables = read_feeds(spark, feeds)
    assert set(tables) == {"pma"}
    assert sorted(map(tuple, tables["pma"].collect())) == [("P1", "x", None), ("P2", None, "y")]
    assert not path_exists(spark, str(tmp_path / "absent.txt"))


def test_processed_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,score,name\n1,0.5,a\n2,0.25,b\n")
    assert [t for _, t in read_processed_csv(spark, str(tmp_path / "c.csv")).dtypes] == ["int", "double", "string"]


RECALLS = [
    {"cfres_id": "1", "res_event_number": "E1", "k_numbers": [" k1 ", "K2", ""], "event_date_initiated": "2024-01-05",
     "root_cause_description": " Software design ", "openfda": {"device_class": ["2"]}, "reason_for_recall": " "},
    {"cfres_id": "2", "res_event_number": "E2", "event_date_initiated": "bad", "action": "  ", "city": "late key",
     "openfda": {}},
]


@pytest.mark.parametrize("lines", [False, True])
def test_recall_feed(spark, tmp_path, lines):
    path = tmp_path / "recall.json"
    path.write_text("\n".join(map(json.dumps, RECALLS)) if lines else json.dumps({"meta": 1, "results": RECALLS}))
    raw = (read_lines if lines else read_documents)(spark, str(path))
    first, second = clean_recalls(raw).orderBy("cfres_id").collect()
    assert first["k_numbers"] == ["K1", "K2", None] and first["event_date_initiated"] == dt.date(2024, 1, 5)
    assert first["root_cause_description"] == "Software design" and first["reason_for_recall"] is None
    assert json.loads(first["openfda"]) == {"device_class": ["2"]}
    assert second["k_numbers"] is None and second["event_date_initiated"] is None
    assert (second["action"], second["city"]) == ("", "late key")
    flat = flat_recalls(raw).orderBy("cfres_id").collect()
    assert json.loads(flat[0]["k_numbers"]) == [" k1 ", "K2", ""] and flat[1]["openfda"] == "{}"


def test_contract(spark):
    df = spark.createDataFrame([("a", "b")], "PMANUMBER string, EXTRA string").withColumn("DATERECEIVED", F.lit("x"))
    report = schema_contract(df, schemas.TABLES["pma"])
    assert not report.ok and report.extra == ("EXTRA",) and report.wrong_type == ("DATERECEIVED",)
    assert "APPLICANT" in report.missing
    assert schema_contract(spark.createDataFrame([], schemas.TABLES["pma"]), schemas.TABLES["pma"]).ok
    assert "PMANUMBER" in bounded_text_columns(schemas.TABLES["pma"])
    assert "AOSTATEMENT" not in bounded_text_columns(schemas.TABLES["pma"])


def test_schema_sizes():
    sizes = {n: (len(s), len(schemas.dates(s))) for n, s in schemas.TABLES.items()}
    assert sizes["maude"] == (84, 13) and sizes["premarket_510k"] == (22, 2) and sizes["pma"] == (22, 3)
    assert sizes["product_code"] == (18, 0) and sizes["recall"] == (23, 2)


def test_ingest_twice_then_roll_up(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    (raw / "pma.txt").write_text(
        "PMANUMBER|APPLICANT|GENERICNAME|TRADENAME|PRODUCTCODE\np1|a|pump|  |abc\n"
    )
    (raw / "k.txt").write_text("KNUMBER|APPLICANT|PRODUCTCODE|TYPE|DEVICENAME\nK1|a|ABC|T|valve\n")
    (raw / "code.txt").write_text("MEDICALSPECIALTY|PRODUCTCODE|DEVICENAME|DEVICECLASS\ncv|abc|pumps|3\n")
    (raw / "maude.txt").write_text(
        "MDR_REPORT_KEY|ADVERSE_EVENT_FLAG|PRODUCT_PROBLEM_FLAG|DATE_OF_EVENT|DISTRIBUTOR_NAME|MANUFACTURER_NAME|"
        "PMA_PMN_NUM\n1|Y|N|2024-01-01|d|m|p1\n2|Y|N|2024-03-01|d|m|K1 \n"
    )
    (raw / "recall.json").write_text(json.dumps({"results": RECALLS}))
    feeds = [
        DelimitedFeed("pma", str(raw / "pma.txt")),
        DelimitedFeed("premarket_510k", str(raw / "k.txt")),
        DelimitedFeed("product_code", str(raw / "code.txt")),
        adverse_events(str(raw / "maude.txt")),
        adverse_events(str(raw / "maude_mm.txt"), "maude_mm"),
    ]
    for _ in range(2):
        written = ingest(spark, feeds, str(raw / "recall.json"), target)
    assert sorted(written) == ["maude", "pma", "premarket_510k", "product_code", "recall"]
    row = device_rollup(cleaned_feeds(spark, target)).collect()
    assert len(row) == 1 and row[0]["PMA_PMN_NUM"] == "P1"
    assert (row[0]["recall_count"], row[0]["total_adverse_events"], row[0]["device_class"]) == (1, 2, 3.0)
    assert row[0]["root_cause_description"] == "Software design"


def test_recalls_are_joined_without_broadcasting_orders(spark):
    day = dt.datetime(2024, 1, 2)
    lines = [(1, 2, "R", 0.1), (1, 3, "R", 0.1), (2, 4, "N", 0.1), (3, 5, "R", 0.01), (9, 6, "R", 0.1), (None, 7, "R", 0.1)]
    orders = [(1, "1-URGENT", "O", day), (1, "4-LOW", "F", None), (2, "2-HIGH", "O", day), (3, "2-HIGH", "O", day), (None, "5", "O", day)]
    tables = {
        "lineitem": stage(spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string, l_discount double"), "lines"),
        "orders": stage(spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderstatus string, o_orderdate timestamp"), "orders"),
    }
    recalls = testdata.recall(tables)
    assert "Broadcast" not in recalls._jdf.queryExecution().sparkPlan().toString()
    found = {(r.cfres_id, r.k_numbers[0], r.recall_status, r.root_cause_description) for r in recalls.collect()}
    assert recalls.count() == len(found) == 4
    assert found == {("1", n, s, c) for n in ("K000002", "P000003") for s, c in (("O", "Software design"), ("F", None))}
