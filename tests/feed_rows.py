"""Small random feeds with the awkward cases, as rows, as Spark feeds, and as DuckDB tables."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pyarrow as pa

from recall_lens.sources.testdata import Feeds

SCHEMAS = {
    "pma": "PMANUMBER string, APPLICANT string, GENERICNAME string, TRADENAME string, PRODUCTCODE string",
    "premarket_510k": "KNUMBER string, APPLICANT string, PRODUCTCODE string, TYPE string, DEVICENAME string",
    "product_code": "MEDICALSPECIALTY string, PRODUCTCODE string, DEVICENAME string, DEVICECLASS string",
    "maude": "MDR_REPORT_KEY string, ADVERSE_EVENT_FLAG string, PRODUCT_PROBLEM_FLAG string, DATE_OF_EVENT date, "
    "DISTRIBUTOR_NAME string, MANUFACTURER_NAME string, PMA_PMN_NUM string",
    "recall": "cfres_id string, res_event_number string, k_numbers array<string>, event_date_initiated date, "
    "recall_status string, reason_for_recall string, root_cause_description string",
}


def random_rows(seed: int, events: int = 150, hot: bool = False) -> dict[str, list[tuple]]:
    r = random.Random(seed)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(900))
    maybe = lambda x, p=0.15: None if r.random() < p else x
    codes = ["C1", "C2", "C3", "C4"] if not hot else ["C1"] * 9 + ["C2"]
    approvals = [f"P{i}" for i in range(7)] + ["X1"]
    clearances = [f"K{i}" for i in range(7)] + ["X1"]
    text = lambda s: r.choice([s, s, "", "  ", None])
    numbers = approvals + clearances + ["Z9"]
    pick = lambda: r.choice(numbers) if not hot or r.random() > 0.4 else "P0"
    pma = [
        (
            maybe(r.choice(approvals), 0.12), r.choice(["a", "b"]), text(f"g{r.randrange(4)}"),
            text(f"t{r.randrange(4)}"), maybe(r.choice(codes)),
        )
        for _ in range(18)
    ]
    k510 = [
        (
            maybe(r.choice(clearances), 0.12), r.choice(["a", "b"]), maybe(r.choice(codes + ["C5"])),
            maybe("510(k)"), text(f"d{r.randrange(5)}"),
        )
        for _ in range(18)
    ]
    product = [
        (maybe("spec"), maybe(r.choice(codes + ["C9"])), text(f"n{r.randrange(3)}"), maybe(r.choice(["1", "2", "3", "U", "2.9"])))
        for _ in range(8)
    ]
    maude = [
        (
            maybe(f"R{r.randrange(events // 3)}", 0.05), r.choice(["Y", "N", None]), r.choice(["Y", "N", None]),
            maybe(day()), maybe(f"D{r.randrange(4)}"), maybe(f"M{r.randrange(4)}"), maybe(pick(), 0.05),
        )
        for _ in range(events)
    ]
    tuples = [
        (f"E{r.randrange(5)}", maybe(day(), 0.2), maybe("Open"), maybe(f"why{r.randrange(2)}"), maybe(r.choice(
            ["Software design", "Labeling design", "Other", "PACKAGING"]), 0.4))
        for _ in range(8)
    ]
    recall = []
    for _ in range(22):
        event, when, status, why, cause = r.choice(tuples)
        named = r.choice([None, [], [pick()], [pick(), pick()], [pick(), pick(), None]])
        recall.append((event, maybe(event, 0.1), named, when, status, why, cause))
    recall += recall[:3]
    return {"pma": pma, "premarket_510k": k510, "product_code": product, "maude": maude, "recall": recall}


def spark_feeds(spark, rows: dict[str, list[tuple]]) -> Feeds:
    return Feeds(**{name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})


def duck_feeds(rows: dict[str, list[tuple]]) -> duckdb.DuckDBPyConnection:
    kinds = {"string": pa.string(), "date": pa.date32(), "array<string>": pa.list_(pa.string())}
    connection = duckdb.connect()
    for name, schema in SCHEMAS.items():
        fields = [f.strip().split(" ") for f in schema.split(", ")]
        columns = list(zip(*rows[name])) or [[] for _ in fields]
        table = pa.table({f: pa.array(list(c), kinds[t]) for (f, t), c in zip(fields, columns)})
        connection.register(f"{name}_in", table)
        connection.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_in")
    return connection


# The view exactly as its definition reads: outer join, three OR joins, one aggregate.
LITERAL_VIEW = """
SELECT coalesce(p.PMANUMBER, k.KNUMBER) AS PMA_PMN_NUM, p.PMANUMBER AS pma_number, p.PRODUCTCODE AS pma_product_code,
       p.APPLICANT AS pma_applicant, p.GENERICNAME, p.TRADENAME, k.KNUMBER AS k_number,
       k.PRODUCTCODE AS k_product_code, k.APPLICANT AS k_applicant, k.DEVICENAME AS k_devicename, k.TYPE AS k_type,
       count(DISTINCT m.MDR_REPORT_KEY) AS adverse_event_count,
       sum(CASE WHEN m.ADVERSE_EVENT_FLAG = 'Y' THEN 1 ELSE 0 END) AS total_adverse_flag,
       sum(CASE WHEN m.PRODUCT_PROBLEM_FLAG = 'Y' THEN 1 ELSE 0 END) AS total_product_problem_flag,
       min(m.DATE_OF_EVENT) AS first_event_date, max(m.DATE_OF_EVENT) AS last_event_date,
       count(DISTINCT m.MANUFACTURER_NAME) AS unique_manufacturers,
       count(DISTINCT m.DISTRIBUTOR_NAME) AS unique_distributors,
       c.DEVICENAME AS pc_devicename, c.DEVICECLASS, c.MEDICALSPECIALTY, r.res_event_number AS cfres_id,
       r.recall_status, r.event_date_initiated, r.reason_for_recall, r.root_cause_description
FROM pma p FULL OUTER JOIN premarket_510k k ON p.PRODUCTCODE = k.PRODUCTCODE
LEFT JOIN maude m ON m.PMA_PMN_NUM = p.PMANUMBER OR m.PMA_PMN_NUM = k.KNUMBER
LEFT JOIN product_code c ON c.PRODUCTCODE = p.PRODUCTCODE OR c.PRODUCTCODE = k.PRODUCTCODE
LEFT JOIN recall r ON list_contains(r.k_numbers, p.PMANUMBER) OR list_contains(r.k_numbers, k.KNUMBER)
GROUP BY ALL
"""
