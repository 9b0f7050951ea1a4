"""Registered queries that write given tables as feeds, files or versions and return what their readers find."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.functions.cleaning import with_alias
from recall_lens.operators.skew import shared_folder
from recall_lens.plans.ingest import cleaned_feeds, ingest_together
from recall_lens.schemas import TABLES
from recall_lens.sinks.files import write_csv, write_snapshot
from recall_lens.sinks.ledger import Ledger
from recall_lens.sinks.tables import append, create_if_absent, create_or_replace, full_refresh, replace_view
from recall_lens.sources.contracts import schema_contract
from recall_lens.sources.delimited import DelimitedFeed, adverse_events, read_feeds, read_processed_csv
from recall_lens.sources.scores import read_snapshot

AT = dt.datetime(2025, 1, 1)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/feeds/{uuid.uuid4().hex}"


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _piped(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    """Columns of text joined by pipes, without quotes or escapes, under a header."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    writer = df.select(line.alias("|".join(df.columns))).write.option("header", True).option("encoding", encoding)
    writer.option("sep", "\x01").option("quote", "\x02").option("escapeQuotes", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def ingest_adverse_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as two adverse-event files, main and supplemental, in Latin-1 with quotes that are data; one is absent."""
    root, events = new_folder(spark), _read(spark, folder, "events")
    rows = events.select(
        F.col("event_id").alias("MDR_REPORT_KEY"),
        F.concat(F.lit(" k"), F.col("user_id")).alias("PMA_PMN_NUM"),
        F.date_format("ts", "MM/dd/yyyy").alias("DATE_OF_EVENT"),
        F.concat(F.lit('"Gerät" é " '), F.col("event_type")).alias("MANUFACTURER_NAME"),
        F.when(F.col("event_type") == "error", "N/A").otherwise(F.col("props")).alias("DISTRIBUTOR_NAME"),
    )
    for name, odd in (("main", 0), ("supplement", 1)):
        _piped(rows.filter(F.col("MDR_REPORT_KEY") % 2 == odd), f"{root}/{name}")
    feeds = [adverse_events(f"{root}/{name}/*.csv") for name in ("main", "supplement", "absent")]
    return read_feeds(spark, feeds)["maude"].select(*rows.columns)


def _as_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the columns of the score table, without a manufacturer count or a name."""
    return _read(spark, folder, "customer").select(
        F.concat(F.lit("K"), F.col("c_custkey")).alias("PMA_PMN_NUM"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal")).alias("rpss"),
        F.col("c_mktsegment").alias("rpss_category"),
        F.col("c_nationkey").cast("long").alias("recall_count"),
        F.lit("2024-05-01").alias("last_scored"),
    )


def snapshot_file(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a snapshot file with a byte order mark, read back: numbers coerced, absent columns filled."""
    path = new_folder(spark)
    write_snapshot(_as_scores(spark, folder), path)
    return read_snapshot(spark, path)


def chosen_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen columns of the customers as CSV, types inferred by the reader, made a table, and its view read."""
    path, name = new_folder(spark), f"processed_{uuid.uuid4().hex}"
    write_csv(_as_scores(spark, folder), path, ["PMA_PMN_NUM", "rpss", "recall_count"])
    processed = read_processed_csv(spark, path)
    create_or_replace(processed.limit(1), name)
    create_or_replace(processed, name)
    create_if_absent(spark, name, processed.schema)
    replace_view(with_alias(spark.table(name), "events", ["recall_count"]), f"{name}_view")
    return spark.table(f"{name}_view")


def appended_and_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """Nations appended twice and loaded twice by full refresh."""
    root, nation = new_folder(spark), _read(spark, folder, "nation")
    for _ in range(2):
        append(nation, f"{root}/appended")
        full_refresh(nation, f"{root}/refreshed")
    kinds = [spark.read.parquet(f"{root}/{kind}").withColumn("kind", F.lit(kind)) for kind in ("appended", "refreshed")]
    return kinds[0].unionByName(kinds[1])


def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the columns of the documents miss of the clearances' contract, and what they have besides."""
    docs = _read(spark, folder, "documents").withColumnsRenamed({"source": "APPLICANT", "doc_id": "KNUMBER"})
    found = schema_contract(docs, TABLES["premarket_510k"])
    rows = [(kind, name) for kind in ("missing", "extra", "wrong_type") for name in getattr(found, kind)]
    return spark.createDataFrame(rows, "finding string, column_name string")


def _attempt(action: Callable[[], object]) -> None:
    """Run a load that is made to fail; its error is in the ledger."""
    try:
        action()
    except (PySparkException, Py4JJavaError):
        return
    raise AssertionError("the load was made to fail")


def load_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events in two named loads, the first repeated, the second failing once; what the ledger and the table then hold."""
    ledger, events = Ledger(spark, new_folder(spark)), _read(spark, folder, "events")
    even, odd = (events.filter(F.col("event_id") % 2 == k) for k in (0, 1))
    torn = odd.withColumn("value", F.when(F.col("event_id") % 10 == 1, F.raise_error(F.lit("torn"))).otherwise(F.col("value")))
    ledger.load("events", "even", lambda: even, AT)
    ledger.load("events", "even", lambda: even, AT)
    _attempt(lambda: ledger.load("events", "odd", lambda: torn, AT))
    ledger.load("events", "odd", lambda: odd, AT)
    attempts = ledger.attempts().groupBy("load_id", "status").agg(F.count(F.lit(1)).alias("attempts"), F.sum("rows").alias("rows"))
    table = ledger.read("events").agg(F.lit("all").alias("load_id"), F.lit("in the table").alias("status"), F.lit(None).cast("long").alias("attempts"), F.count(F.lit(1)).alias("rows"))
    return attempts.unionByName(table)


def _tear(spark: SparkSession, path: str) -> None:
    """Make plain files pass for compressed ones, which then cannot be read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        if status.getPath().getName().startswith("part-"):
            files.rename(status.getPath(), status.getPath().suffix(".gz"))


def ingest_set(spark: SparkSession, folder: str) -> DataFrame:
    """All feeds in one commit, then again from other files of which one cannot be read: the first set is what is found."""
    root = new_folder(spark)
    part, orders = _read(spark, folder, "part"), _read(spark, folder, "orders")
    number = F.concat(F.lit("K"), F.col("p_partkey"))

    def write(place: str, prefix: str) -> list[DelimitedFeed]:
        tables = {
            "pma": part.select(F.concat(F.lit(prefix), F.col("p_partkey")).alias("PMANUMBER"), F.col("p_brand").alias("PRODUCTCODE")),
            "premarket_510k": part.select(number.alias("KNUMBER"), F.col("p_brand").alias("PRODUCTCODE"), F.col("p_name").alias("DEVICENAME")),
            "product_code": part.select(F.col("p_brand").alias("PRODUCTCODE")).distinct(),
            "maude": orders.select(F.col("o_orderkey").alias("MDR_REPORT_KEY"), F.concat(F.lit("K"), F.col("o_custkey")).alias("PMA_PMN_NUM")),
        }
        for name, table in tables.items():
            _piped(table, f"{place}/{name}", "UTF-8")
        return [DelimitedFeed(name, f"{place}/{name}/*.csv") for name in tables]

    recalls = orders.select(F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("cfres_id"))).alias("value"))
    for place in ("recalls", "torn"):
        recalls.write.text(f"{root}/{place}")
    _tear(spark, f"{root}/torn")
    ingest_together(spark, write(f"{root}/first", "P"), f"{root}/recalls", f"{root}/tables", recall_lines=True)
    again = write(f"{root}/second", "X")
    _attempt(lambda: ingest_together(spark, again, f"{root}/torn", f"{root}/tables", recall_lines=True))
    found = cleaned_feeds(spark, f"{root}/tables")
    columns = {"pma": "PMANUMBER", "premarket_510k": "KNUMBER", "product_code": "PRODUCTCODE", "maude": "MDR_REPORT_KEY", "recall": "cfres_id"}
    rows = [getattr(found, name).select(F.lit(name).alias("feed"), F.col(c).alias("number")) for name, c in columns.items()]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return whole


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_adverse_events": ingest_adverse_events,
    "snapshot_file": snapshot_file,
    "chosen_columns": chosen_columns,
    "appended_and_refreshed": appended_and_refreshed,
    "contract_report": contract_report,
    "load_ledger": load_ledger,
    "ingest_set": ingest_set,
}
