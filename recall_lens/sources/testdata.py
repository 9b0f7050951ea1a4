"""The device feeds as they are derived from the test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.operators.skew import unbroadcast


@dataclass(frozen=True)
class Feeds:
    """The five cleaned tables every plan starts from."""

    pma: DataFrame
    premarket_510k: DataFrame
    product_code: DataFrame
    maude: DataFrame
    recall: DataFrame


class _Tables:
    """The test tables, each opened once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder, self._open = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._open[name]


def device_number(part_key: Column) -> Column:
    """Letter by parity, then the key padded to six digits; longer keys stay whole."""
    letter = F.when(part_key % 2 == 0, F.lit("K")).otherwise(F.lit("P"))
    digits = part_key.cast("string")
    return F.concat(letter, F.when(part_key < 1_000_000, F.lpad(digits, 6, "0")).otherwise(digits))


def _coded_parts(tables: _Tables) -> DataFrame:
    part = tables["part"]
    return part.withColumn("band", F.col("p_size") % 10).withColumn(
        "code", F.concat_ws("-", "p_brand", "p_type", F.col("band").cast("string"))
    )


def pma(tables: _Tables) -> DataFrame:
    return _coded_parts(tables).filter(F.col("p_partkey") % 2 != 0).select(
        device_number(F.col("p_partkey")).alias("PMANUMBER"),
        F.col("p_brand").alias("APPLICANT"),
        F.col("p_name").alias("GENERICNAME"),
        F.when(F.col("p_size") % 4 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("TRADENAME"),
        F.col("code").alias("PRODUCTCODE"),
    )


def premarket_510k(tables: _Tables) -> DataFrame:
    return _coded_parts(tables).filter(F.col("p_partkey") % 2 == 0).select(
        device_number(F.col("p_partkey")).alias("KNUMBER"),
        F.col("p_brand").alias("APPLICANT"),
        F.col("code").alias("PRODUCTCODE"),
        F.col("p_type").alias("TYPE"),
        F.when(F.col("p_size") % 5 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("DEVICENAME"),
    )


def product_code(tables: _Tables) -> DataFrame:
    band = F.col("band")
    device_class = (
        F.when(band <= 2, F.lit("1")).when(band <= 5, F.lit("2")).when(band <= 7, F.lit("3")).otherwise(F.lit("U"))
    )
    return (
        _coded_parts(tables)
        .filter(band != 9)
        .groupBy("code", "p_type", "band")
        .agg(F.min("p_name").alias("DEVICENAME"))
        .select(
            F.col("p_type").alias("MEDICALSPECIALTY"),
            F.col("code").alias("PRODUCTCODE"),
            "DEVICENAME",
            device_class.alias("DEVICECLASS"),
        )
    )


def maude(tables: _Tables) -> DataFrame:
    """Adverse events; the device number needs the part key only, which the line carries."""
    line = tables["lineitem"]
    supplier = tables["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    yes_no = lambda hit: F.when(hit, F.lit("Y")).otherwise(F.lit("N"))
    return line.join(supplier, "l_suppkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("MDR_REPORT_KEY"),
        yes_no(F.col("l_linestatus") == "F").alias("ADVERSE_EVENT_FLAG"),
        yes_no(F.col("l_returnflag") == "A").alias("PRODUCT_PROBLEM_FLAG"),
        F.to_date("l_shipdate").alias("DATE_OF_EVENT"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("s_name")).alias("DISTRIBUTOR_NAME"),
        F.col("s_name").alias("MANUFACTURER_NAME"),
        F.when(F.col("l_linenumber") != 7, device_number(F.col("l_partkey"))).alias("PMA_PMN_NUM"),
    )


def recall(tables: _Tables) -> DataFrame:
    """Recalls, one an order line; orders grow with the lines, so neither side of their join is broadcast."""
    line = tables["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09))
    orders = tables["orders"].withColumnRenamed("o_orderkey", "l_orderkey")
    level = F.substring("o_orderpriority", 1, 1)
    cause = (
        F.when(level == "1", F.lit("Software design"))
        .when(level == "2", F.lit("Device Design"))
        .when(level == "3", F.lit("Process control"))
        .when(level == "5", F.lit("Labeling"))
    )
    return line.join(unbroadcast(orders), "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("cfres_id"),
        F.col("l_orderkey").cast("string").alias("res_event_number"),
        F.array(device_number(F.col("l_partkey"))).alias("k_numbers"),
        F.to_date("o_orderdate").alias("event_date_initiated"),
        F.col("o_orderstatus").alias("recall_status"),
        F.col("o_orderpriority").alias("reason_for_recall"),
        cause.alias("root_cause_description"),
    )


def feeds(spark: SparkSession, folder: str) -> Feeds:
    tables = _Tables(spark, folder)
    return Feeds(
        pma=pma(tables),
        premarket_510k=premarket_510k(tables),
        product_code=product_code(tables),
        maude=maude(tables),
        recall=recall(tables),
    )
