"""Device names: best non-blank name per device, and lookups that attach them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recall_lens.functions.display import NO_NAME, first_name, not_blank
from recall_lens.operators.skew import salted_join, unbroadcast
from recall_lens.sources.testdata import Feeds

UNKNOWN_DEVICE = "Unknown Device"
KEY = "PMA_PMN_NUM"
#: Row groups of published names, and the most devices whose numbers become part of a scan's filter.
NAME_GROUP_BYTES = 1 << 20
MOST_ASKED = 200


def names_from_view(view: DataFrame) -> DataFrame:
    """Greatest name over the view rows of a device, null where every name is blank."""
    name = first_name(F.col("k_devicename"), F.col("pc_devicename"), F.col("GENERICNAME"), F.col("TRADENAME"))
    return view.filter(F.col("PMA_PMN_NUM").isNotNull()).groupBy("PMA_PMN_NUM").agg(F.max(name).alias("device_name"))


def device_names(feeds: Feeds, fallback: str | None = NO_NAME, only: DataFrame | None = None) -> DataFrame:
    """The same names taken from code-level maxima, so that no approval x clearance pair is built.

    A pair shows its clearance's name, else the product code's, else the approval's. The greatest over all pairs is
    therefore the greatest clearance name of the code, and the later choices only where an earlier one can be blank.
    With `only`, a table of device numbers, just their codes are aggregated and just they get a name.
    """
    approvals = feeds.pma.select(
        F.col("PMANUMBER").alias("number"),
        F.col("PRODUCTCODE").alias("code"),
        first_name(F.col("GENERICNAME"), F.col("TRADENAME")).alias("own"),
    )
    clearances = feeds.premarket_510k.select(
        F.col("KNUMBER").alias("number"), F.col("PRODUCTCODE").alias("code"), not_blank(F.col("DEVICENAME")).alias("own")
    )
    products = feeds.product_code.withColumnRenamed("PRODUCTCODE", "code")
    if only is not None:
        asked = only.select(F.col("PMA_PMN_NUM").alias("number")).distinct()
        codes = approvals.select("number", "code").union(clearances.select("number", "code")).join(asked, "number", "left_semi")
        codes = codes.select("code").distinct()
        approvals, clearances, products = (df.join(codes, "code", "left_semi") for df in (approvals, clearances, products))
    unnumbered = F.col("number").isNull()
    by_code = (
        clearances.withColumn("role", F.lit("K"))
        .unionByName(approvals.withColumn("role", F.lit("P")))
        .filter(F.col("code").isNotNull())
        .groupBy("code")
        .agg(
            F.max(F.when(F.col("role") == "K", F.col("own"))).alias("k_name"),
            F.count(F.when(F.col("role") == "K", 1)).alias("k"),
            F.count(F.when((F.col("role") == "K") & F.col("own").isNull(), 1)).alias("k_blank"),
            F.count(F.when(F.col("role") == "P", 1)).alias("p"),
            F.count(F.when((F.col("role") == "P") & unnumbered, 1)).alias("p_unnumbered"),
            F.max(F.when((F.col("role") == "P") & unnumbered, F.col("own"))).alias("p_unnumbered_name"),
        )
    )
    classes = (
        products.filter(F.col("code").isNotNull())
        .groupBy("code")
        .agg(
            F.max(not_blank(F.col("DEVICENAME"))).alias("pc_name"),
            F.max(not_blank(F.col("DEVICENAME")).isNull()).alias("pc_blank"),
        )
    )
    codes = by_code.join(unbroadcast(classes), "code", "left")
    pc_open = F.coalesce("pc_blank", F.lit(True))
    k_open = (F.coalesce("k", F.lit(0)) == 0) | (F.col("k_blank") > 0)

    def widest(*names: Column) -> Column:
        return F.greatest(*names, F.lit(None).cast("string"))

    p_names = salted_join(approvals.filter(~unnumbered), codes, ["code"], ["number"], "left").select(
        "number",
        widest(
            F.col("k_name"), F.when(k_open, F.col("pc_name")), F.when(k_open & pc_open, F.col("own"))
        ).alias("name"),
    )
    shown = (F.coalesce("p", F.lit(0)) == 0) | (F.col("p_unnumbered") > 0)
    k_names = (
        salted_join(clearances.filter(~unnumbered), codes, ["code"], ["number"], "left")
        .filter(shown)
        .select(
            "number",
            F.coalesce("own", widest(F.col("pc_name"), F.when(pc_open, F.col("p_unnumbered_name")))).alias("name"),
        )
    )
    best = (
        p_names.unionByName(k_names)
        .groupBy(F.col("number").alias("PMA_PMN_NUM"))
        .agg(F.max("name").alias("device_name"))
    )
    if only is not None:
        best = asked.withColumnRenamed("number", "PMA_PMN_NUM").join(unbroadcast(best), "PMA_PMN_NUM", "left")
    if fallback is None:
        return best
    return best.withColumn("device_name", F.coalesce("device_name", F.lit(fallback)))


def publish_names(names: DataFrame, path: str) -> None:
    """Write names so that a few devices are found without reading the rest: sorted by device number into small row groups,
    each with a Bloom filter of its numbers."""
    column = f"#{KEY}"
    writer = names.repartitionByRange(KEY).sortWithinPartitions(KEY).write.option("parquet.block.size", NAME_GROUP_BYTES)
    writer = writer.option(f"parquet.bloom.filter.enabled{column}", True).option(f"parquet.bloom.filter.fpp{column}", "0.001")
    writer.option("parquet.bloom.filter.adaptive.enabled", True).mode("error").parquet(path)


def lookup_names(published: DataFrame, asked: DataFrame) -> DataFrame:
    """The names of the devices asked for, null where none is published; up to MOST_ASKED of them reach the scan as
    equalities, which its row groups' ranges and Bloom filters are tested with."""
    numbers = asked.select(KEY).distinct()
    few = [r[0] for r in numbers.limit(MOST_ASKED + 1).collect()]
    if len(few) <= MOST_ASKED:
        wanted = [F.col(KEY) == n for n in few if n is not None]
        published = published.filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))
    return numbers.join(unbroadcast(published), KEY, "left")


def with_device_names(scored: DataFrame, names: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Attach names; devices without one show the fallback."""
    missing = F.lit(NO_NAME) if fallback is None else fallback
    return scored.join(unbroadcast(names), "PMA_PMN_NUM", "left").withColumn("device_name", F.coalesce("device_name", missing))


def name_coverage(named: DataFrame) -> DataFrame:
    """Rows in all and rows that show a name."""
    named_row = F.trim(F.coalesce("device_name", F.lit(NO_NAME))) != NO_NAME
    return named.agg(
        F.count("*").alias("total_rows"), F.coalesce(F.sum(F.when(named_row, 1).otherwise(0)), F.lit(0)).alias("named_rows")
    )
