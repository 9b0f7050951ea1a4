"""The recall feed: JSON documents with a `results` array, or one recall per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens.functions.cleaning import clean_date, clean_json_value, normal_key, truncate_columns
from recall_lens.schemas import TABLES, dates, widths
from recall_lens.sources.json_ranges import members

NUMBERS = T.ArrayType(T.StringType())

# All members are read as text: nested ones come as their own JSON, whatever their shape.
RECORD = T.StructType([T.StructField(f.name, T.StringType()) for f in TABLES["recall"]])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Recalls of `{"results": [...]}` documents, however large; their ranges of bytes are read in parallel."""
    return members(spark, path).select(F.from_json("value", RECORD).alias("recall")).select("recall.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Recalls one per line; splits at any size."""
    return spark.read.schema(RECORD).json(path)


def numbers(text: Column) -> Column:
    """The members of a JSON array, or the one number that stands in its place."""
    return F.when(text.startswith("["), F.from_json(text, NUMBERS)).when(text.isNotNull(), F.array(text))


def clean_recalls(raw: DataFrame) -> DataFrame:
    """Typed recalls with `k_numbers` kept as an array of normalised numbers for the joins."""
    schema = TABLES["recall"]
    day_columns = set(dates(schema))
    columns = {}
    for f in schema:
        if f.name == "k_numbers":
            columns[f.name] = F.transform(numbers(F.col(f.name)), lambda n: F.nullif(normal_key(n), F.lit("")))
            continue
        value = clean_json_value(F.col(f.name), RECORD[f.name].dataType)
        columns[f.name] = clean_date(value) if f.name in day_columns else value
    typed = raw.withColumns(columns)
    bounded = {c: n for c, n in widths(schema).items() if c != "k_numbers"}
    return truncate_columns(typed, bounded).withColumn("product_code", normal_key(F.col("product_code")))


def flat_recalls(raw: DataFrame) -> DataFrame:
    """Recalls as a flat text table: nested values as JSON text, cut to the columns' widths."""
    schema = TABLES["recall"]
    day_columns = set(dates(schema))
    text = {f.name: clean_json_value(F.col(f.name), RECORD[f.name].dataType) for f in schema}
    flat = raw.withColumns({c: clean_date(v) if c in day_columns else v for c, v in text.items()})
    return truncate_columns(flat, widths(schema))
