"""Delimited feeds: adverse events, approvals, clearances, product codes, processed CSV."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens.functions.cleaning import clean_date, clean_text, normal_key, truncate_columns
from recall_lens.schemas import KEYS, TABLES, dates, widths
from recall_lens.sources.encodings import Layout, decoded, layouts

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class DelimitedFeed:
    """How a feed's files are written."""

    table: str
    path: str
    sep: str = "|"
    #: One encoding for all files, or several, of which each file has the first that fits it.
    encoding: str | tuple[str, ...] = "UTF-8"
    quote: str = '"'


def adverse_events(path: str, table: str = "maude") -> DelimitedFeed:
    """Latin-1 text in which quotes are data."""
    return DelimitedFeed(table, path, encoding="ISO-8859-1", quote="")


def _reader(spark: SparkSession, feed: DelimitedFeed, encoding: str) -> DataFrameReader:
    reader = (
        spark.read.option("header", True)
        .option("sep", feed.sep)
        .option("encoding", encoding)
        .option("quote", feed.quote)
        .option("mode", "PERMISSIVE")
    )
    return reader.option("escape", '"') if feed.quote else reader


def files_by_header(spark: SparkSession, feed: DelimitedFeed) -> Iterator[tuple[tuple[str, ...], Layout]]:
    """The files of a feed by the columns their own header names and the encoding they are in.

    Where the encoding is to be found, one pass over all lines finds it together with the headers, and Spark then reads
    one header for each distinct first line. With one encoding for all, it reads each file's.
    """
    if not isinstance(feed.encoding, str):
        for layout in layouts(spark, feed.path, feed.encoding):
            yield tuple(_reader(spark, feed, layout.read_as).csv(layout.paths[0]).columns), layout
        return
    found: dict[tuple[str, ...], list[str]] = {}
    for row in spark.read.format("binaryFile").load(feed.path).select("path").orderBy("path").collect():
        found.setdefault(tuple(_reader(spark, feed, feed.encoding).csv(row.path).columns), []).append(row.path)
    for columns, paths in found.items():
        yield columns, Layout(feed.encoding, b"", tuple(paths))


def read_text(spark: SparkSession, feed: DelimitedFeed, quarantine: bool = False) -> DataFrame:
    """Every column as text, named by the header of its own file; one scan for each distinct header.

    Bytes that do not decode become the replacement character; the rest of the row is kept. A feed of one encoding that
    Spark does not read by itself, like cp1252, is given as a list of that one. A row with fewer fields than the header is filled with nulls. One with more fits no
    column; it is left out, or, with `quarantine`, kept with its raw text in `_corrupt_record`.
    """
    parts = []
    for columns, layout in files_by_header(spark, feed):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]).add(CORRUPT, T.StringType())
        found = not isinstance(feed.encoding, str)
        reader = _reader(spark, feed, layout.read_as if found else feed.encoding)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        part = reader.schema(schema).csv(list(layout.paths))
        fields = F.size(F.split(CORRUPT, re.escape(feed.sep)))
        part = part.withColumn(CORRUPT, F.when(fields > len(columns), F.col(CORRUPT)))
        parts.append(decoded(part, layout) if found else part)
    text = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if quarantine:
        return text
    return text.filter(~_has_surplus(text)).drop(CORRUPT)


def _has_surplus(text: DataFrame) -> Column:
    """Whether a row holds raw text. The 0 it is compared with comes by way of a second column, since Spark refuses a
    scan of the corrupt record alone."""
    zero = F.least(F.length(F.coalesce(F.col(f"`{text.columns[0]}`"), F.lit(""))), F.lit(0))
    return F.coalesce(F.length(CORRUPT), F.lit(-1)) >= zero


def surplus_rows(spark: SparkSession, feed: DelimitedFeed) -> DataFrame:
    """The raw text of rows with more fields than their header."""
    rows = read_text(spark, feed, quarantine=True)
    return rows.filter(_has_surplus(rows)).select(CORRUPT)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern has any file; works on every file system the session can read."""
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def clean_table(raw: DataFrame, table: str) -> DataFrame:
    """Trim and null text, parse dates, cut to width, normalise join keys; columns outside the table are dropped."""
    schema = TABLES[table]
    present = [f for f in schema if f.name in raw.columns]
    day_columns = set(dates(schema))
    cleaned = raw.select(
        *[
            (clean_date(clean_text(F.col(f.name))) if f.name in day_columns else clean_text(F.col(f.name))).alias(f.name)
            for f in present
        ]
    )
    cut = truncate_columns(cleaned, widths(schema))
    return cut.withColumns({c: normal_key(F.col(c)) for c in KEYS.get(table, ()) if c in cut.columns})


def read_table(spark: SparkSession, feed: DelimitedFeed) -> DataFrame:
    return clean_table(read_text(spark, feed), feed.table)


def read_feeds(spark: SparkSession, feeds: Iterable[DelimitedFeed]) -> Mapping[str, DataFrame]:
    """Cleaned tables by name; a feed whose file is absent is skipped, files of one table are put together."""
    tables: dict[str, list[DataFrame]] = {}
    for feed in feeds:
        if path_exists(spark, feed.path):
            tables.setdefault(feed.table, []).append(read_table(spark, feed))
    return {
        name: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) for name, parts in tables.items()
    }


def read_processed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A processed CSV whose types are inferred; costs one extra pass, so for files without a contract only."""
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)
