"""Text, date, number and JSON cleaning as built-in expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens that count as missing when a delimited feed is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Shapes of the dates met in the feeds and how each is read. A text is parsed only by the layout of its own shape:
# a failed parse costs far more than a failed match.
DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^\d{2}[A-Za-z]{3}\d{4}$", "ddMMMyyyy"),
)
TIME_OF_DAY = r"([ T]\d{1,2}:\d{2}.*|(?<=^\d{8})[ T]\d{4,6})$"
# Two-digit years from here on belong to the last century.
CENTURY_TURN = 2069

# Blanks stripped from both ends of a text value.
BLANKS = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def clean_text(c: Column, na_tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Trimmed text; missing-value tokens and blank text become null."""
    tokens = [t for t in na_tokens if t]
    return F.when(c.isin(tokens), F.lit(None)).otherwise(F.nullif(strip(c), F.lit("")))


def clean_date(c: Column, shapes: Iterable[tuple[str, str]] = DATE_SHAPES) -> Column:
    """The day a text names, a time of day being dropped; text that is no date becomes null."""
    text = F.regexp_replace(strip(c), TIME_OF_DAY, "")

    def day(layout: str) -> Column:
        found = F.to_date(F.try_to_timestamp(text, F.lit(layout)))
        if "yyyy" in layout:
            return found
        return F.when(F.year(found) >= CENTURY_TURN, F.add_months(found, -1200)).otherwise(found)

    return F.coalesce(*[F.when(text.rlike(shape), day(layout)) for shape, layout in shapes])


def to_number(c: Column) -> Column:
    """Text to double; text that is no number becomes null."""
    return c.try_cast("double")


def clean_json_value(c: Column, data_type: T.DataType) -> Column:
    """Nested values become JSON text; one blank or nothing becomes null; other values are trimmed text."""
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    text = c.cast("string")
    return F.when(text.isin("", " "), F.lit(None)).otherwise(strip(text))


def normal_key(c: Column) -> Column:
    """Join keys compare without regard to case or outer blanks, so they are normalised once."""
    return F.upper(F.trim(c))


def truncate_columns(df: DataFrame, widths: dict[str, int | None]) -> DataFrame:
    """Cut text to its column width; a width of None means unbounded."""
    return df.withColumns(
        {c: F.substring(F.col(c), 1, n) for c, n in widths.items() if n is not None and c in df.columns}
    )


def with_alias(df: DataFrame, name: str, aliases: Iterable[str], default: Column | None = None) -> DataFrame:
    """Make sure `name` exists: rename the first alias found, else fill with `default`."""
    if name in df.columns:
        return df
    for alias in aliases:
        if alias in df.columns:
            return df.withColumnRenamed(alias, name)
    return df.withColumn(name, F.lit(0) if default is None else default)
