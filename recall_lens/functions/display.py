"""Display forms and device names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_NAME = "—"


def percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def short_number(x: Column) -> Column:
    """Billions and millions with a suffix, smaller numbers with thousands separators."""
    return (
        F.when(x > 1_000_000_000, F.format_string("%.2fB", x / 1e9))
        .when(x > 1_000_000, F.format_string("%.2fM", x / 1e6))
        .otherwise(F.format_number(x, 0))
    )


def not_blank(c: Column) -> Column:
    return F.nullif(F.rtrim(c), F.lit(""))


def first_name(*names: Column) -> Column:
    """First name that is not blank, null when all are."""
    return F.coalesce(*[not_blank(n) for n in names])
