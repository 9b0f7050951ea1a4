"""Row-set comparison that ignores order and the width of number types."""

from __future__ import annotations

import math
from collections import Counter


def plain(value, digits: int = 9):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, digits)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return round(float(value), digits)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v, digits) for v in value)
    return str(value)


def rows_of(records, columns, digits: int = 9) -> Counter:
    return Counter(tuple(plain(r[c], digits) for c in columns) for r in records)


def same_rows(spark_df, records, columns=None, digits: int = 9) -> None:
    columns = sorted(columns or spark_df.columns)
    left = rows_of([r.asDict() for r in spark_df.collect()], columns, digits)
    right = rows_of(records, columns, digits)
    assert left == right, (list((left - right).items())[:3], list((right - left).items())[:3])


def duck_records(connection, sql: str) -> list[dict]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]
