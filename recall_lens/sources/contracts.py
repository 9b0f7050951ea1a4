"""Schema checks before a load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recall_lens.schemas import widths


@dataclass(frozen=True)
class ContractReport:
    missing: tuple[str, ...]
    extra: tuple[str, ...]
    wrong_type: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not (self.missing or self.extra or self.wrong_type)


def schema_contract(df: DataFrame, expected: T.StructType) -> ContractReport:
    """Columns that are missing, not expected, or of another type."""
    have, want = ({f.name: f.dataType for f in s} for s in (df.schema, expected))
    return ContractReport(
        missing=tuple(c for c in want if c not in have),
        extra=tuple(c for c in have if c not in want),
        wrong_type=tuple(c for c in want if c in have and have[c] != want[c]),
    )


def bounded_text_columns(schema: T.StructType) -> list[str]:
    """Text columns whose width may cut a long value."""
    return [c for c, n in widths(schema).items() if n is not None and n < 4000]
