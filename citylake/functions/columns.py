"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_list(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def rounded_int(value: ColumnOrName) -> Column:
    """Double to integer with half-even rounding (a plain cast truncates)."""
    return F.rint(as_col(value)).cast("int")


def in_list(value: ColumnOrName, wanted: Iterable) -> Column:
    """Optional list filter: an empty list keeps every row."""
    wanted = list(wanted)
    return as_col(value).isin(wanted) if wanted else F.lit(True)


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def row_hash(columns: Iterable[str]) -> Column:
    """Order-independent tie breaker over whole rows."""
    return F.xxhash64(*[F.col(c) for c in sorted(columns)])
