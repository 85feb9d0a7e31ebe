"""Null handling and sentinel values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed sentinel values used by the warehouse.
RAW_NULL = "N/A"  # raw feed string columns
DIM_NULL = "empty"  # dimension attributes
OPEN_END = ""  # end of an open history interval


def string_columns(df: DataFrame, subset: Iterable[str] | None = None) -> list[str]:
    names = set(subset) if subset is not None else None
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names)
    ]


def fill_strings(df: DataFrame, value: str, subset: Iterable[str] | None = None) -> DataFrame:
    """``na.fill`` restricted to string columns (other types stay null)."""
    cols = string_columns(df, subset)
    return df.na.fill(value, subset=cols) if cols else df


def filled(c: Column | str, value: str) -> Column:
    """Column-level fill, for computing a key without a separate projection."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(value))


def not_equal(c: str, value) -> Column:
    """SQL ``<>``: a null value is dropped as well, like the reference filters."""
    return F.col(c) != F.lit(value)


def measure(c: str, dtype: str = "bigint") -> Column:
    """Typed measure from a string column; ``'N/A'`` and junk become null."""
    return F.col(c).try_cast(dtype)
