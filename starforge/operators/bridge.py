"""Bridge tables for many-to-many dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge(
    df: DataFrame,
    group_col: str,
    member_col: str,
    group_key: str,
    member_key: str | None = None,
    distinct: bool = True,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(group key, member id) pairs; the group key is the fact's natural key.

    ``distinct`` removes repeated pairs (partial aggregate before the shuffle);
    ``distinct=False`` is the plain projection. ``carry`` keeps columns that
    are constant per group (a partition key).
    """
    out = df.select(F.col(group_col).alias(group_key), F.col(member_col).alias(member_key or member_col), *carry)
    return out.distinct() if distinct else out
