"""Reports over a star: counts and sums by calendar grain, shares, top-k.

All are aggregates with a partial (map-side) step; only one row per group and
map task crosses the shuffle, whatever the skew of the group keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calendar grains of the count / sum reports: name -> grouping columns. A week
# belongs to its ISO week year (``calendar.week_year``), not the calendar year.
DATE_GRAINS: dict[str, tuple[str, ...]] = {
    "year": ("year",),
    "quarter": ("year", "quarter"),
    "month": ("year", "month"),
    "week": ("week_year", "week"),
    "day": ("year", "month", "day"),
    "dayofweek": ("dayofweek",),
}


def grain_columns(grains: Mapping[str, Sequence[str]]) -> list[str]:
    cols: list[str] = []
    for g in grains.values():
        for c in g:
            if c not in cols:
                cols.append(c)
    return cols


def grain_label(grains: Mapping[str, Sequence[str]], cols: Sequence[str]) -> Column:
    """Name of the grouping set a row belongs to, from ``grouping_id``."""
    gid = F.grouping_id(*cols)
    label = None
    for name, g in grains.items():
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in g)
        label = F.when(gid == bits, F.lit(name)) if label is None else label.when(gid == bits, F.lit(name))
    return label


def by_grains(df: DataFrame, aggs: Sequence[Column], grains: Mapping[str, Sequence[str]] = DATE_GRAINS) -> DataFrame:
    """All grains in one pass: ``GROUPING SETS`` (one Expand, one aggregate)."""
    cols = grain_columns(grains)
    sets = [list(g) for g in grains.values()]
    out = df.groupingSets(sets, *cols).agg(*aggs, grain_label(grains, cols).alias("grain"))
    return out


def share(df: DataFrame, count_col: str, out: str = "share", digits: int | None = None) -> DataFrame:
    """Each group's part of the total, for any number of groups (null if the total is 0).

    ``df`` is already aggregated (one row per group). The total is a scalar
    subquery over the same groups (partial sums per task); both sides read the
    same exchange, so the grouped pipeline runs once. No window over all
    groups in one task, no join, nothing staged.
    """
    total = df.agg(F.sum(count_col).cast("double").alias("_total")).scalar()
    ratio = F.col(count_col) / F.nullif(total, F.lit(0.0))  # one IEEE division: exact same bits in any engine
    return df.withColumn(out, F.round(ratio, digits) if digits is not None else ratio)


def top_k(df: DataFrame, by: str, k: int = 1, desc_col: str = "n") -> DataFrame:
    """The ``k`` largest groups; ties broken by the group value ascending.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its
    own top k, the driver merges k rows per task.
    """
    return df.orderBy(F.col(desc_col).desc(), F.col(by).asc()).limit(k)
