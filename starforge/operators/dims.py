"""Dimension builders.

Every builder returns a lazy DataFrame. Distinct attribute combinations are a
hash aggregate with a map-side partial step, so only distinct values cross the
shuffle however skewed the input is; the key is hashed after the distinct, once
per dimension row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import DATE_DIM_PARTS, date_parts, hhmmss
from ..functions.clean import DIM_NULL, fill_strings
from ..functions.keys import surrogate_key


def dim_attributes(
    df: DataFrame,
    attrs: Sequence[str],
    fill: str | None = DIM_NULL,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Projection + fill + rename of the attributes that identify a row."""
    out = df.select(*attrs)
    if fill is not None:
        out = fill_strings(out, fill)
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    return out


def value_dim(
    df: DataFrame,
    attrs: Sequence[str],
    key: str,
    fill: str | None = DIM_NULL,
    rename: Mapping[str, str] | None = None,
    bits: int = 512,
    compat: bool = False,
    key_last: bool = False,
) -> DataFrame:
    """Distinct attribute combinations with a hashed key.

    Covers value, junk (many low-cardinality flags) and location dimensions;
    ``fill=None`` keeps nulls (location), ``rename`` maps source to dimension
    column names.
    """
    out = dim_attributes(df, attrs, fill, rename).distinct()
    names = out.columns
    keyed = out.withColumn(key, surrogate_key(names, bits, compat))
    return keyed.select(*names, key) if key_last else keyed.select(key, *names)


def date_dim(df: DataFrame, ts: Column | str, key: str = "date_id", bits: int = 512, compat: bool = False) -> DataFrame:
    """Calendar rows for the dates present in ``df`` (not a full calendar).

    The distinct runs on the date first (one value per day), then the parts
    are derived once per date.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    dates = df.select(F.to_date(t).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    parts = date_parts(F.col("_d"))
    out = dates.select(*[parts[p].alias(p) for p in DATE_DIM_PARTS])
    return out.select(surrogate_key(list(DATE_DIM_PARTS), bits, compat).alias(key), *DATE_DIM_PARTS)


def time_dim(spark: SparkSession, key: str = "time_id", bits: int = 512, compat: bool = False) -> DataFrame:
    """All 86,400 seconds of a day; key over the zero-padded ``HHmmss`` text.

    Generated on the executors from ``range`` (no driver-side product); the
    size is fixed, so it is safe to broadcast.
    """
    sec = spark.range(0, 24 * 60 * 60, numPartitions=4)
    out = sec.select(
        (F.col("id") / 3600).cast("int").alias("hour"),
        ((F.col("id") % 3600) / 60).cast("int").alias("minute"),
        (F.col("id") % 60).cast("int").alias("second"),
    )
    return out.select(time_key(F.col("hour"), F.col("minute"), F.col("second"), bits, compat).alias(key), "hour", "minute", "second")


def time_key(hour: Column, minute: Column, second: Column, bits: int = 512, compat: bool = False) -> Column:
    return surrogate_key([hhmmss(hour, minute, second)], bits, compat)


def date_key(ts: Column | str, bits: int = 512, compat: bool = False) -> Column:
    """The ``date_dim`` key of a timestamp, computed in place (no lookup)."""
    parts = date_parts(ts)
    return surrogate_key([parts[p] for p in DATE_DIM_PARTS], bits, compat)


def entity_dim(
    df: DataFrame,
    cols: Sequence[str],
    key: str,
    latest_by: str | Column | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """One row per entity key; the latest version wins.

    ``max_by`` is an aggregate with a partial step, so a key that repeats a
    billion times is collapsed map-side before the shuffle. Without
    ``latest_by`` any one version is kept (deterministic: max of the row).
    ``dedupe=False`` is the plain projection.
    """
    others = [c for c in cols if c != key]
    out = df.select(*cols) if latest_by is None else df.select(*cols, (F.col(latest_by) if isinstance(latest_by, str) else latest_by).alias("_ord"))
    if not dedupe:
        return out.select(*cols)
    row = F.struct(*others)
    if latest_by is None:
        agg = F.max(row)
    else:
        # ties on the order column are broken by the row itself: the same
        # input always keeps the same version (replays are idempotent)
        agg = F.max_by(row, F.struct(F.col("_ord"), row))
    return out.groupBy(key).agg(agg.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])
