"""Calendar functions: date parts, rolling date windows, time of day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the parts added by with_date_parts, in the order they are added.
DATE_PART_NAMES = ("hour", "minute", "second", "day", "dayofweek", "month", "week", "year", "quarter")
# Parts that describe a calendar date (the date dimension's attributes).
DATE_DIM_PARTS = ("day", "dayofweek", "month", "week", "year", "quarter")
TIME_DIM_PARTS = ("hour", "minute", "second")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Timestamp from a dirty string or a typed column; null when unparsable.

    Feeds store ``'N/A'`` and odd formats in date columns; with ANSI mode on a
    plain cast would fail the job, ``try_to_timestamp`` yields null instead.
    """
    return F.try_to_timestamp(_col(c).cast("string"))


def event_time(df: DataFrame, ts: str) -> Column:
    """The column as a time: typed ones as they are, anything else parsed."""
    typed = isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType))
    return F.col(ts) if typed else parse_timestamp(ts)


def date_parts(ts: Column | str) -> dict[str, Column]:
    """The nine parts of a timestamp (Sunday = 1 for dayofweek, ISO week)."""
    t = _col(ts)
    return {
        "hour": F.hour(t),
        "minute": F.minute(t),
        "second": F.second(t),
        "day": F.dayofmonth(t),
        "dayofweek": F.dayofweek(t),
        "month": F.month(t),
        "week": F.weekofyear(t),
        "year": F.year(t),
        "quarter": F.quarter(t),
    }


def with_date_parts(df: DataFrame, ts: Column | str, parts=DATE_PART_NAMES) -> DataFrame:
    all_parts = date_parts(ts)
    return df.withColumns({p: all_parts[p] for p in parts})


def week_year(year: Column | str = "year", month: Column | str = "month", week: Column | str = "week") -> Column:
    """ISO year of an ISO week, from a date's parts (those a date dimension holds).

    The first days of January can lie in the old year's last week, the last
    days of December in the new year's week 1.
    """
    y, m, w = _col(year), _col(month), _col(week)
    return F.when((m == 1) & (w >= 52), y - 1).when((m == 12) & (w == 1), y + 1).otherwise(y)


def _as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def date_window(ts: Column | str, as_of: dt.date | str, days_back: int, dirty: bool = False) -> Column:
    """``as_of - days_back <= to_date(ts) <= as_of``, both ends included.

    On a typed timestamp column Catalyst turns this into ``ts >= lo AND
    ts < hi + 1 day``, which reaches the parquet scan. ``dirty=True`` parses
    a landed string first (unparsable dates fall outside every window).
    """
    hi = _as_date(as_of)
    lo = hi - dt.timedelta(days=days_back)
    t = parse_timestamp(ts) if dirty else _col(ts)
    return F.to_date(t).between(F.lit(lo), F.lit(hi))


def window_extract(
    df: DataFrame, ts: str, as_of, days_back: int, drop=(), with_parts: bool = False, day_parts: Sequence[str] = ()
) -> DataFrame:
    """Rows of the rolling window, optional date parts, dropped columns.

    A string date column (as landed) is parsed; a typed one is used as is so
    the bound is pushed to the scan. ``day_parts`` names the columns that hold
    the date's year, month and day where ``df`` is partitioned by them: the
    window is then a partition filter too, and only its days are read.
    """
    dirty = isinstance(df.schema[ts].dataType, T.StringType)
    out = df.filter(date_window(ts, as_of, days_back, dirty=dirty))
    if day_parts:
        out = out.filter(date_window(F.make_date(*[F.col(p) for p in day_parts]), as_of, days_back))
    if with_parts:
        out = with_date_parts(out, parse_timestamp(ts) if dirty else ts)
    if drop:
        out = out.drop(*drop)
    return out


def hhmmss(hour: Column | str, minute: Column | str, second: Column | str) -> Column:
    """Zero-padded ``HHmmss`` text of a time of day."""
    return F.format_string("%02d%02d%02d", _col(hour), _col(minute), _col(second))
