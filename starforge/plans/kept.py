"""Reports kept beside published tables: partial aggregates per partition.

A kept report stores its grouped rows for each partition (a month) of the tables
it is made from. A refresh asks which partitions have other files than those the
stored rows were made from, aggregates only these again, and replaces their rows;
the report itself is then one small aggregate over the stored rows. A correction
of last year's records costs the months it rewrote, a weekly batch its own month.

Which files a partition holds is read from its folder listing (every write gives
its files new names), before the rows are read, and noted after the partials are
written: a refresh that is cut off, or overtaken by a publish, is made up by the
next one. Tables without partitions (dimensions whose rows change) count as a
whole: where one of them has other files, every partition is stale.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staging
from ..sources.feeds import partition_filter
from ..sources.store import NULL_PARTITION, TableStore

VERSION = "files"


@dataclass(frozen=True)
class KeptReport:
    """``rows`` turns the (pruned) tables into the rows to group.

    ``aggs`` are the stored aggregates: name -> (function to store, function that
    combines stored values), both column functions; only aggregates whose parts
    add up belong here (count, sum of integers or decimals, min, max). A count of
    different things adds up only if none of them is in two partitions: group so
    that it is (a record lies in one month).
    """

    name: str
    tables: tuple[str, ...]  # partitioned alike by ``part``
    part: str
    by: tuple[str, ...]
    aggs: Mapping[str, tuple[Callable[[], Column], Callable[[str], Column]]]
    rows: Callable[[Mapping[str, DataFrame]], DataFrame]
    whole: tuple[str, ...] = ()  # read as a whole; a change makes every partition stale

    @property
    def table(self) -> str:
        return f"{self.name}__partials"

    @property
    def noted(self) -> str:
        return f"{self.name}__files"


def count_rows() -> tuple[Callable[[], Column], Callable[[str], Column]]:
    return (lambda: F.count(F.lit(1))), F.sum


def sum_of(value: Column | str) -> tuple[Callable[[], Column], Callable[[str], Column]]:
    """Sum of an integer or decimal column (sums of doubles depend on the order of adding)."""
    return (lambda: F.sum(value)), F.sum


def _versions(store: TableStore, report: KeptReport) -> dict[str, str]:
    """Partition value -> what its rows are made from (one entry per partition)."""
    whole = [store.files_version(t) for t in report.whole]
    per_table = [store.partition_versions(t, report.part) for t in report.tables]
    values = {v for versions in per_table for v in versions}
    return {v: "/".join([*(versions.get(v, "-") for versions in per_table), *whole]) for v in values}


def _noted(store: TableStore, report: KeptReport) -> dict[str, str]:
    if not (store.exists(report.noted) and store.exists(report.table)):
        return {}
    return {r[0]: r[1] for r in store.read(report.noted).select(report.part, VERSION).collect()}


def refresh(store: TableStore, report: KeptReport) -> list[str]:
    """Bring the stored rows up to date; returns the partitions that were computed or removed."""
    now, before = _versions(store, report), _noted(store, report)
    stale = sorted(v for v, files in now.items() if before.get(v) != files)
    gone = sorted(set(before) - set(now))
    if store.exists(report.table) and not stale and not gone:
        return []
    first = store.read(report.tables[0])
    kind = first.schema[report.part].dataType
    values = [(_typed(v, kind),) for v in [*stale, *gone]]
    pruned = {t: store.read(t).where(partition_filter((report.part,), values)) for t in report.tables}
    grouped = report.rows({**pruned, **{t: store.read(t) for t in report.whole}}).groupBy(report.part, *report.by)
    partials = grouped.agg(*[make().alias(n) for n, (make, _) in report.aggs.items()])
    if store.exists(report.table):
        touched = store.spark.createDataFrame(values, T.StructType([T.StructField(report.part, kind)]))
        with staging(store.spark):
            store.overwrite_partitions(report.table, partials, (report.part,), touched=touched)
    else:
        store.create(report.table, partials, (report.part,))
    noted = T.StructType([T.StructField(report.part, T.StringType()), T.StructField(VERSION, T.StringType())])
    store.replace(report.noted, store.spark.createDataFrame(sorted(now.items()), noted).coalesce(1))
    store.vacuum(report.noted)
    return [*stale, *gone]


def _typed(value: str, kind: T.DataType):
    if value == NULL_PARTITION:
        return None
    return int(value) if isinstance(kind, T.IntegralType) else value


def read_kept(store: TableStore, report: KeptReport, by: Sequence[str] | None = None) -> DataFrame:
    """The report's groups over all partitions, or coarser ones (``by`` some of its columns)."""
    by = list(report.by if by is None else by)
    stored = store.read(report.table)
    return stored.groupBy(*by).agg(*[combine(n).alias(n) for n, (_, combine) in report.aggs.items()])
