"""Ordered operations per entity that stay balanced under skew.

``lead`` over ``Window.partitionBy(entity)`` sends every row of an entity to one
task. When one location holds a third of all rows, that task sorts a third of
the data. The operators here split each entity's sequence into contiguous
chunks instead:

1. ``repartitionByRange(n, *by, *order)`` samples the keys and cuts the global
   order into ``n`` ranges of similar size, so a hot entity spans many ranges;
   the range id (``spark_partition_id``) is the chunk number and chunks are
   numbered in sort order. The chunked rows are staged once in the
   checkpoint folder: the sampled bounds are not reproducible between two
   executions of the exchange, and every branch below must see the same
   chunk ids (staging also cuts the lineage).
2. The window runs per ``(entity, chunk)``, dealt to as many tasks as the row
   count needs: every task is bounded by that and by the range size.
3. Only the chunk boundaries need repair. A one-row-per-(entity, chunk)
   aggregate (at most ``entities + n`` rows) is scanned per entity to find
   the value that crosses each boundary, then joined back on
   ``(entity, chunk)``.

All are plain DataFrame plans: two shuffles of the rows (range, then the
window's hash exchange), one staged write, small aggregates, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions, stage, task_count

CHUNK = "_chunk"


def _chunked(df: DataFrame, by: Sequence[str], order: Sequence[str], chunks: int | None, dedupe: bool = False) -> DataFrame:
    n = chunks or shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *by, *order)
    if dedupe:
        # identical rows share (by, order), hence their range: the range
        # partitioning already clusters them and the distinct adds no exchange
        ranged = ranged.distinct()
    return stage(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _dealt(ranged: DataFrame, by: Sequence[str]) -> DataFrame:
    """The window's exchange: as many tasks as the rows need (a task of the advisory size may be far larger in memory)."""
    return ranged.repartition(task_count(ranged), *by, CHUNK)


def next_value(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    chunks: int | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """``lead(value) over (partition by by order by order)``, skew-safe.

    ``order`` must make rows unique within ``by`` (add a tie-breaker column),
    otherwise the next row is not defined. ``dedupe`` drops identical rows
    first, within the range partitioning (no extra shuffle).
    """
    ranged = _chunked(df, by, order, chunks, dedupe)
    w = Window.partitionBy(*by, CHUNK).orderBy(*order)
    local = _dealt(ranged, by).withColumns({
        out: F.lead(value).over(w),
        "_last": F.lead(F.lit(1)).over(w).isNull(),
    })
    # First value of every (entity, chunk), then the first value of the next
    # chunk of the same entity: a scan over one row per chunk.
    # When the value is the leading order column (lead of a timestamp) its
    # minimum is the first row's value: a hash aggregate instead of the
    # sort-based one that min_by over a struct ordering needs.
    first = F.min(value) if value == order[0] else F.min_by(F.col(value), F.struct(*order))
    firsts = ranged.groupBy(*by, CHUNK).agg(first.alias("_first"))
    nxt = firsts.select(
        *by, CHUNK, F.lead("_first").over(Window.partitionBy(*by).orderBy(CHUNK)).alias("_carry")
    )
    joined = local.join(nxt, [*by, CHUNK], "left")
    return joined.withColumn(out, F.when(F.col("_last"), F.col("_carry")).otherwise(F.col(out))).drop(
        "_last", "_carry", CHUNK
    )


def previous_value(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    chunks: int | None = None,
) -> DataFrame:
    """``lag(value) over (partition by by order by order)``, skew-safe.

    Mirror of ``next_value``: the first row of each chunk takes the last
    value of the entity's previous chunk.
    """
    ranged = _chunked(df, by, order, chunks)
    w = Window.partitionBy(*by, CHUNK).orderBy(*order)
    local = _dealt(ranged, by).withColumns({
        out: F.lag(value).over(w),
        "_first_row": F.lag(F.lit(1)).over(w).isNull(),
    })
    last = F.max(value) if value == order[0] else F.max_by(F.col(value), F.struct(*order))
    lasts = ranged.groupBy(*by, CHUNK).agg(last.alias("_lastv"))
    prev = lasts.select(*by, CHUNK, F.lag("_lastv").over(Window.partitionBy(*by).orderBy(CHUNK)).alias("_carry"))
    joined = local.join(prev, [*by, CHUNK], "left")
    return joined.withColumn(out, F.when(F.col("_first_row"), F.col("_carry")).otherwise(F.col(out))).drop(
        "_first_row", "_carry", CHUNK
    )


def carry_forward(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    chunks: int | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before each row, per ``by``, skew-safe.

    This is the as-of step: union the probe rows (value null) with the anchor
    rows (value set), order them, and every probe picks up the latest anchor.
    """
    v = F.col(value) if isinstance(value, str) else value
    ranged = _chunked(df.withColumn("_v", v), by, order, chunks)
    running = Window.partitionBy(*by, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = _dealt(ranged, by).withColumn(out, F.last("_v", ignorenulls=True).over(running))
    # Last anchor of every chunk, then for each chunk the last anchor of any
    # earlier chunk of the same entity.
    lasts = (
        ranged.where(F.col("_v").isNotNull())
        .groupBy(*by, CHUNK)
        .agg(F.max_by(F.col("_v"), F.struct(*order)).alias("_lastv"))
    )
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # Every chunk of the entity (also those without an anchor) gets the last
    # anchor of the chunks before it. Each (entity, chunk) lives in one range
    # partition, so the distinct collapses map-side.
    chunk_list = ranged.select(*by, CHUNK).distinct()
    all_carry = chunk_list.join(lasts, [*by, CHUNK], "left").select(
        *by, CHUNK, F.last("_lastv", ignorenulls=True).over(before).alias("_carry")
    )
    joined = local.join(all_carry, [*by, CHUNK], "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_v", "_carry", CHUNK)
