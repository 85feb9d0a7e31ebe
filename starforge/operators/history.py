"""History mini-dimensions: validity intervals of a changing condition.

A history row says: from ``start_date`` (inclusive) until ``end_date``
(exclusive) the entity (a location) had this condition. Rows come from the
observations themselves: the start is the observation's date, the end is the
date of the entity's next observation, and the last row is open (``''``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import OPEN_END
from ..session import stage
from .merge import check_unique_keys
from .sequence import carry_forward, next_value, previous_value


def build_history(
    df: DataFrame,
    entity: str,
    cond: str,
    ts: str,
    tiebreak: Sequence[str] = (),
    start: str = "start_date",
    end: str = "end_date",
    chunks: int | None = None,
) -> DataFrame:
    """One interval per observation, ``end`` = date of the next observation.

    ``tiebreak`` orders observations of one entity at the same instant (a
    record id); without it equal timestamps have no defined successor.
    Repeated identical observations are removed first, inside the range
    partitioning of the sequence step (no shuffle of its own).
    """
    obs = df.select(entity, cond, ts, *tiebreak)
    seq = next_value(obs, [entity], [ts, *tiebreak], value=ts, out="_next_ts", chunks=chunks, dedupe=True)
    return seq.select(
        entity,
        cond,
        F.to_date(ts).cast("string").alias(start),
        F.coalesce(F.to_date("_next_ts").cast("string"), F.lit(OPEN_END)).alias(end),
    )


def build_compact_history(
    df: DataFrame,
    entity: str,
    cond: str,
    ts: str,
    tiebreak: Sequence[str] = (),
    start: str = "start_date",
    end: str = "end_date",
    chunks: int | None = None,
) -> DataFrame:
    """Day-level history with equal neighbours merged (the ``coalesce`` form).

    The condition of a day is that of the day's last observation; a row
    starts where it differs from the previous day's, and ends where the next
    such change starts. No zero-width rows, no two adjacent rows with the
    same condition; a point-in-time lookup gives the same answer as on
    ``build_history``. All steps are skew-safe: a per-(entity, day)
    aggregate, then ``previous_value`` and ``next_value``.
    """
    day = F.to_date(ts).cast("string")
    daily = df.groupBy(entity, day.alias(start)).agg(F.max_by(F.col(cond), F.struct(ts, *tiebreak)).alias(cond))
    prev = previous_value(daily, [entity], [start], value=cond, out="_prev", chunks=chunks)
    changes = prev.where(F.col("_prev").isNull() | (F.col("_prev") != F.col(cond))).drop("_prev")
    seq = next_value(changes, [entity], [start], value=start, out="_next", chunks=chunks)
    return seq.select(entity, cond, start, F.coalesce(F.col("_next"), F.lit(OPEN_END)).alias(end))


def merge_history(
    old: DataFrame,
    new: DataFrame,
    entity: str,
    cond: str,
    start: str = "start_date",
    end: str = "end_date",
    close: str = "open_only",
) -> DataFrame:
    """Merge a newer batch of intervals into the published history.

    1. New rows whose start is after the entity's latest known start are kept
       (later-or-unknown rule, the reference's); the rest are late and
       dropped (``splice_history`` puts them where they belong).
    2. The entity's open row is closed at the first kept new start.
    3. The kept new rows are appended.

    Only open rows (one per entity) take part in a join; closed rows pass
    through without a shuffle. ``close='reference'`` reproduces the
    reference's match on (entity, condition, start), which also rewrites
    closed rows of the same day; ``'open_only'`` closes only the open row.
    """
    kept = newer_rows(old, new, entity, start).select(*old.columns)
    first_new = kept.groupBy(entity).agg(F.min(start).alias("_min_start"))

    if close == "open_only":
        is_open = F.col(end) == F.lit(OPEN_END)
        closed_rows = old.where(~is_open | F.col(end).isNull())
        open_rows = old.where(is_open).join(first_new, entity, "left")
        open_rows = open_rows.withColumn(end, F.coalesce(F.col("_min_start"), F.col(end))).select(*old.columns)
        return closed_rows.unionByName(open_rows).unionByName(kept)
    if close == "reference":
        closing = (
            old.where(F.col(end) == F.lit(OPEN_END))
            .join(first_new, entity, "inner")
            .select(entity, cond, start, F.col("_min_start").alias("_set_end"))
            .distinct()
        )
        rewritten = old.join(closing, [entity, cond, start], "left")
        rewritten = rewritten.withColumn(end, F.coalesce(F.col("_set_end"), F.col(end))).select(*old.columns)
        return rewritten.unionByName(kept)
    raise ValueError(f"unknown close rule {close!r}")


def newer_rows(known: DataFrame, new: DataFrame, entity: str, start: str = "start_date") -> DataFrame:
    """New rows that start after the entity's latest known start, or whose entity is unknown."""
    latest = known.groupBy(entity).agg(F.max(start).alias("_max_start"))
    later = (F.col(start) > F.col("_max_start")) | F.col("_max_start").isNull()
    return new.join(latest, entity, "left").where(later).drop("_max_start")


def merge_open_rows(
    open_rows: DataFrame,
    new: DataFrame,
    entity: str,
    cond: str,
    start: str = "start_date",
    end: str = "end_date",
) -> tuple[DataFrame, DataFrame]:
    """Incremental form of ``merge_history`` that reads only the open rows.

    In a history built by ``build_history`` each entity's open row is its
    latest interval, so its start is the entity's latest known start: the
    later-start rule needs no scan of the closed rows. Returns
    ``(rows that are closed now, open rows after the merge)``; all other
    rows of the published table are unchanged, so a publish appends the
    first and replaces only the open rows. Same result as
    ``merge_history(..., close='open_only')``.
    """
    cols = open_rows.columns
    kept = newer_rows(open_rows, new, entity, start).select(*cols)
    first_new = kept.groupBy(entity).agg(F.min(start).alias("_min_start"))
    is_open = F.col(end) == F.lit(OPEN_END)
    closing = open_rows.join(first_new, entity, "inner").withColumn(end, F.col("_min_start")).select(*cols)
    still_open = open_rows.join(first_new, entity, "left_anti")
    closed_now = closing.unionByName(kept.where(~is_open))
    open_after = still_open.unionByName(kept.where(is_open))
    return closed_now, open_after


def point_in_time(
    facts: DataFrame,
    fact_entity: str,
    fact_ts: str,
    fact_id: str,
    history: DataFrame,
    entity: str,
    cond: str,
    start: str = "start_date",
    end: str = "end_date",
    chunks: int | None = None,
) -> DataFrame:
    """The history row valid on each fact's date (left as-of join).

    Valid = same entity, ``start <= date < end`` or open. Zero-width rows
    (start = end) can never be valid and are skipped. Implemented as a union of
    probes and interval starts ordered by date, with the latest start carried
    forward (``carry_forward``), so there is no pairing of rows within an
    entity and a hot entity is split into range chunks.
    Returns the fact columns plus ``cond``, ``start``, ``end`` (null when no
    interval covers the date).
    """
    fact_cols = facts.columns
    probes = facts.select(
        F.col(fact_entity).alias("_e"),
        F.to_date(fact_ts).cast("string").alias("_d"),
        F.lit(1).alias("_kind"),
        F.col(fact_id).cast("string").alias("_tb"),
        F.struct(*fact_cols).alias("_probe"),
        F.lit(None).cast(history.select(F.struct(cond, start, end).alias("x")).schema["x"].dataType).alias("_anchor"),
    )
    is_open = F.col(end) == F.lit(OPEN_END)
    anchors = history.where(is_open | (F.col(start) < F.col(end))).select(
        F.col(entity).alias("_e"),
        F.col(start).alias("_d"),
        F.lit(0).alias("_kind"),
        F.col(end).alias("_tb"),
        F.lit(None).cast(probes.schema["_probe"].dataType).alias("_probe"),
        F.struct(cond, start, end).alias("_anchor"),
    )
    both = probes.unionByName(anchors)
    filled = carry_forward(both, ["_e"], ["_d", "_kind", "_tb"], value="_anchor", out="_match", chunks=chunks)
    hit = filled.where(F.col("_kind") == 1)
    valid = (F.col("_match").isNotNull()) & ((F.col(f"_match.{end}") == F.lit(OPEN_END)) | (F.col("_d") < F.col(f"_match.{end}")))
    return hit.select(
        *[F.col(f"_probe.{c}").alias(c) for c in fact_cols],
        F.when(valid, F.col(f"_match.{cond}")).alias(cond),
        F.when(valid, F.col(f"_match.{start}")).alias(start),
        F.when(valid, F.col(f"_match.{end}")).alias(end),
    )


def observed_history(obs: DataFrame, entity: str, cond: str, ts: str, record: str, start: str = "start_date", end: str = "end_date", chunks: int | None = None) -> DataFrame:
    """``build_history`` that keeps each row's observation: (entity, cond, start, end, ts, record).

    ``record`` is the observation's id; it also orders observations of one
    instant. With these columns a published history is its own log, and
    ``splice_history`` can change it at any place.
    """
    seq = next_value(obs.select(entity, cond, ts, record), [entity], [ts, record], value=ts, out="_next_ts", chunks=chunks, dedupe=True)
    ends = F.coalesce(F.to_date("_next_ts").cast("string"), F.lit(OPEN_END))
    return seq.select(entity, cond, F.to_date(ts).cast("string").alias(start), ends.alias(end), ts, record)


@dataclass
class Splice:
    """What a batch changes in a history: rows that go (as they are published) and rows that come.

    A row whose end moves is in both. All other rows stay as they are.
    """

    removed: DataFrame
    added: DataFrame


def splice_history(
    log: DataFrame,
    batch: DataFrame,
    entity: str,
    cond: str,
    ts: str,
    record: str,
    withdrawn: DataFrame | None = None,
    start: str = "start_date",
    end: str = "end_date",
    chunks: int | None = None,
) -> Splice:
    """Put a batch of observations into a history, at whatever times they are.

    ``log`` has the columns of ``observed_history`` (others are kept in
    ``removed``). An observation of the batch replaces the one with its record id
    (its time, entity or condition may have moved); ``withdrawn`` holds record ids
    that are no longer observations (those in the batch as well stay). The
    history afterwards is the one ``observed_history`` gives for all observations.

    Only what can change is put in order again: an entity's rows whose
    interval meets the days between its first and last changed position. The row
    before these days meets them (it ends at its next observation's day), and the
    day on which the row after them starts is a minimum per entity. So a batch
    sorts its own neighbourhood, not the entity's whole history.
    """
    obs = [entity, cond, ts, record]
    src = stage(batch.select(*obs).distinct(), "splice-batch")
    check_unique_keys(src, [record])
    ids = src.select(record)
    gone_ids = ids if withdrawn is None else ids.unionByName(withdrawn.select(F.col(withdrawn.columns[0]).alias(record))).distinct()
    held = stage(log.join(gone_ids, record, "left_semi").select(*log.columns), "splice-held")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in obs]
    changed = src.alias("a").join(held.alias("b"), same, "left_anti")
    gone = held.alias("a").join(src.alias("b"), same, "left_anti")
    day = F.to_date(ts).cast("string")
    places = changed.select(entity, day.alias("_day")).unionByName(gone.select(entity, F.col(start).alias("_day")))
    days = stage(places.groupBy(entity).agg(F.min("_day").alias("_first"), F.max("_day").alias("_last")), "splice-days")
    near = log.join(days, entity).where(((F.col(end) == F.lit(OPEN_END)) | (F.col(end) >= F.col("_first"))) & (F.col(start) <= F.col("_last")))
    rest = near.drop("_first", "_last").select(*log.columns).join(gone.select(record), record, "left_anti")
    after = log.select(entity, start).join(days, entity).where(F.col(start) > F.col("_last")).groupBy(entity).agg(F.min(start).alias("_after"))
    rows = rest.select(*obs, F.struct(*log.columns).alias("_old"))
    rows = rows.unionByName(changed.select(*obs, F.lit(None).cast(rows.schema["_old"].dataType).alias("_old")))
    seq = next_value(rows, [entity], [ts, record], value=ts, out="_next_ts", chunks=chunks).join(after, entity, "left")
    new_end = F.coalesce(F.to_date("_next_ts").cast("string"), F.col("_after"), F.lit(OPEN_END))
    moved = seq.withColumn("_end", new_end).where(F.col("_old").isNull() | (F.col(f"_old.{end}") != F.col("_end")))
    moved = stage(moved.select(*obs, "_old", "_end"), "splice-moved")
    old = moved.where(F.col("_old").isNotNull()).select("_old.*")
    return Splice(gone.unionByName(old), moved.select(entity, cond, day.alias(start), F.col("_end").alias(end), ts, record))
