"""Published histories that keep their observations, so that late, moved and
withdrawn ones change them anywhere.

Layout: folders ``row_state=open|closed / segment=n / month_key=yyyymm`` (0 for open
rows). A merge writes all its rows under the next segment number: the open rows
after it, the rows it closed or added, and the other rows of every closed folder
that lost a row (copy on write, one month of one earlier segment at a time). Which
folders it replaces is said by marker files of its number; they count from the
moment its one generation marker is there, which commits the merge as a whole.
Then the replaced folders go, so the folders left are the history.

A merge without late observations reads and rewrites open rows only and adds a
closed folder per month it closed rows of.

The last day that rows of a closed folder reach to is kept in a marker file too. A
lookup of a range of days opens the folders that meet the range and no others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import history
from ..session import stage
from ..sources.feeds import partition_filter
from ..sources.store import TableStore

ROW_STATE, SEGMENT, MONTH = "row_state", "segment", "month_key"
PARTS = (ROW_STATE, SEGMENT, MONTH)
OBSERVED_AT = "observed_at"
GENERATION = "_GENERATION-"
REPLACED = "_REPLACED-"
SPAN = "_SPAN-"
# Closed segments that readers list before they are folded into one.
MAX_SEGMENTS = 16


def _generation(number: int) -> str:
    return f"{GENERATION}{number:06d}"


def _replaced(number: int, segment: int, month: int) -> str:
    return f"{REPLACED}{number:06d}-{segment:06d}-{month}"


def committed(store: TableStore, name: str) -> int:
    numbers = [int(f[len(GENERATION):]) for f in store.marks(name, GENERATION)]
    if not numbers:
        raise ValueError(f"history {name} has no {GENERATION} marker (written in another layout): publish it anew")
    return max(numbers)


def _replaced_folders(store: TableStore, name: str) -> list[tuple[str, int, int, int]]:
    """(marker, generation, segment, month)"""
    return [(f, *map(int, f[len(REPLACED):].split("-"))) for f in store.marks(name, REPLACED)]


def _laid_out(df: DataFrame, segment: int) -> DataFrame:
    is_open = F.col("end_date") == F.lit("")
    month = F.date_format(F.col("start_date").cast("date"), "yyyyMM").cast("int")
    return df.withColumns(
        {ROW_STATE: F.when(is_open, F.lit("open")).otherwise(F.lit("closed")), SEGMENT: F.lit(segment), MONTH: F.when(is_open, F.lit(0)).otherwise(month)}
    )


def read_observed(store: TableStore, name: str) -> DataFrame:
    """The committed rows: open ones of the last merge, closed ones of folders that no committed merge replaced."""
    last = committed(store, name)
    dead = [(s, m) for _, g, s, m in _replaced_folders(store, name) if g <= last]
    closed = (F.col(ROW_STATE) == "closed") & (F.col(SEGMENT) <= last)
    for s, m in dead:  # until the merge's clean-up is done
        closed = closed & ~((F.col(SEGMENT) == s) & (F.col(MONTH) == m))
    return store.read(name).where(((F.col(ROW_STATE) == "open") & (F.col(SEGMENT) == last)) | closed)


def _spans(store: TableStore, name: str) -> dict[tuple[int, int], str]:
    """Closed folder (segment, month) -> the last end of its rows, for folders that have it noted."""
    out: dict[tuple[int, int], str] = {}
    for f in store.marks(name, SPAN):
        segment, month, end = f[len(SPAN):].split("-", 2)
        at = (int(segment), int(month))
        out[at] = max(end, out.get(at, ""))
    return out


def _note_spans(store: TableStore, name: str, segment: int) -> None:
    """Note the spans of a segment's closed folders (one column of what was just written is read)."""
    if str(segment) not in store.partition_values(name, SEGMENT, under=f"{ROW_STATE}=closed"):
        return
    rows = store.read(name).where((F.col(ROW_STATE) == "closed") & (F.col(SEGMENT) == segment))
    for r in rows.groupBy(MONTH).agg(F.max("end_date").alias("end")).collect():  # folders, not rows
        if r[MONTH] is not None:
            store.mark(name, f"{SPAN}{segment:06d}-{r[MONTH]}-{r['end']}")


def read_observed_days(store: TableStore, name: str, first: dt.date, last: dt.date) -> DataFrame:
    """The committed rows that hold on some day of ``first`` to ``last``.

    Closed folders that start after the range or end before it are not opened (a
    folder without a note is); within the others the days reach the scan.
    """
    log = read_observed(store, name)
    month = last.year * 100 + last.month
    outside = [at for at, end in _spans(store, name).items() if at[1] > month or end <= str(first)]
    if outside:
        log = log.where((F.col(ROW_STATE) == "open") | ~partition_filter((SEGMENT, MONTH), outside))
    return log.where((F.col("start_date") <= str(last)) & ((F.col("end_date") == "") | (F.col("end_date") > str(first))))


def point_in_time_published(store: TableStore, name: str, facts: DataFrame, fact_entity: str, fact_ts: str, fact_id: str, rule) -> DataFrame:
    """``history.point_in_time`` against a published history, of which only the
    folders that meet the facts' days are opened, and only the rows that do are put in order.

    Facts without a date find nothing; ``facts`` is read twice (its days first).
    """
    days = facts.agg(F.min(F.to_date(fact_ts)).alias("first"), F.max(F.to_date(fact_ts)).alias("last")).first()
    if days["first"] is None:
        rows = read_observed(store, name).where(F.lit(False))
    else:
        rows = read_observed_days(store, name, days["first"], days["last"])
    rows = rows.select(rule.entity, rule.cond, "start_date", "end_date")
    return history.point_in_time(facts, fact_entity, fact_ts, fact_id, rows, rule.entity, rule.cond)


def create_observed(store: TableStore, name: str, built: DataFrame, rule) -> None:
    """First publish of a history built by ``history.observed_history``."""
    store.create(name, _laid_out(built, 1), PARTS, rule.sort, marks=(_generation(1),))
    _note_spans(store, name, 1)


def publish_observed(store: TableStore, name: str, obs: DataFrame, rule, withdrawn: DataFrame | None = None) -> None:
    """Put a batch of observations into a published history, seen as a whole or not at all.

    ``obs`` has the entity, condition, ``OBSERVED_AT`` and record id; other columns are ignored.
    """
    last = committed(store, name)
    clean_observed(store, name, last)
    log = read_observed(store, name)
    spliced = history.splice_history(log, obs, rule.entity, rule.cond, OBSERVED_AT, rule.keys[0], withdrawn)
    removed = stage(spliced.removed, f"removed-{name}")
    if not removed.take(1) and not spliced.added.take(1):
        return  # nothing that is not published
    lost = removed.where(F.col(ROW_STATE) == "closed").select(SEGMENT, MONTH).distinct().collect()  # folders, not rows
    dead = [(r[SEGMENT], r[MONTH]) for r in lost]
    _write(store, name, log, removed.select(rule.keys[0]), spliced.added, dead, last + 1, rule)


def compact_observed(store: TableStore, name: str, rule, most: int = MAX_SEGMENTS) -> bool:
    """Fold the closed rows of all segments into one if there are more than ``most``.

    A merge that adds nothing: cut off before its marker it changes nothing,
    and readers of the old folders see the same rows.
    """
    last = committed(store, name)
    clean_observed(store, name, last)
    segments = store.partition_values(name, SEGMENT, under=f"{ROW_STATE}=closed")
    if len(segments) <= most:
        return False
    dead = [(int(s), int(m)) for s in segments for m in store.partition_values(name, MONTH, under=f"{ROW_STATE}=closed/{SEGMENT}={s}")]
    log = read_observed(store, name)
    nothing = log.limit(0)
    _write(store, name, log, nothing.select(rule.keys[0]), nothing.drop(*PARTS), dead, last + 1, rule)
    return True


def _write(store: TableStore, name: str, log: DataFrame, removed_ids: DataFrame, added: DataFrame, dead: list[tuple[int, int]], number: int, rule) -> None:
    rewritten = F.col(ROW_STATE) == "open"
    for s, m in dead:
        rewritten = rewritten | ((F.col(ROW_STATE) == "closed") & (F.col(SEGMENT) == s) & (F.col(MONTH) == m))
    kept = log.where(rewritten).join(removed_ids, rule.keys[0], "left_anti")
    rows = kept.select(*added.columns).unionByName(added)
    store.append(name, _laid_out(rows, number), PARTS, rule.sort)
    _note_spans(store, name, number)
    for s, m in dead:
        store.mark(name, _replaced(number, s, m))
    store.mark(name, _generation(number))
    clean_observed(store, name, number)


def clean_observed(store: TableStore, name: str, last: int) -> None:
    """Remove what a cut-off merge left, and the folders that committed merges replaced."""
    for mark, g, s, m in _replaced_folders(store, name):
        if g <= last:
            store.drop_partition(name, PARTS, ("closed", s, m))
        store.unmark(name, mark)
    for mark in store.marks(name, SPAN):  # of folders that are gone or were never committed
        segment, month = map(int, mark[len(SPAN):].split("-", 2)[:2])
        if segment > last or str(month) not in store.partition_values(name, MONTH, under=f"{ROW_STATE}=closed/{SEGMENT}={segment}"):
            store.unmark(name, mark)
    for state in ("open", "closed"):
        for v in map(int, store.partition_values(name, SEGMENT, under=f"{ROW_STATE}={state}")):
            if v > last or (state == "open" and v != last):
                store.drop_partition(name, PARTS[:2], (state, v))
            elif not store.partition_values(name, MONTH, under=f"{ROW_STATE}={state}/{SEGMENT}={v}"):
                store.drop_partition(name, PARTS[:2], (state, v))  # all its months were replaced
