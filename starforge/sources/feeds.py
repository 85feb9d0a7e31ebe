"""Raw feeds: landed JSON records -> typed, partitioned raw tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import parse_timestamp
from ..functions.clean import RAW_NULL, fill_strings
from ..operators.merge import dedupe_source, upsert_all
from . import keyindex
from .store import TableStore

PARTITION_COLS = ("year", "month", "day")
# Column of a streamed batch that orders the landings of one record (the
# file's time, then its path); never stored.
LANDED = "_landed"
# Landed fields that the schema does not name: a map while the batch is worked on;
# stored (as JSON text) only for what cannot become a column.
RESCUED = "_rescued"
COLUMN_NAME = r"[A-Za-z][A-Za-z0-9_]*"
MOST_COLUMNS = 2000  # of a raw table; further new fields stay in the rescue column


@dataclass(frozen=True)
class FeedSpec:
    """How one feed is landed, cleaned and keyed."""

    name: str  # raw table name
    mark_name: str  # its row in the watermark table
    schema: T.StructType
    keys: tuple[str, ...]
    date_col: str = "crash_date"
    partition_by: tuple[str, ...] = PARTITION_COLS
    exclude: tuple[tuple[str, str], ...] = field(default_factory=tuple)  # (column, value) dropped with <>
    allow_new_columns: bool = False  # landed fields beyond the schema become columns of the raw table


def read_landing(spark: SparkSession, spec: FeedSpec, path: str, fmt: str = "json") -> DataFrame:
    """Batch read of landed records with the declared schema (no inference)."""
    return spark.read.schema(spec.schema).format(fmt).load(path)


def prepare(df: DataFrame, spec: FeedSpec, cutoff: dt.datetime | dt.date | None = None) -> DataFrame:
    """Date partition columns, cutoff, ``'N/A'`` fill, exclusion filters.

    The partition columns come from the parsed date (day of month for
    ``day``). With an explicit ``cutoff`` (source-side cutoff, a choice of what
    to read) rows dated at or before it are left out; rows without a readable
    date are always kept. The stored mark never drops a landed row.
    Exclusions compare with ``<>`` after the fill, so a null value (now
    ``'N/A'``) is kept and only the excluded value is dropped.
    """
    ts = parse_timestamp(spec.date_col)
    out = df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
    if cutoff is not None:
        out = out.where((ts > F.lit(cutoff)) | ts.isNull())
    out = fill_strings(out, RAW_NULL)
    for col, value in spec.exclude:
        out = out.where(F.col(col) != F.lit(value))
    return out


def parse_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed JSON lines (column ``value``) by the declared schema, with the fields it does not name as a map."""
    fields = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    others = F.map_filter(fields, lambda k, _: ~k.isin(*schema.names))
    rows = lines.where(F.trim("value") != "")
    kept = [c for c in lines.columns if c != "value"]
    return rows.select(F.from_json("value", schema).alias("_record"), others.alias(RESCUED), *kept).select("_record.*", RESCUED, *kept)


def promote_new_fields(batch: DataFrame, known: Sequence[str]) -> DataFrame:
    """New landed fields as string columns, null where a record does not have them.

    ``known``: the table's columns, whose number counts towards ``MOST_COLUMNS``. A
    field whose name is no plain column name, or differs from a column only in
    case, or is beyond that number, stays in the rescue column. Names are looked
    up in the batch, so they are as many as the feed has fields.
    """
    if RESCUED not in batch.columns:
        return batch
    names = [r[0] for r in batch.select(F.explode(F.map_keys(RESCUED)).alias("name")).distinct().orderBy("name").collect()]
    taken = {c.lower() for c in [*known, *batch.columns]}
    earlier, new = set(known), []
    for n in names:
        if n in earlier:
            new.append(n)
        elif re.fullmatch(COLUMN_NAME, n) and n.lower() not in taken and len(taken) < MOST_COLUMNS:
            new.append(n)
            taken.add(n.lower())
    rest = [n for n in names if n not in new]
    left = F.map_filter(RESCUED, lambda k, _: k.isin(*rest)) if rest else None
    out = batch.withColumns({n: F.element_at(RESCUED, n) for n in new}) if new else batch
    if left is None:
        return out.drop(RESCUED)
    return out.withColumn(RESCUED, F.when(F.size(left) > 0, F.to_json(left)))


def without_key(keys: Sequence[str]):
    """Rows with an unknown key part (null or the ``'N/A'`` that stands for it)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | (F.coalesce(F.col(k).cast("string"), F.lit(RAW_NULL)) == RAW_NULL)
    return cond


def latest_versions(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without) of a batch, each record once.

    The version landed last wins per key (without landing information the
    greatest row, so the choice is repeatable). Rows with an unknown key part
    cannot be told apart by it: each different row is a record of its own.
    """
    order = LANDED if LANDED in batch.columns else F.lit(0)
    keyed = dedupe_source(batch.where(~without_key(keys)), keys, "latest", order)
    return keyed.drop(LANDED), batch.where(without_key(keys)).drop(LANDED).distinct()


def upsert_feed(store: TableStore, spec: FeedSpec, batch: DataFrame) -> None:
    """Update-all / insert-rest of a batch into the raw table (M2).

    Of several versions of a record in the batch the last landed one counts;
    rows without a key are added unless the same row is there
    (``latest_versions``), in the first batch as in later ones.

    Only partitions that the batch touches are rewritten: those of the batch
    rows, plus those holding an older version of a batch key (a record whose
    date moved). The latter are found through the table's key index, so a batch
    opens the files of these partitions only.
    """
    parts = list(spec.partition_by)
    keys = list(spec.keys)
    if not store.exists(spec.name):
        keyed, unkeyed = latest_versions(batch, keys)
        keyindex.add(store, spec.name, batch, keys, parts)
        store.create(spec.name, keyed.unionByName(unkeyed), parts)
        return
    keyindex.ensure(store, spec.name, keys, parts)
    target = store.read(spec.name, merge_schema=spec.allow_new_columns)
    cols = list(target.columns)
    if spec.allow_new_columns:
        cols += [c for c in batch.columns if c not in cols and c != LANDED]
    landed = [c for c in batch.columns if c == LANDED]
    keyed, unkeyed = latest_versions(align(batch, [*cols, *landed], target.schema), keys)
    candidates = keyindex.partitions_of(store, spec.name, keyed, keys, parts)
    moved = target.where(partition_filter(parts, candidates)).select(*keys, *parts).join(keyed.select(*keys), keys, "left_semi").select(*parts)
    # The touched partitions (the batch's dates plus those a moved record
    # left) are few - bounded by the days a batch spans - so they become a
    # literal partition filter: only their files are listed and read.
    touched_vals = [tuple(r) for r in batch.select(*parts).unionByName(moved).distinct().collect()]
    affected = align(target.where(partition_filter(parts, touched_vals)), cols, keyed.schema)
    touched = batch.sparkSession.createDataFrame(touched_vals, target.select(*parts).schema)
    known = upsert_all(affected.where(~without_key(keys)), keyed, keys)
    rest = affected.where(without_key(keys)).unionByName(unkeyed).distinct()
    keyindex.add(store, spec.name, keyed, keys, parts)
    store.overwrite_partitions(spec.name, known.unionByName(rest), parts, touched=touched)


def partition_filter(parts: Sequence[str], values: Sequence[tuple]):
    """``(p1, p2, ...) IN values`` on partition columns, null-safe.

    One ``IN`` over the complete tuples (a hash set for long lists, evaluated
    per partition at listing time); tuples with a null part (unparsable
    dates) are matched separately.
    """
    full = [v for v in values if None not in v]
    cond = F.lit(False)
    if full:
        if len(parts) == 1:
            cond = F.col(parts[0]).isin([v[0] for v in full])
        else:
            cond = F.struct(*parts).isin([F.struct(*[F.lit(x).alias(c) for c, x in zip(parts, v)]) for v in full])
    for v in values:
        if None in v:
            term = F.lit(True)
            for c, x in zip(parts, v):
                term = term & (F.col(c).isNull() if x is None else (F.col(c) == F.lit(x)))
            cond = cond | term
    return cond


def align(df: DataFrame, cols: Sequence[str], other: T.StructType) -> DataFrame:
    """``df`` with exactly ``cols``; missing ones are typed nulls."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(other[c].dataType).alias(c) for c in cols])


def batch_cutoff(mark, days_ago: int | None, as_of: dt.datetime | None = None):
    """From when to land the next batch: the mark less a look-back.

    The mark counts as ``as_of`` at most, so one record dated in the future
    does not move the cutoff beyond the present. What has been landed is
    ingested whatever its date.
    """
    if mark is None or days_ago is None:
        return None
    return (mark if as_of is None else min(mark, as_of)) - dt.timedelta(days=days_ago)


def feed_specs() -> dict[str, FeedSpec]:
    from .schemas import CRASH_SCHEMA, PEOPLE_SCHEMA, VEHICLE_SCHEMA

    return {
        "crashes": FeedSpec("crashes", "Crashes", CRASH_SCHEMA, ("crash_record_id",), allow_new_columns=True),
        "people": FeedSpec("people", "People", PEOPLE_SCHEMA, ("person_id", "crash_record_id"), allow_new_columns=True),
        "vehicles": FeedSpec(
            "vehicles", "Vehicles", VEHICLE_SCHEMA, ("vehicle_id", "crash_record_id"), exclude=(("unit_type", "PEDESTRIAN"),), allow_new_columns=True
        ),
    }
