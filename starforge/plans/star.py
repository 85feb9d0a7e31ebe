"""A star schema as configuration: build every table, publish each by its rule.

``build_star`` turns the window extracts into a dict of lazy DataFrames (the
dimensions, bridges, histories and the fact); ``publish_star`` merges each
into the served store in dependency order (dimensions, entity dimensions,
bridges, histories, then the fact), so a failed run never leaves a fact row
whose dimension rows are missing.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import event_time
from ..functions.clean import DIM_NULL
from ..operators import bridge as bridge_ops
from ..operators import dims, fact, history, merge
from ..session import adopt_scope, current_scope, stage
from ..sources import keyindex
from ..sources.catalog import repoint
from ..sources.feeds import partition_filter, without_key
from ..sources.store import TableStore
from .observed import OBSERVED_AT, compact_observed, create_observed, publish_observed


@dataclass(frozen=True)
class ValueDim:
    name: str
    key: str
    attrs: tuple[str, ...]
    fill: str | None = DIM_NULL
    rename: Mapping[str, str] | None = None
    key_last: bool = False
    in_fact: bool = True


@dataclass(frozen=True)
class EntityDim:
    name: str
    source: str
    key: str
    cols: tuple[str, ...]
    latest_by: str | None = None
    # Folders the published table is dealt to by its key's hash. A batch rewrites
    # those that hold a changed row: choose so many that a folder is a few files.
    buckets: int = 16


@dataclass(frozen=True)
class Bridge:
    name: str
    source: str
    group_col: str
    member_col: str
    group_key: str
    member_key: str | None = None
    # A timestamp that is the same for every row of a group (the crash date
    # of a crash): the bridge is then partitioned by its month.
    partition_ts: str | None = None


@dataclass(frozen=True)
class History:
    name: str
    entity_dim: str  # a ValueDim name (e.g. the location)
    cond_dim: str  # a ValueDim name (the changing condition)
    # Publish the observations with the intervals (``plans.observed``): late, moved
    # and withdrawn ones change the history where they belong. Else only rows that
    # start after an entity's latest known start are added.
    observed: bool = False


@dataclass(frozen=True)
class Star:
    main: str  # frame holding the fact grain
    ts: str  # its timestamp column
    record_id: str  # its natural key
    fact_name: str
    value_dims: tuple[ValueDim, ...]
    date_dim: str | None = "dim_date"
    time_dim: str | None = "dim_time"
    entity_dims: tuple[EntityDim, ...] = ()
    bridges: tuple[Bridge, ...] = ()
    histories: tuple[History, ...] = ()
    group_keys: tuple[str, ...] = ()  # fact columns copied from record_id
    measures: Mapping[str, str | None] = field(default_factory=dict)  # name -> type (None = as is)
    bits: int = 512
    compat: bool = False

    def dim(self, name: str) -> ValueDim:
        return next(d for d in self.value_dims if d.name == name)


TS = "_event_ts"
MONTH_KEY = "month_key"


def build_star(
    spark: SparkSession, star: Star, frames: Mapping[str, DataFrame], moved: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Lazy tables of the star. ``frames[star.main]`` is read by every
    dimension, the histories and the fact: pass a staged frame.

    ``moved`` holds published records that have left the extract's window. Fact,
    bridges and histories follow them; entity dimensions do not, whose latest
    version is that of the window.
    """
    moved = moved or {}
    whole = {n: f.unionByName(moved[n].select(*f.columns)) if n in moved else f for n, f in frames.items()}
    main = whole[star.main]
    main = main.withColumn(TS, event_time(main, star.ts))
    b, c = star.bits, star.compat
    out: dict[str, DataFrame] = {}
    for d in star.value_dims:
        out[d.name] = dims.value_dim(main, d.attrs, d.key, d.fill, d.rename, b, c, d.key_last)
    if star.date_dim:
        out[star.date_dim] = dims.date_dim(main, TS, "date_id", b, c)
    if star.time_dim:
        out[star.time_dim] = dims.time_dim(spark, "time_id", b, c)
    for e in star.entity_dims:
        out[e.name] = dims.entity_dim(frames[e.source], e.cols, e.key, e.latest_by)
    for br in star.bridges:
        src, carry = whole[br.source], ()
        if br.partition_ts:
            t = event_time(src, br.partition_ts)
            src, carry = src.withColumn(MONTH_KEY, (F.year(t) * 100 + F.month(t)).cast("int")), (MONTH_KEY,)
        out[br.name] = bridge_ops.bridge(src, br.group_col, br.member_col, br.group_key, br.member_key, carry=carry)
    for h in star.histories:
        ent, cond = star.dim(h.entity_dim), star.dim(h.cond_dim)
        obs = main.select(
            fact.dim_key(main, ent.attrs, ent.fill, b, c).alias(ent.key),
            fact.dim_key(main, cond.attrs, cond.fill, b, c).alias(cond.key),
            TS,
            star.record_id,
        ).where(F.col(TS).isNotNull())
        if h.observed:
            out[h.name] = history.observed_history(obs.withColumnRenamed(TS, OBSERVED_AT), ent.key, cond.key, OBSERVED_AT, star.record_id)
            continue
        out[h.name] = history.build_history(obs, ent.key, cond.key, TS, tiebreak=[star.record_id])
    keys = {d.key: fact.dim_key(main, d.attrs, d.fill, b, c) for d in star.value_dims if d.in_fact}
    if star.time_dim:
        keys["time_id"] = dims.time_key(F.hour(TS), F.minute(TS), F.second(TS), b, c)
    if star.date_dim:
        keys["date_id"] = dims.date_key(TS, b, c)
    measures = {m: (F.col(m).try_cast(t) if t else F.col(m)) for m, t in star.measures.items()}
    degenerate = {g: star.record_id for g in star.group_keys}
    if star.date_dim:
        degenerate[MONTH_KEY] = (F.year(TS) * 100 + F.month(TS)).cast("int")
    out[star.fact_name] = fact.build_fact(main, keys, degenerate, measures)
    return out


@dataclass(frozen=True)
class Rule:
    mode: str  # insert | upsert | groups | history | observed | static (created once, fixed content)
    keys: tuple[str, ...] = ()
    entity: str | None = None
    cond: str | None = None
    sort: tuple[str, ...] = ()  # sort within each written file (locality, min/max stats)
    partition_by: tuple[str, ...] = ()  # insert-only tables: also prunes the merge read
    tier: int = 0  # publish order: 0 dimensions and histories, 1 bridges, 2 fact
    else_keys: tuple[str, ...] = ()  # upsert: these tell rows apart whose key is unknown
    buckets: int = 0  # upsert: folders by key hash


def fact_keys(star: Star) -> list[str]:
    """Every key column of the fact."""
    keys = [d.key for d in star.value_dims if d.in_fact]
    keys += ["time_id"] if star.time_dim else []
    keys += ["date_id"] if star.date_dim else []
    return keys + list(star.group_keys)


def publish_rules(star: Star) -> dict[str, Rule]:
    """Merge rule per table: insert-only for value and date dimensions, the
    time dimension once; update-all for entity dimensions and the fact; the
    batch's groups replaced in bridges; history merge for the mini-dimensions."""
    rules: dict[str, Rule] = {}
    for d in star.value_dims:
        rules[d.name] = Rule("insert", (d.key,))
    if star.date_dim:
        rules[star.date_dim] = Rule("insert", ("date_id",))
    if star.time_dim:
        rules[star.time_dim] = Rule("static", ("time_id",))
    for e in star.entity_dims:
        rules[e.name] = Rule("upsert", (e.key,), buckets=e.buckets)
    for br in star.bridges:
        rules[br.name] = Rule(
            "groups",
            (br.group_key, br.member_key or br.member_col),
            partition_by=(MONTH_KEY,) if br.partition_ts else (),
            tier=1,
        )
    for h in star.histories:
        ent = star.dim(h.entity_dim).key
        mode, keys = ("observed", (star.record_id,)) if h.observed else ("history", ())
        rules[h.name] = Rule(mode, keys, entity=ent, cond=star.dim(h.cond_dim).key, sort=(ent, "start_date"))
    # The fact is partitioned by month (``month_key`` = yyyymm, 12 values a
    # year). A record is one fact: a corrected record replaces its fact, found
    # by the record's id (the group keys are copies of it). Only the batch's
    # months and those its records have left are read in full and rewritten.
    # A fact without a record id is told apart by all its keys.
    parts = (MONTH_KEY,) if star.date_dim else ()
    if star.group_keys:
        rules[star.fact_name] = Rule("upsert", (star.group_keys[0],), partition_by=parts, tier=2, else_keys=tuple(fact_keys(star)))
    else:
        rules[star.fact_name] = Rule("insert", tuple(fact_keys(star)), partition_by=parts, tier=2)
    return rules


# Layout of published history tables: the open rows (one per entity) of the
# last merge, and for each merge a segment of the rows that it closed. Both
# carry the merge's number, and one marker file commits both.
ROW_STATE = "row_state"
SEGMENT = "segment"
HISTORY_PARTS = (ROW_STATE, SEGMENT)
GENERATION = "_GENERATION-"


def generation_mark(number: int) -> str:
    return f"{GENERATION}{number:06d}"


def committed_generation(store: TableStore, name: str) -> int:
    numbers = [int(f[len(GENERATION):]) for f in store.marks(name, GENERATION)]
    if not numbers:
        raise ValueError(f"history {name} has no {GENERATION} marker (written in another layout): publish it anew")
    return max(numbers)


def _history_layout(df: DataFrame, end: str, segment: int) -> DataFrame:
    state = F.when(F.col(end) == F.lit(""), F.lit("open")).otherwise(F.lit("closed"))
    return df.withColumns({ROW_STATE: state, SEGMENT: F.lit(segment)})


def read_history(store: TableStore, name: str) -> DataFrame:
    """A history's rows: open ones of the last committed merge, closed ones up to it.

    Whatever a merge has written without its marker is not seen.
    """
    last = committed_generation(store, name)
    is_open = (F.col(ROW_STATE) == "open") & (F.col(SEGMENT) == last)
    return store.read(name).where(is_open | ((F.col(ROW_STATE) == "closed") & (F.col(SEGMENT) <= last)))


def publish_history(store: TableStore, name: str, df: DataFrame, rule: Rule) -> None:
    """One merge into a published history, seen as a whole or not at all.

    Only the open rows are read. Steps: remove what a cut-off run left (any
    other number than the committed ones); append open and newly closed rows
    under the next number; set its marker (the commit); remove the open rows
    it replaces. A run cut off at any point can be repeated.
    """
    last = committed_generation(store, name)
    clean_history(store, name, last)
    open_rows = read_history(store, name).where(F.col(ROW_STATE) == "open").drop(*HISTORY_PARTS)
    if not history.newer_rows(open_rows, df, rule.entity).take(1):
        return  # a replay: nothing starts later than what is known
    closed_now, open_after = history.merge_open_rows(open_rows, df, rule.entity, rule.cond)
    rows = _history_layout(closed_now.unionByName(open_after), "end_date", last + 1)
    store.append(name, rows, HISTORY_PARTS, rule.sort)
    store.mark(name, generation_mark(last + 1))
    clean_history(store, name, last + 1)


def clean_history(store: TableStore, name: str, last: int) -> None:
    """Remove segments after merge ``last`` and open rows of any other merge."""
    for state in ("open", "closed"):
        for v in store.partition_values(name, SEGMENT, under=f"{ROW_STATE}={state}"):
            if int(v) > last or (state == "open" and int(v) != last):
                store.drop_partition(name, HISTORY_PARTS, (state, int(v)))


def upsert_partitions(store: TableStore, name: str, current: DataFrame, df: DataFrame, rule: Rule) -> None:
    """Update-all / insert-rest of a table in partitions.

    A batch that changes no published row is appended (its new rows only).
    Otherwise the partitions of the batch's rows, and those an updated row
    has left, are rewritten. Where a row is published is found through the
    table's key index, so no other partition's files are opened. Rows whose key is unknown are added unless a row with the same
    ``else_keys`` is there.
    """
    keys, parts = list(rule.keys), list(rule.partition_by)
    src = stage(df.select(*current.columns), f"upsert-{name}")
    unknown = without_key(keys)
    keyed = src.where(~unknown)
    merge.check_unique_keys(keyed, keys)
    keyindex.ensure(store, name, keys, parts)
    candidates = keyindex.partitions_of(store, name, keyed, keys, parts)
    held = current.where(partition_filter(parts, candidates)).select(*keys, *parts).join(keyed.select(*keys), keys, "left_semi").select(*parts)
    vals = [tuple(r) for r in src.select(*parts).unionByName(held).distinct().collect()]
    if not vals:
        return
    keyindex.add(store, name, keyed, keys, parts)
    affected = current.where(partition_filter(parts, vals))
    known, rest = affected.where(~unknown), affected.where(unknown)
    added = merge.insert_only(rest, src.where(unknown), rule.else_keys or keys).select(*current.columns)
    published = known.join(keyed.select(*keys), keys, "left_semi").select(*current.columns)
    # a join, not exceptAll: keys are unique here, and exceptAll would hash a scan task's whole rows at once
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*keys, *(c for c in current.columns if c not in keys)]]
    changed = stage(keyed.alias("k").join(published.alias("p"), same, "left_anti"), f"changed-{name}")
    if not changed.join(published.select(*keys), keys, "left_semi").take(1):
        store.append(name, changed.unionByName(added), parts, rule.sort)
        return
    kept = known.join(keyed.select(*keys), keys, "left_anti").select(*current.columns)
    out = kept.unionByName(keyed).unionByName(rest).unionByName(added)
    touched = store.spark.createDataFrame(vals, current.select(*parts).schema)
    store.overwrite_partitions(name, out, parts, touched=touched, sort=rule.sort)


BUCKET = "bucket"


def in_buckets(df: DataFrame, rule: Rule) -> DataFrame:
    """``df`` with the folder its key belongs to."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in rule.keys]), F.lit(rule.buckets)).cast("int"))


def upsert_buckets(store: TableStore, name: str, current: DataFrame, df: DataFrame, rule: Rule) -> None:
    """Update-all / insert-rest of a table dealt to folders by its key's hash.

    The batch is compared with its own folders; only those that hold a new or
    changed row are rewritten, none if nothing differs. Rows without a key are
    compared as a whole.
    """
    cols = [c for c in current.columns if c != BUCKET]
    if BUCKET not in current.columns:  # published before it had folders
        store.create(name, in_buckets(current, rule), (BUCKET,))
        current = store.read(name)
    src = stage(in_buckets(df.select(*cols), rule), f"upsert-{name}")
    merge.check_unique_keys(src, rule.keys)
    folders = lambda rows: [tuple(r) for r in rows.select(BUCKET).distinct().collect()]
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in rule.keys]
    near = current.where(partition_filter((BUCKET,), folders(src)))
    published = near.alias("a").join(src.select(*rule.keys).alias("b"), same, "left_semi").select(*src.columns)
    changed = stage(src.exceptAll(published), f"changed-{name}")
    vals = folders(changed)
    if not vals:
        return
    kept = current.where(partition_filter((BUCKET,), vals)).join(changed.select(*rule.keys), list(rule.keys), "left_anti")
    store.overwrite_partitions(name, kept.select(*src.columns).unionByName(changed), (BUCKET,), sort=rule.sort)


def replace_groups(store: TableStore, name: str, current: DataFrame, df: DataFrame, rule: Rule) -> None:
    """A bridge's groups as the batch has them: pairs the source no longer holds go.

    Only the groups of the batch are compared, wherever they are published
    (found through the key index of the group key): a pair in another month, or with a member
    that was withdrawn, is stale. Without stale pairs the new ones are appended;
    else the partitions that hold stale or new pairs are rewritten. A group
    without any row in the batch stays as it is.
    """
    group, parts = rule.keys[0], list(rule.partition_by)
    src = stage(df.select(*current.columns).distinct(), f"groups-{name}")
    published = current
    if parts:
        keyindex.ensure(store, name, [group], parts)
        published = current.where(partition_filter(parts, keyindex.partitions_of(store, name, src, [group], parts)))
    in_batch = published.alias("c").join(src.select(F.col(group).alias("g")).distinct(), F.col(f"c.{group}").eqNullSafe(F.col("g")), "left_semi")
    held = stage(in_batch, f"held-{name}")
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in current.columns]
    stale = stage(held.alias("h").join(src.alias("s"), same("h", "s"), "left_anti"), f"stale-{name}")
    new = src.alias("s").join(held.alias("h"), same("s", "h"), "left_anti")
    if parts:
        keyindex.add(store, name, src, [group], parts)
    if not stale.take(1):
        store.append(name, new, parts, rule.sort)
        return
    if not parts:
        store.replace(name, current.alias("c").join(stale.alias("t"), same("c", "t"), "left_anti").unionByName(new))
        return
    vals = [tuple(r) for r in stale.select(*parts).unionByName(new.select(*parts)).distinct().collect()]  # partitions, not rows
    affected = current.where(partition_filter(parts, vals))
    out = affected.alias("c").join(stale.alias("t"), same("c", "t"), "left_anti").unionByName(new)
    touched = store.spark.createDataFrame(vals, current.select(*parts).schema)
    store.overwrite_partitions(name, out, parts, touched=touched, sort=rule.sort)


PUBLISH_ORDER = {"static": 0, "insert": 0, "upsert": 1, "groups": 1, "history": 2, "observed": 2}


def publish_tiers(tables: Mapping[str, DataFrame], rules: Mapping[str, Rule], fact_name: str) -> list[list[str]]:
    """Tables in dependency tiers: dimensions and histories, bridges, fact
    (the fact last in any case)."""
    tiers: dict[int, list[str]] = {}
    for n in tables:
        t = 1 << 30 if n == fact_name else rules[n].tier
        tiers.setdefault(t, []).append(n)
    out = []
    for t in sorted(tiers):
        out.append(sorted(tiers[t], key=lambda n: PUBLISH_ORDER[rules[n].mode]))
    return out


def publish_table(store: TableStore, name: str, df: DataFrame, rule: Rule) -> None:
    # rule.sort orders the rows of each file (a local sort per task, no global orderBy)
    if not store.exists(name):
        if rule.mode == "history":
            store.create(name, _history_layout(df, "end_date", 1), HISTORY_PARTS, rule.sort, marks=(generation_mark(1),))
            return
        if rule.mode == "observed":
            create_observed(store, name, df, rule)
            return
        if rule.mode == "upsert":
            unknown = without_key(rule.keys)
            df = merge.dedupe_source(df.where(~unknown), rule.keys, "error").unionByName(df.where(unknown))
        if rule.buckets:
            store.create(name, in_buckets(df, rule), (BUCKET,), rule.sort)
            return
        store.create(name, df, rule.partition_by, rule.sort)
        return
    if rule.mode == "static":
        return
    current = store.read(name)
    if rule.mode == "insert":
        if rule.partition_by:
            # partition values of the batch (bounded by the days of its window)
            # turn into a partition filter on the published table
            vals = [tuple(r) for r in df.select(*rule.partition_by).distinct().collect()]
            if not vals:
                return
            current = current.where(partition_filter(rule.partition_by, vals))
        new_rows = merge.insert_only(current, df, rule.keys).select(*current.columns)
        store.append(name, new_rows, rule.partition_by)
    elif rule.mode == "upsert" and rule.buckets:
        upsert_buckets(store, name, current, df, rule)
    elif rule.mode == "upsert" and rule.partition_by:
        upsert_partitions(store, name, current, df, rule)
    elif rule.mode == "upsert":
        # Only rows that are new or differ from their published version take
        # part; a batch that changes nothing (a replay, an overlapping
        # window) leaves the table as it is instead of rewriting it.
        src = stage(df.select(*current.columns), f"upsert-{name}")
        merge.check_unique_keys(src, rule.keys)
        published = current.join(src.select(*rule.keys), list(rule.keys), "left_semi").select(*current.columns)
        changed = src.exceptAll(published)
        if not changed.take(1):
            return
        store.replace(name, merge.upsert_all(current, changed, rule.keys))
    elif rule.mode == "groups":
        replace_groups(store, name, current, df, rule)
    elif rule.mode == "history":
        publish_history(store, name, df, rule)
    elif rule.mode == "observed":
        publish_observed(store, name, df, rule)
        compact_observed(store, name, rule)
    else:
        raise ValueError(rule.mode)


def publish_star(
    store: TableStore,
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Rule],
    fact_name: str,
    parallel: int = 4,
) -> list[str]:
    """Publish tier by tier. Tables of one tier are independent and are
    submitted as concurrent Spark jobs from ``parallel`` driver threads (the
    small dimension jobs would leave most of a cluster idle one by one); a
    tier starts only when the previous one has fully committed, so the fact
    is written last.

    SQL catalog entries made by ``register_tables`` are moved to the new
    snapshots at the end, and only then are old snapshots removed."""
    order: list[str] = []
    scope = current_scope()

    def run(n: str) -> None:
        with adopt_scope(scope):
            publish_table(store, n, tables[n], rules[n])

    for tier in publish_tiers(tables, rules, fact_name):
        if parallel > 1 and len(tier) > 1:
            with ThreadPoolExecutor(max_workers=min(parallel, len(tier))) as pool:
                futures = [pool.submit(run, n) for n in tier]
                for f in futures:
                    f.result()
        else:
            for n in tier:
                publish_table(store, n, tables[n], rules[n])
        order += tier
    repoint(store.spark, store, order)
    for n in order:
        store.vacuum(n, keep=2)
    return order
