"""Merge (upsert) as DataFrame joins, for tables without a MERGE command.

All functions are pure: ``(target, source) -> DataFrame``. Keys compare with
``=``, so a null key never matches (it is inserted, as with SQL MERGE).

* ``insert_only``   - rows of source whose key is not in target (append them);
* ``upsert_all``    - target rows not in source, plus all source rows;
* ``merge``         - general form: update all or some columns of matched
                      rows, optionally only where a condition holds, insert
                      the unmatched source rows.

A target row matched by several source rows is an error by default: inside
the plan, from a count over a window on the merge keys that travels with the
source row (``merge``), or as one hash-aggregate count over the staged source
(``upsert_all``). Rows with a null key never enter a window or a join.
``on_duplicate='latest'`` keeps the source row with the greatest ``order``
value instead (ties broken by the row itself).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def _per_key(keys: Sequence[str]) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


def _several(keys: Sequence[str]) -> Column:
    return F.raise_error(F.lit("merge: several source rows match one target row (keys %s)" % ",".join(keys)))


def dedupe_source(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order: str | Column | None = None,
) -> DataFrame:
    """Source rows checked (``'error'``) or reduced (``'latest'``) per key.

    ``'error'``: any key that occurs twice fails the job, from a count over a
    window on the keys. The check is a filter, so key columns stay as they
    are. Null-key rows never match and go around the window.

    ``'latest'``: one row per non-null key by ``max_by`` - an aggregate with
    a partial step, so a key repeated many times collapses map-side. Null-key
    rows are grouped by their whole content and re-expanded to their count,
    so all of them survive.
    """
    if on_duplicate == "allow":
        return source
    if on_duplicate == "error":
        counted = source.where(~_any_null(keys)).withColumn("_n", _per_key(keys))
        checked = counted.where(F.when(F.col("_n") > 1, _several(keys)).otherwise(F.lit(True))).drop("_n")
        return checked.unionByName(source.where(_any_null(keys)))
    if on_duplicate != "latest":
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    if order is None:
        raise ValueError("on_duplicate='latest' needs an order column")
    cols = source.columns
    others = [c for c in cols if c not in keys]
    row = F.struct(*others) if others else F.struct(F.lit(1).alias("_one"))
    src = source.withColumns({
        "_nullkey_row": F.when(_any_null(keys), F.struct(*cols)),
        "_ord": F.col(order) if isinstance(order, str) else order,
    })
    # ties on the order are broken by the row itself (deterministic)
    pick = F.max_by(row, F.struct(F.col("_ord"), row))
    agg = src.groupBy(*keys, "_nullkey_row").agg(F.count(F.lit(1)).alias("_n"), pick.alias("_row"))
    copies = F.when(F.col("_nullkey_row").isNotNull(), F.col("_n")).otherwise(F.lit(1))
    out = agg.select(
        *keys,
        *[F.col(f"_row.{c}").alias(c) for c in others],
        F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy"),
    )
    return out.select(*cols)


def check_unique_keys(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None) -> None:
    """Fail when a non-null key occurs more than once (eager, one job).

    With ``target`` only keys that match a target row count. A count per key
    is a hash aggregate with a partial step; only keys that repeat are looked
    up, and at most one of them reaches the driver.
    """
    repeated = source.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    if target is not None:
        repeated = repeated.join(target.select(*keys), list(keys), "left_semi")
    dup = repeated.limit(1).collect()
    if dup:
        raise ValueError("merge: several source rows match one target row (keys %s = %s)" % (",".join(keys), tuple(dup[0])[:-1]))


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with no matching target key: the rows to append.

    Only the key columns of the target are read; existing rows are never
    rewritten, so publishing is an append.
    """
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def apply_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole table after an insert-only merge."""
    return target.unionByName(insert_only(target, source, keys).select(*target.columns))


def upsert_all(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order: str | Column | None = None,
    stage_source: bool = True,
) -> DataFrame:
    """Update every column of matched rows, insert the rest.

    = (target rows whose key is not in source) + (source rows). The anti join
    reads only the source keys, so with a batch-sized source the target is
    streamed past a broadcast key set instead of being shuffled; a null-key
    target row is never matched and stays.
    """
    if stage_source:
        # read twice below (anti-join keys, inserted rows): computed once.
        # With the rows staged, the duplicate check is a cheap count per key
        # and nothing needs to be deduplicated in the default mode.
        if on_duplicate == "error":
            src = stage(source, "merge-source")
            check_unique_keys(src, keys, target)
        else:
            src = stage(dedupe_source(source, keys, on_duplicate, order), "merge-source")
    else:
        src = dedupe_source(source, keys, on_duplicate, order)
    kept = target.join(src.where(~_any_null(keys)).select(*keys), list(keys), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def _merge_in_one_join(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | str, condition: str | Column | None, check: bool
) -> DataFrame:
    cols = target.columns
    upd = set(cols) - set(keys) if update == "all" else set(update)
    hashed = [c for c in cols if c in source.columns and "map<" not in target.schema[c].dataType.simpleString()]
    spread = F.when(_any_null(keys), F.xxhash64(*hashed)).otherwise(F.lit(0))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_spread")) if check else F.lit(1)
    a = target.withColumns({"_spread": spread, "_in": F.lit(1)}).alias("a")
    b = source.withColumn("_spread", spread).withColumn("_n", n).alias("b")
    j = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_spread"]], "full_outer")
    known = F.col("a._in").isNotNull()
    matched = known & F.col("b._n").isNotNull()
    if check:
        matched = F.when(known & (F.col("b._n") > 1), _several(keys)).otherwise(matched)
    if condition is not None:
        c = F.expr(condition) if isinstance(condition, str) else condition
        matched = matched & F.coalesce(c, F.lit(False))

    def merged(c: str) -> Column:
        new = F.col(f"b.{c}") if c in source.columns else F.lit(None)
        from_source = ~known | matched if c in upd else ~known
        return F.when(from_source, new).otherwise(F.col(f"a.{c}")).cast(target.schema[c].dataType).alias(c)

    return j.select(*[merged(c) for c in cols])


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | str | None = "all",
    condition: str | Column | None = None,
    insert: bool = True,
    on_duplicate: str = "error",
    order: str | Column | None = None,
    read_once: bool = False,
) -> DataFrame:
    """General merge: update matched rows, insert the source rows that match nothing.

    ``update``: ``'all'``, a list of columns to set from the source (partial
    update), or ``None`` (no update). ``condition`` is evaluated on matched
    rows with the target aliased ``a`` and the source ``b`` (e.g.
    ``"b.mark > a.mark"``); where it is not true the target row is kept as is.

    Matched rows come from a left join, new rows from an anti join: the planner
    broadcasts a source whose size allows it and the target stays where it is.
    Rows with a null key match nothing and go past the joins, so they never meet
    in one task. Both sides are read more than once: pass stored or staged frames.

    ``read_once`` is for sides that are dear to compute and of like size: one
    full outer join, each side read and exchanged once (the duplicate count uses
    the same partitioning). A hash of the row joins the exchange keys of rows
    with a null key, so that they do not meet in one task.
    """
    cols = target.columns
    types = {c: target.schema[c].dataType for c in cols}
    if update is not None and on_duplicate == "latest":
        source = dedupe_source(source, keys, on_duplicate, order)
    if update is not None and insert and read_once:
        return _merge_in_one_join(target, source, keys, update, condition, on_duplicate == "error")
    keyed_t, keyed_s = target.where(~_any_null(keys)), source.where(~_any_null(keys))
    if update is None:
        old = target
    else:
        check = on_duplicate == "error"
        a = keyed_t.alias("a")
        b = keyed_s.withColumn("_n", _per_key(keys) if check else F.lit(1)).alias("b")
        j = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "left")
        matched = F.col("b._n").isNotNull()
        if check:
            matched = F.when(F.col("b._n") > 1, _several(keys)).otherwise(matched)
        if condition is not None:
            c = F.expr(condition) if isinstance(condition, str) else condition
            matched = matched & F.coalesce(c, F.lit(False))
        upd = set(cols) - set(keys) if update == "all" else set(update)

        def updated(c: str) -> Column:
            if c not in upd:
                return F.col(f"a.{c}").alias(c)
            new = F.col(f"b.{c}") if c in source.columns else F.lit(None)
            return F.when(matched, new).otherwise(F.col(f"a.{c}")).cast(types[c]).alias(c)

        old = j.select(*[updated(c) for c in cols])
        old = old.unionByName(target.where(_any_null(keys)))
    if not insert:
        return old

    def given(c: str) -> Column:
        return (F.col(c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c)

    met = keyed_t.select(*keys).join(keyed_s.select(*keys), list(keys), "left_semi")
    new_rows = keyed_s.join(met, list(keys), "left_anti").unionByName(source.where(_any_null(keys)))
    return old.unionByName(new_rows.select(*[given(c) for c in cols]))
