"""Where a key has been stored: a small table beside a partitioned one.

One row per (64-bit hash of the key, partition it was written to). Rows are only
ever added, before the data they speak of is written, so the index knows at least
every partition that holds a key: an entry may be out of date (the record moved
on, a run was cut off, two keys share a hash), which costs a look into a partition
that does not hold the key, and no entry is ever missing. Whoever looks a batch's
keys up reads the hashes instead of the key column of the whole table, and opens
only the partitions they name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .store import TableStore

HASH = "key_hash"
# Files of the index that a lookup reads before they are written anew as few.
MOST_FILES = 64


def index_name(name: str) -> str:
    return f"{name}__keys"


def _entries(rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    return rows.select(F.xxhash64(*[F.col(k).cast("string") for k in keys]).alias(HASH), *parts).distinct()


def ensure(store: TableStore, name: str, keys: Sequence[str], parts: Sequence[str]) -> None:
    """Make the index of a stored table that has none (its key and partition columns are read once)."""
    if not store.exists(index_name(name)) and store.exists(name):
        store.create(index_name(name), _entries(store.read(name), keys, parts))


def add(store: TableStore, name: str, rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> None:
    """Add what the index does not have of ``rows``; to be called before they are written."""
    new = _entries(rows, keys, parts)
    index = index_name(name)
    if not store.exists(index):
        return store.create(index, new)
    known = store.read(index)
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (HASH, *parts)]
    new = stage(new.alias("n").join(known.alias("k"), same, "left_anti"), f"index-{name}")
    if new.take(1):
        store.append(index, new.hint("rebalance"))
        if len(store.read(index).inputFiles()) > MOST_FILES:
            store.replace(index, store.read(index).distinct())
            store.vacuum(index)


def partitions_of(store: TableStore, name: str, batch: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> list[tuple]:
    """Partitions that may hold a key of ``batch`` (all that do are among them); one entry per partition."""
    wanted = batch.select(F.xxhash64(*[F.col(k).cast("string") for k in keys]).alias(HASH)).distinct()
    return [tuple(r) for r in store.read(index_name(name)).join(wanted, HASH, "left_semi").select(*parts).distinct().collect()]
