"""Fact assembly: foreign keys, degenerate keys, typed measures.

The reference resolves each foreign key with an inner join to its dimension,
on the very attributes the dimension key is hashed from. Here the key is
computed on the fact row itself (``dim_key``), which is equal by construction
and needs no join at all: no shuffle per dimension, and no fact row silently
lost when an attribute is null. ``lookup`` is kept for dimensions whose key is
not derivable from the fact row, and ``orphan_keys`` checks referential
integrity when wanted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import DIM_NULL, filled, string_columns
from ..functions.keys import surrogate_key


def dim_key(
    df: DataFrame,
    attrs: Sequence[str],
    fill: str | None = DIM_NULL,
    bits: int = 512,
    compat: bool = False,
) -> Column:
    """Key of the dimension row a fact row points to (same fill, same hash)."""
    strs = set(string_columns(df, attrs)) if fill is not None else set()
    cols = [filled(a, fill) if a in strs else F.col(a) for a in attrs]
    return surrogate_key(cols, bits, compat)


def build_fact(
    df: DataFrame,
    keys: Mapping[str, Column],
    degenerate: Mapping[str, Column | str] | None = None,
    measures: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """One output row per input row: keys, degenerate keys, measures."""
    def _c(v):
        return F.col(v) if isinstance(v, str) else v

    cols = [v.alias(k) for k, v in keys.items()]
    cols += [_c(v).alias(k) for k, v in (degenerate or {}).items()]
    cols += [_c(v).alias(k) for k, v in (measures or {}).items()]
    return df.select(*cols)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]] | Sequence[str],
    take: Sequence[str],
    how: str = "inner",
    fixed_size: bool = False,
) -> DataFrame:
    """Equi-join lookup of dimension columns ``take``.

    ``fixed_size=True`` marks a dimension whose row count has a known bound
    (e.g. the 86,400-row time dimension) and broadcasts it. Otherwise the
    planner chooses from the size estimate, and AQE switches to a broadcast at
    runtime when the materialised side is below the threshold. A null attribute
    finds the dimension row with the same null, so no fact row is lost to it.
    """
    pairs = [(c, c) if isinstance(c, str) else c for c in on]
    d = dim.select(*[F.col(dc).alias(f"_lk_{i}") for i, (_, dc) in enumerate(pairs)], *take)
    if fixed_size:
        d = F.broadcast(d)
    cond = [fact[fc].eqNullSafe(d[f"_lk_{i}"]) for i, (fc, _) in enumerate(pairs)]
    out = fact.join(d, cond, how)
    return out.drop(*[f"_lk_{i}" for i in range(len(pairs))])


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key_col: str | None = None) -> DataFrame:
    """Distinct fact keys with no dimension row (empty when consistent).

    The fact side is reduced to distinct keys before the shuffle.
    """
    dk = dim_key_col or key
    fk = fact.select(key).distinct()
    return fk.join(dim.select(F.col(dk).alias(key)), key, "left_anti")
