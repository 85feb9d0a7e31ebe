"""Surrogate keys (hash of the attribute values that identify a row).

The key is a pure function of the attribute values, so a fact can compute the
key of each of its dimensions itself. That makes the dimension lookup a
projection instead of a join (no shuffle), and dimension and fact always agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the key encoding (the SQL oracle repeats them).
KEY_PART_SEPARATOR = "|"
KEY_LENGTH_MARK = ":"
KEY_NULL_TOKEN = "~"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(cols: Sequence[ColumnOrName], compat: bool = False) -> Column:
    """The string that is hashed.

    Default form: every part is ``<length>:<text>`` (``~`` for null), parts
    joined by ``|``. The length prefix makes the encoding injective, so
    ('1','11') and ('11','1') get different keys and a null part never turns
    the whole key null.

    ``compat=True`` is the plain concatenation of the string casts: parts run
    together without a separator and any null part gives a null key.
    """
    parts = [_col(c).cast("string") for c in cols]
    if compat:
        return F.concat(*parts)
    tokens = [
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(KEY_LENGTH_MARK), p), F.lit(KEY_NULL_TOKEN))
        for p in parts
    ]
    return F.concat_ws(KEY_PART_SEPARATOR, *tokens)


def surrogate_key(cols: Sequence[ColumnOrName], bits: int = 512, compat: bool = False) -> Column:
    """``sha2`` over :func:`key_text`; ``bits`` in (224, 256, 384, 512)."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    return F.sha2(key_text(cols, compat=compat), bits)
