"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

# The characters that separate words (fixed value of the contracts).
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"

# Texts are worked on in slices of about this many bytes, so a worker's
# memory does not depend on how many rows an Arrow batch holds.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: Column) -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(col, F.lit(""))


def word_list(text: Column) -> Column:
    """Words of a text; none for an empty text."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def crc_split(col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: -1)."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of slices of a string array; nulls are empty.

    A slice ends before the row that would take it over ``limit`` bytes; a
    longer text is a slice of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    first, held, room = 0, [], limit
    for i, value in enumerate(texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())):
        raw = value.as_py() or b""
        if held and len(raw) > room:
            yield first, held
            first, held, room = i, [], limit
        held.append(raw)
        room -= len(raw)
    if held:
        yield first, held


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, each followed by ``gap``, and where each starts
    (one more entry: the end)."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + len(gap)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return np.frombuffer(gap.join([*texts, b""]), np.uint8), starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in [starts[i], starts[i+1])."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]


def prefix_sums(df: DataFrame, group: str, chunk: str, order: list[Column], size: str, out: str) -> DataFrame:
    """``out``: sum of ``size`` over all earlier rows of the same ``group``.

    Rows are ordered by ``chunk`` first, then by ``order`` inside it, so a hot
    group is summed chunk by chunk in many tasks; only one row per (group,
    chunk) meets in the second step. ``df`` must not change between two
    reads (stage it); ``group`` and ``chunk`` are not null.
    """
    upto = (W.unboundedPreceding, -1)
    inside = W.partitionBy(group, chunk).orderBy(*order).rowsBetween(*upto)
    across = W.partitionBy(group).orderBy(chunk).rowsBetween(*upto)
    before = (
        df.groupBy(group, chunk)
        .agg(F.sum(size).alias("_in_chunk"))
        .withColumn("_before", F.coalesce(F.sum("_in_chunk").over(across), F.lit(0)))
        .drop("_in_chunk")
    )
    rows = df.withColumn("_own", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return rows.join(before, [group, chunk]).withColumn(out, F.col("_before") + F.col("_own")).drop("_before", "_own")


__all__ = ["SPACES", "WORD", "crc_split", "joined", "prefix_sums", "slices", "stage", "sums", "table", "text_of", "word_list"]
