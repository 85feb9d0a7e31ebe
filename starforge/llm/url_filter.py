"""URL filter: a blocked Bloom filter before an exact hash join.

A listed entry is a canonical host and path prefix. A URL fits an entry if its
host is the entry's or a subdomain and its path starts with the entry's; the
longest fitting entry decides. Every URL has a few candidate keys (host suffixes
times path prefixes of the lengths that are listed). The blocked Bloom filter
(one 512-bit block per key, so one cache line per test) passes the possible hits,
and only they go to the join with the list, which removes false positives.

The filter is built by Spark (bits combined per word) and its size is fixed by
the list's size, at most ``MAX_FILTER_BYTES``; a longer list makes it less
selective, never wrong, because the join is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 512
BITS_PER_KEY = 16
PROBES = 8
MAX_FILTER_BYTES = 64 << 20
A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# (host, path prefix, verdict): the list of the registered query (fixed values)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_and_path(url):
    """Canonical host (A-Z lowered) and path of a URL column; both empty without ``://``."""
    host = F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), *A_Z)
    return host, F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _place(h: int, blocks: int) -> tuple[int, list[int]]:
    """Block and bit positions of an unsigned 64-bit hash (the same rule as in ``build_filter``)."""
    a, b = h & 511, h >> 9 & 511 | 1
    return (h >> 18) % blocks, [(a + j * b) & 511 for j in range(PROBES)]


def build_filter(listed: DataFrame, key: str = "key", max_bytes: int = MAX_FILTER_BYTES) -> np.ndarray:
    """The filter's blocks (rows of eight 64-bit words) for the keys of ``listed``."""
    n = listed.count()
    blocks = max(1, min(max_bytes * 8 // BLOCK_BITS, -(-n * BITS_PER_KEY // BLOCK_BITS)))
    h = F.xxhash64(key)
    a, b = h.bitwiseAND(F.lit(511)), F.shiftrightunsigned(h, 9).bitwiseAND(F.lit(511)).bitwiseOR(F.lit(1))
    bits = F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda j: (a + j * b).bitwiseAND(F.lit(511)))
    at = listed.select((F.shiftrightunsigned(h, 18) % blocks).alias("block"), F.explode(bits).alias("bit"))
    word = F.shiftright("bit", 6)
    words = at.select("block", word.cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits")).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros((blocks, BLOCK_BITS // 64), np.int64)
    for part in words.toLocalIterator():  # at most max_bytes in all
        out[part["block"], part["word"]] = part["bits"]
    return out.view(np.uint64)


def possible_hits(pages: DataFrame, listed: DataFrame, lengths: list[int], host: str = "host", path: str = "path", out: str = "hits") -> DataFrame:
    """``pages`` with the array of candidate keys that the Bloom filter passes."""
    held = pages.sparkSession.sparkContext.broadcast(build_filter(listed))

    @F.arrow_udf("array<string>")
    def passed(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        table = held.value
        blocks = len(table)

        def has(key: str) -> bool:
            block, bits = _place(xxhash.xxh64_intdigest(key.encode(), 42), blocks)
            words = table[block]
            return all(int(words[i >> 6]) >> (i & 63) & 1 for i in bits)

        def hits(h: str, p: str) -> list[str]:
            prefixes = [p[:n] for n in lengths if n <= len(p)]
            found, at = [], 0
            while h:
                found += [k for x in prefixes if has(k := h[at:] + x)]
                at = h.find(".", at) + 1
                if not at:
                    break
            return found

        for hosts, paths in parts:
            yield pa.array([hits(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())], pa.list_(pa.string()))

    return pages.withColumn(out, passed(F.col(host), F.col(path)))


def filter_urls(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict: one row per input row.

    ``listed`` has host, path, verdict (canonical; a null host or path lists
    nothing; of repeated entries the smallest verdict counts). ``rule`` is
    the longest fitting entry's host + path (of equally long ones the longer
    host's), null if none fits; then the verdict is ``default``. Null URLs
    and those without ``://`` have empty host and path and fit no entry.
    Repeated rows and ids stay; empty tables give no rows; other columns are
    ignored.
    """
    rules = (
        listed.where("host is not null and path is not null and host <> ''")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), F.length("path").alias("path_length"), "verdict")
    )
    lengths = sorted(r[0] for r in rules.select("path_length").distinct().collect())  # URL path lengths: few
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    # a verdict belongs to a host and path: pages that share them are judged once
    hits = possible_hits(rows.select("host", "path").distinct(), rules, lengths)
    asked = hits.select("host", "path", F.explode("hits").alias("key"))
    best = asked.join(rules, "key").groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), "host_length", "key", "verdict")).alias("best"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def registered_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "host string, path string, verdict string")
