"""Near duplicates by SimHash and covering locality-sensitive hashing.

Every bit position gets a nonzero vector of ``radius + 1`` bits; every nonzero
vector ``v`` of that length gives a table whose mask keeps the positions with
an odd product with ``v``. At most ``radius`` differing positions span at most
``radius`` dimensions, so some ``v`` is orthogonal to all of them: its mask
keeps none of the differing bits and the pair meets in that table. No pair
within the radius is lost, whatever the fingerprints are.

Steps: fingerprint per document (Arrow, whole texts, in slices of bounded
size); distinct fingerprints (copies collapse before any shuffle); one row per
fingerprint and table, dealt by masked value; inside a bucket, links checked by
Hamming distance and emitted as a spanning forest, never as all pairs; connected
components; labels joined back by fingerprint.

A bucket with more than ``BUCKET_ROWS`` fingerprints is not paired up at all.
Its links come from hubs: x and y differ in at most r bits if and only if some z
is within ``r // 2`` of x and within ``r - r // 2`` of y. Each fingerprint names
the hubs around it (inside the bits the table leaves free); all that name a hub
link to one that is close to it. This is exact and linear in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, text_of
from .graph import connected_components

BITS = 64
# Largest bucket whose distances one task computes (one row against the rest
# at a time: 8 bytes x 4096 of memory).
BUCKET_ROWS = 4096
# Words of one text hashed at a time.
WORDS_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """SimHash of one UTF-8 text, unsigned 64 bits.

    A-Z are lowered; words are split at ASCII white space; a shingle is
    ``shingle_words`` words joined by a space, repeats included (fewer words:
    the whole sequence; none: fingerprint zero). A bit is 1 if it is set in
    over half of the shingles' XXH64 values (seed 42).
    """
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    total = len(words) - k + 1
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, total, WORDS_AT_ONCE):
        part = words[first : first + WORDS_AT_ONCE + k - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter((len(w) + 1 for w in part), np.int64, len(part))) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        hashes = np.fromiter(
            (digest(line[s:e], 42) for s, e in zip(begins[: len(part) - k + 1].tolist(), ends[k - 1 :].tolist())),
            np.uint64,
            len(part) - k + 1,
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > total).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle_words: int = 3) -> DataFrame:
    """``docs`` with the SimHash of ``text`` as a signed long; null: empty text."""

    @F.arrow_udf("long")
    def simhash(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            values = np.zeros(len(texts), np.uint64)
            for first, held in slices(texts):
                values[first : first + len(held)] = [fingerprint(t, shingle_words) for t in held]
            yield pa.array(values.view(np.int64))

    return docs.withColumn(out, simhash(F.col(text)))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The masks (unsigned) of the covering tables for ``radius``."""
    n = (1 << (radius + 1)) - 1
    position = [1 + i % n for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (position[i] & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a, b) -> np.ndarray:
    """Differing bits of signed 64-bit values."""
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a negative number numpy counts the absolute value's bits


def link_fingerprints(fps: DataFrame, radius: int = 3, fp: str = "fp", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``radius``.

    ``fps`` holds distinct fingerprints. Empty input gives no rows.
    """
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("tab"), F.col(fp).bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)])
    rows = fps.select(F.col(fp).alias("fp"), F.explode(tables).alias("x")).select(F.col("x.tab").alias("tab"), F.col("x.key").alias("key"), "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(
        rows.repartition(parts, "tab", "key").sortWithinPartitions("tab", "key", "fp").mapInArrow(_bucket_links(radius, bucket_rows), "a long, b long, tab int"),
        "simhash-links",
    )
    direct = found.where("tab < 0").select("a", "b")
    large = found.where("tab >= 0").select(F.col("a").alias("fp"), "tab")
    if not large.take(1):
        return direct.distinct()
    return direct.unionByName(_hub_links(large, masks, radius)).distinct()


def _bucket_links(radius: int, bucket_rows: int):
    """Sorted (tab, key, fp) rows to links (tab -1) and members of large buckets (tab >= 0, b is null)."""

    def forest(group: np.ndarray, a: list, b: list) -> None:
        rest = group
        while len(rest) > 1:
            todo, rest = [rest[0]], rest[1:]
            while todo and len(rest):
                x = todo.pop()
                near = _distance(rest, x) <= radius
                if near.any():
                    got = rest[near]
                    rest = rest[~near]
                    a.extend([x] * len(got))
                    b.extend(got.tolist())
                    todo.extend(got)

    def emit(a, b, tab) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tab, pa.int32())], ["a", "b", "tab"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key, spilled = [], None, False  # the bucket that the batch's end left open

        def close(a, b):
            if held and not spilled:
                forest(np.concatenate(held), a, b)

        for batch in batches:
            if not batch.num_rows:
                continue
            tab, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((tab[1:] != tab[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = np.concatenate(([0], cuts, [len(fp)]))
            a, b = [], []
            sizes = np.diff(bounds)
            # complete buckets of two, all at once
            pairs = bounds[1:-2][sizes[1:-1] == 2] if len(sizes) > 2 else np.empty(0, np.int64)
            hit = pairs[_distance(fp[pairs], fp[pairs + 1]) <= radius] if len(pairs) else pairs
            a.extend(fp[hit].tolist())
            b.extend(fp[hit + 1].tolist())
            todo = [i for i in np.flatnonzero(sizes > 2).tolist() if 0 < i < len(sizes) - 1]
            for i in sorted({0, len(sizes) - 1, *todo}):
                s, e = int(bounds[i]), int(bounds[i + 1])
                if 0 < i < len(sizes) - 1:
                    group, this = [fp[s:e]], None
                    if e - s > bucket_rows:
                        yield emit(fp[s:e], [None] * (e - s), [tab[s]] * (e - s))
                    else:
                        forest(group[0], a, b)
                    continue
                this = (int(tab[s]), int(key[s]))
                if this != held_key:
                    close(a, b)
                    held, held_key, spilled = [], this, False
                if spilled:
                    yield emit(fp[s:e], [None] * (e - s), [this[0]] * (e - s))
                    continue
                held.append(fp[s:e].copy())
                if sum(map(len, held)) > bucket_rows:
                    group = np.concatenate(held)
                    yield emit(group, [None] * len(group), [this[0]] * len(group))
                    held, spilled = [], True
            if a:
                yield emit(a, b, np.full(len(a), -1, np.int32))
        a, b = [], []
        close(a, b)
        yield emit(a, b, np.full(len(a), -1, np.int32))

    return run


def _hub_links(members: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links of large buckets through hubs: linear in the bucket's rows."""
    near, far = radius // 2, radius - radius // 2

    def around(mask: int):
        free = [i for i in range(BITS) if not mask >> i & 1]
        return F.array(
            *[
                F.struct(F.lit(_signed(sum(1 << i for i in s))).alias("d"), F.lit(n <= near).alias("close"))
                for n in range(far + 1)
                for s in combinations(free, n)
            ]
        )

    links = None
    for t, mask in enumerate(masks):
        own = members.where(F.col("tab") == t).select("fp", F.explode(around(mask)).alias("x"))
        hubs = own.select("fp", F.col("fp").bitwiseXOR(F.col("x.d")).alias("hub"), F.col("x.close").alias("close"))
        centre = hubs.where("close").groupBy("hub").agg(F.min("fp").alias("centre"))
        got = hubs.join(centre, "hub").where("fp != centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()
        links = got if links is None else links.unionByName(got)
    return links


def components(docs: DataFrame, doc_id: str, text: str, shingle_words: int, radius: int) -> DataFrame:
    """(doc_id, hash, fp, root): one row per input row; ``hash`` of the text, ``root`` names the component."""
    rows = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle_words=shingle_words)
    rows = stage(rows.select("doc_id", F.xxhash64(text_of(F.col("text"))).alias("hash"), "fp"), "simhash-fps")
    fps = rows.select("fp").distinct()
    nodes = connected_components(link_fingerprints(fps, radius))
    # fingerprints without a link are components of their own
    return rows.join(nodes, rows["fp"] == nodes["node"], "left").select("doc_id", "hash", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Documents link when their fingerprints differ in ``radius`` bits or
    fewer; ``component_id`` is the smallest doc_id reachable, the own one
    included. Null and empty texts share fingerprint zero and link like any
    other. Repeated rows and repeated ids stay (one row each). A null id is
    never the smallest; a component of null ids only has a null
    ``component_id``. An empty table gives no rows; other columns are ignored.
    """
    rows = stage(components(docs, doc_id, text, shingle_words, radius), "simhash-components")
    least = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the smallest id's (a null
    id only if there is no other), of equal ids the one whose text hashes
    lowest. Rows equal in id and text are one document, of which one row stays."""
    rows = stage(components(docs, doc_id, text, shingle_words, radius), "simhash-components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash"))
    kept = rows.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.hash").alias("_hash"))
    held = docs.join(kept, docs[doc_id].eqNullSafe(kept["_id"]) & (F.xxhash64(text_of(docs[text])) == kept["_hash"]), "left_semi")
    if rows.groupBy("doc_id", "hash").count().where("count > 1").take(1):
        return held.dropDuplicates([doc_id, text])
    return held
