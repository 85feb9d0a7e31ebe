"""Document fingerprints: SimHash in Spark expressions, and exact radius search.

``fingerprint_rows`` explodes the words of a text, hashes each one and lets it
vote with a weight of its length. Two bit counters share one 64-bit sum (bits
``i`` and ``i + 32``; a text has fewer than 2**31 code points, so a counter
cannot run over), 32 sums per text in all. The sums are combined before the
shuffle, so one row per text and task moves, not one per word.

``search`` finds all fingerprints within a radius: 64 bits are cut into
``radius + 3`` blocks; for each choice of three blocks there is a table keyed by
those blocks' bits (one permuted copy of the fingerprints). Two fingerprints
within the radius agree in at least three whole blocks, so they meet in a table;
each pair is reported by the first table in which it meets, after an exact
distance check.

DataFrame operations only: no Python code runs on the executors.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stage, text_of, word_list

BITS = 64
LANES = 0x0000000100000001
LOWEST_ID = -(1 << 63)
# Documents of this many consecutive ids are put in order together.
ID_BITS = 8
LEVEL_BITS = 14


def fingerprint_rows(df: DataFrame, keys: list[str], words: str, out: str) -> DataFrame:
    """``keys`` and the SimHash (signed long) of the word array ``words``.

    A term's vote counts as its length in code points, repeats included; a
    bit is 1 if its weight is over half. No words: fingerprint 0. Rows with
    equal keys are one text.
    """
    terms = df.select(*keys, F.explode_outer(words).alias("_w"))
    hashed = terms.select(*keys, F.coalesce(F.xxhash64("_w"), F.lit(0)).alias("_h"), F.coalesce(F.length("_w"), F.lit(0)).cast("long").alias("_n"))
    votes = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(LANES)) * F.col("_n")).alias(f"_v{i}") for i in range(BITS // 2)]
    voted = hashed.groupBy(*keys).agg(F.sum("_n").alias("_all"), *votes)

    def bit(i: int) -> Column:
        lane = F.shiftrightunsigned(f"_v{i % 32}", 32) if i >= 32 else F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(lane * 2 > F.col("_all"), F.lit(_signed(1 << i))).otherwise(F.lit(0).cast("long"))

    return voted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), map(bit, range(BITS))).alias(out))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the differing bits estimate: 1 for equal fingerprints,
    0 from half of the bits on (unrelated texts)."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(math.pi / BITS)))


def search(queries: DataFrame, fps: DataFrame, radius: int = 3, fp: str = "fp") -> DataFrame:
    """(query, found, distance): all pairs of distinct fingerprints within ``radius``.

    Both tables hold a column ``fp``; repeats are collapsed first, so a hot
    group of copies is one row. A fingerprint finds itself. Null
    fingerprints find nothing; empty tables give no rows.
    """
    n = radius + 3
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(n)]
    masks = [_signed(sum(blocks[i] for i in chosen)) for chosen in combinations(range(n), 3)]
    tables = F.array(*[F.struct(F.lit(t).alias("tab"), F.col(fp).bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])

    def permuted(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(fp).where(F.col(fp).isNotNull()).distinct().select(F.col(fp).alias(name), F.explode(tables).alias("x"))
        return rows.select(name, "x.tab", "x.key")

    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    q, f = permuted(queries, "query"), permuted(fps, "found")
    met = q.join(f, (q["tab"] == f["tab"]) & (q["key"] == f["key"]) & (F.bit_count(differ) <= radius) & (first == q["tab"]))
    return met.select("query", "found", F.bit_count(differ).alias("distance"))


def next_smaller(values: DataFrame, col: str = "v", level: int = 0) -> DataFrame:
    """(v, next_v): for every distinct long its next smaller one; the smallest's is the largest.

    No global window: values are put in order inside groups of their upper
    bits, and the groups among themselves by the same rule, so one task
    orders at most 2**14 values.
    """
    v = values.select(F.col(col).alias("v")).distinct()
    if level * LEVEL_BITS >= 64 - ID_BITS:
        down = W.partitionBy(F.lit(0)).orderBy(F.desc("v"))
        return v.select("v", F.coalesce(F.lead("v").over(down), F.max("v").over(W.partitionBy(F.lit(0)))).alias("next_v"))
    v = stage(v.withColumn("g", F.shiftright("v", LEVEL_BITS)), "next-smaller")
    heads = v.groupBy("g").agg(F.max("v").alias("head"))
    step = next_smaller(heads, "g", level + 1).withColumnRenamed("v", "g")
    to = step.join(heads.withColumnRenamed("g", "next_v"), "next_v").select("g", "head")
    inside = v.select("g", "v", F.lead("v").over(W.partitionBy("g").orderBy(F.desc("v"))).alias("next_v"))
    return inside.join(to, "g").select("v", F.coalesce("next_v", "head").alias("next_v"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited copy of it.

    The edited copy's last floor(n / 2) code points are replaced by the first
    as many (or all) of the next document in descending doc_id; the last
    document's next one is the first. Returns doc_id, n_chars,
    edited_sha256, fp, edited_fp, next_fp (signed longs), one row per input row.

    A null text is empty. A null id counts as the smallest. Equal ids are put
    in order by their texts' hashes; rows equal in both are interchangeable
    (each has its own place). A table of one row is its own next document.
    An empty table gives no rows; other columns are ignored.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST_ID))
    rows = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), F.shiftright(key, ID_BITS).alias("chunk"), text_of(F.col(text)).alias("text"))
    follow = stage(next_smaller(rows, "chunk"), "next-chunk").withColumnRenamed("v", "chunk")
    down = W.partitionBy("chunk").orderBy(F.desc("key"), F.xxhash64("text"))
    ordered = rows.select("*", F.row_number().over(down).alias("place"), F.lead("text").over(down).alias("next_text"))
    heads = ordered.where("place = 1").select(F.col("chunk").alias("next_chunk"), F.col("text").alias("next_text"))
    inner = ordered.where("next_text is not null").withColumns({"next_chunk": F.col("chunk"), "next_place": F.col("place") + 1})
    last = ordered.where("next_text is null").drop("next_text").join(follow.withColumnRenamed("next_v", "next_chunk"), "chunk").join(heads, "next_chunk").withColumn("next_place", F.lit(1))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = inner.unionByName(last).select(
        "chunk",
        "place",
        "next_chunk",
        "next_place",
        "doc_id",
        n.cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    both = edited.select(
        "chunk",
        "place",
        "next_chunk",
        "next_place",
        "doc_id",
        "n_chars",
        F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("x"),
    )
    keys = ["chunk", "place", "next_chunk", "next_place", "doc_id", "n_chars", "sha", "kind"]
    words = both.withColumn("kind", F.col("x.kind")).withColumn("words", word_list(F.col("x.t")))
    each = fingerprint_rows(words, keys, "words", "fp")
    own = stage(
        each.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp")),
        "edited-fps",
    )
    nexts = own.select(F.col("chunk").alias("next_chunk"), F.col("place").alias("next_place"), F.col("fp").alias("next_fp"))
    return own.join(nexts, ["next_chunk", "next_place"]).select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fp", "edited_fp", "next_fp")


def fingerprint_report(docs: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near.

    ``n_near`` (null unless doc_id is divisible by 100, the query set): how
    many other documents have a fingerprint within ``radius`` bits. Nulls,
    ties and empty tables as in ``edited_fingerprints``.
    """
    own = stage(edited_fingerprints(docs), "fingerprints")
    copies = own.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = own.where(F.col("doc_id") % 100 == 0)
    near = search(asked, copies, radius).join(copies, F.col("found") == copies["fp"]).groupBy(F.col("query").alias("fp")).agg((F.sum("n") - 1).alias("n_near"))
    return own.join(near, "fp", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_digits(F.col("fp")).alias("fingerprint"),
        hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"),
    )
