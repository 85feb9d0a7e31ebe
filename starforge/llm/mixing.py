"""Mixing sources to target weights, with Spark expressions only.

The words of a source, document after document, are one stream, cut into blocks
of ``block_words``. Each output shard draws its slots' sources from a
multinomial of the targets (one pseudorandom number per slot). The n-th slot of
a source takes the block at the n-th place of the source's pseudorandom
permutation; each further pass over the source (epoch) has a permutation of its
own. Slots and blocks are joined by block index. The result is spans: which
words of which document stand where in the mix.

Random draws alone would leave a source some slots above or below its target.
Slots that a source drew beyond its target are handed, in order, to the sources
that drew too few, so every source gets exactly its slots, and its last slot is
cut at its target: the words taken of a source are its rounded target, and no
document is read more often than ``max_epochs`` times.

Nothing here depends on partitions, so reruns agree. Only one row per source
(word count and slots drawn) comes to the driver; a weight belongs to each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACES, WORD, prefix_sums, stage, text_of

WEIGHTS = (5.0, 2.0, 1.0)
ROUNDS = 24  # of the swap-or-not permutation
CHUNK_ROWS = 10_000  # documents whose sizes one task adds up in order
SPARE = (1 << 62) - 1


@dataclass
class Source:
    """One source's part of the plan."""

    name: str | None
    words: int
    target: float = 0.0
    slots: int = 0
    blocks: int = 0

    def taken(self) -> int:
        return round(self.target)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. (Words shrink to one letter each, spaces vanish.)"""
    ones = F.regexp_replace(text_of(text), WORD, "x")
    return F.length(F.translate(ones, " \t\n\x0b\f\r", "")).cast("long")


def targets(words: list[int], weights: tuple[float, ...], share: float, max_epochs: float) -> list[float]:
    """Words wanted of each source: ``share`` of all words by weight, at most
    ``max_epochs`` times the source, the excess dealt again among the others."""
    weight = [weights[i % len(weights)] for i in range(len(words))]
    limit = [max_epochs * n for n in words]
    left, out, free = share * sum(words), [0.0] * len(words), set(range(len(words)))
    while free:
        unit = left / sum(weight[i] for i in free)
        full = [i for i in free if unit * weight[i] > limit[i]]
        for i in full or free:
            out[i] = limit[i] if full else unit * weight[i]
        if not full:
            break
        left -= sum(limit[i] for i in full)
        free -= set(full)
    return out


def sized(docs: DataFrame, doc_id: str, source: str, text: str) -> tuple[DataFrame, list[Source]]:
    """Rows (doc_id, source, size, hash) with their source's index, and the sources in order."""
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text_of(F.col(text))).alias("hash")), "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("words")).collect()
    sources = sorted((Source(r["source"], r["words"]) for r in found), key=lambda s: (s.name is None, s.name or ""))
    return rows, sources


def plan(sources: list[Source], weights: tuple[float, ...], share: float, max_epochs: float, block_words: int) -> list[Source]:
    """Targets, blocks and slots of every source."""
    for s, t in zip(sources, targets([s.words for s in sources], weights, share, max_epochs)):
        s.target = t
        s.blocks = -(-s.words // block_words)
        passes, rest = divmod(s.taken(), s.words) if s.words else (0, 0)
        s.slots = passes * s.blocks + -(-rest // block_words)
    return sources


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _pick(x: Column, bounds: list, kind: str) -> Column:
    """Index of the interval that holds ``x``: how many upper bounds are not above it."""
    return F.size(F.filter(_array(bounds, kind), lambda b: b <= x))


def _running(values) -> list:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``index`` in a pseudorandom permutation of 0 .. n - 1 (swap-or-not rounds)."""

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(key, r).bitwiseAND(F.lit(SPARE)) % n - x, n)
        swap = F.xxhash64(key, r, F.greatest(x, other), F.lit(1)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)).otherwise(index)


def draw_slots(spark: SparkSession, sources: list[Source], block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, sid, epoch, block, words): every output slot and its block.

    ``words`` is how many words of the block the slot takes at most.
    """
    total = sum(s.slots for s in sources)
    edges = [b / max(1, total) for b in _running(s.slots for s in sources)]
    slots = spark.range(total).select(F.floor(F.col("id") / F.lit(shard_slots)).alias("shard"), F.col("id").alias("slot"))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "slot"), 11) / F.lit(float(1 << 53))
    slots = slots.withColumn("drawn", F.least(_pick(u, edges, "double"), F.lit(max(0, len(sources) - 1))))
    counts = stage(slots.groupBy("shard", "drawn").agg(F.count(F.lit(1)).alias("n")), "mix-draws")
    got = {r["drawn"]: r["n"] for r in counts.groupBy("drawn").agg(F.sum("n").alias("n")).collect()}
    got = [got.get(i, 0) for i in range(len(sources))]
    # place of each slot among its source's: earlier shards first, then the order in its own
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(W.partitionBy("drawn").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.row_number().over(W.partitionBy("shard", "drawn").orderBy("slot")) - 1
    placed = slots.withColumn("own", own).join(ahead, ["shard", "drawn"]).withColumn("n", F.col("ahead") + F.col("own"))
    # slots beyond a source's target go to the sources that drew too few
    want = [s.slots for s in sources]
    spare_before = [0, *_running(max(0, g - w) for g, w in zip(got, want))]
    lack_upto = _running(max(0, w - g) for g, w in zip(got, want))
    at = lambda values, i: F.element_at(_array(values, "bigint"), i + 1)
    spare = F.col("n") - at(want, F.col("drawn"))
    rank = at(spare_before, F.col("drawn")) + spare
    given = placed.withColumn("rank", F.when(spare >= 0, rank)).withColumn("sid", F.when(F.col("rank").isNull(), F.col("drawn")).otherwise(_pick(F.col("rank"), lack_upto, "bigint")))
    given = given.withColumn(
        "n",
        F.when(F.col("rank").isNull(), F.col("n")).otherwise(
            at(got, F.col("sid")) + F.col("rank") - at([0, *lack_upto], F.col("sid"))
        ),
    )
    blocks = at([max(1, s.blocks) for s in sources], F.col("sid"))
    # all blocks but the source's last, shorter one are permuted; that one ends each pass
    given = given.withColumns({"epoch": F.floor(F.col("n") / blocks), "i": F.col("n") % blocks, "whole": blocks - 1})
    key = F.xxhash64(F.lit(seed), F.lit("pass"), "sid", "epoch")
    given = given.withColumn("key", key)
    block = F.when(F.col("i") == F.col("whole"), F.col("i")).otherwise(permuted(F.col("i"), F.col("whole"), F.col("key")))
    end = [s.taken() % s.words if s.words else 0 for s in sources]
    last = F.col("n") == at(want, F.col("sid")) - 1
    cut = at(end, F.col("sid")) - F.col("i") * block_words
    words = F.when(last & (at(end, F.col("sid")) > 0), F.least(F.lit(block_words), cut)).otherwise(F.lit(block_words))
    return given.select("shard", "slot", "sid", "epoch", block.alias("block"), words.cast("long").alias("words"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    max_epochs: float = 2.0,
    block_words: int = 512,
    shard_slots: int = 4096,
    seed: int = 20240501,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans) of the mix.

    ``weights`` go to the sources by code point, null last, repeating.
    documents: doc_id, source, size (words), hash (of the text), sid, start
    (its first word in the source's stream), source_size, target. spans:
    shard, slot, epoch, sid, start, from_word, n_words: the mix's words in
    order of (shard, slot, from the block's first word), each span inside one
    document.

    Null and empty texts have no words, hence no span. A source without words
    has target 0. Repeated rows are documents of their own; equal ids follow
    each other by size and text hash. Empty tables give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    rows, sources = sized(docs, doc_id, source, text)
    plan(sources, weights, share, max_epochs, block_words)
    sid = F.array_position(_array([s.name for s in sources if s.name is not None], "string"), F.col("source")) - 1
    null_sid = sum(s.name is not None for s in sources)
    rows = rows.withColumn("sid", F.coalesce(sid, F.lit(null_sid)).cast("int"))
    chunks = max(1, math.ceil(rows.count() / CHUNK_ROWS))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    per_source = _array([s.words for s in sources], "bigint"), _array([s.target for s in sources], "double")
    placed = prefix_sums(rows, "sid", "chunk", [F.col("doc_id"), F.col("size"), F.col("hash")], "size", "start")
    documents = stage(
        placed.select("doc_id", "source", "size", "hash", "sid", "start", F.element_at(per_source[0], F.col("sid") + 1).alias("source_size"), F.element_at(per_source[1], F.col("sid") + 1).alias("target")),
        "mix-documents",
    )
    b = F.lit(block_words)
    parts = documents.where("size > 0").select(
        "sid", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block")
    )
    begin = F.greatest(F.col("start"), F.col("block") * b)
    held = parts.select("sid", "start", "block", (begin - F.col("start")).alias("from_word"), (begin - F.col("block") * b).alias("skip"), (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b) - begin).alias("n_words"))
    slots = draw_slots(spark, sources, block_words, shard_slots, seed)
    spans = slots.join(held, ["sid", "block"]).withColumn("n_words", F.least(F.col("n_words"), F.col("words") - F.col("skip"))).where("n_words > 0")
    return documents, spans.select("shard", "slot", "epoch", "sid", "start", "from_word", "n_words")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per input row."""
    documents, spans = mix_sources(docs)
    taken = spans.groupBy("sid", "start").agg(F.sum("n_words").alias("taken"))
    worded = documents.where("size > 0").join(taken, ["sid", "start"], "left")
    rows = worded.unionByName(documents.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row per span, in the columns of ``docs``.

    ``text`` is the span's words with the white space between them;
    ``n_chars`` (if there is such a column) its length; the other columns are
    the document's. Rows that are equal in id, source and text share their
    spans' other columns with each other (any of them).
    """
    documents, spans = mix_sources(docs, **options)
    named = spans.join(documents.where("size > 0").select("sid", "start", F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("hash").alias("_hash")), ["sid", "start"])
    by_text = named.groupBy("_id", "_source", "_hash").agg(F.collect_list(F.struct("from_word", "n_words")).alias("_spans"))
    columns = docs.columns
    rows = docs.withColumn("_hash", F.xxhash64(text_of(F.col("text"))))
    repeated = documents.groupBy("doc_id", "source", "hash").count().where("count > 1").take(1)
    once = rows.dropDuplicates(["doc_id", "source", "_hash"]) if repeated else rows
    wanted = once.join(by_text, once["doc_id"].eqNullSafe(by_text["_id"]) & once["source"].eqNullSafe(by_text["_source"]) & (once["_hash"] == by_text["_hash"]))
    # each word with the white space after it (and, for the first, before it)
    words = F.regexp_extract_all(F.col("text"), F.lit(f"(?:^[{SPACES}]+)?{WORD}[{SPACES}]*"), F.lit(0))
    cut = wanted.select(*[once[c] for c in columns], words.alias("_words"), F.explode("_spans").alias("_span"))
    text = F.array_join(F.slice("_words", F.col("_span.from_word").cast("int") + 1, F.col("_span.n_words").cast("int")), "")
    out = cut.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)

