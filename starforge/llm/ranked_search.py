"""Ranked lexical search of many items at once, shared parts computed once.

Items share terms. Their shared term sets are mined first: terms that occur in
exactly the same items form one set, then the pair of sets that most items hold
together becomes a set of its own, again and again while two items share a pair.
The result is a query-sharing graph: its leaves are terms, its inner nodes shared
sets, its tops the items, and an edge says whose sum takes part in whose.

A document's score for an item is a sum of integers, one per term, so the partial
sum of a shared set (its accumulator) is computed once per document and every
item above it adds it as a whole. Steps, per block of items:

1. every whole text is cut into terms once; a document keeps its length and the
   block's terms with their frequencies (written, then read twice);
2. document counts per term, number and total length of documents: partial sums
   per task, one row per term of the block to the driver;
3. each task fills the accumulators of some hundred documents at a time, level by
   level of the graph, and keeps each item's ``k`` best documents; those of all
   tasks are ranked per item, in two steps so that no task meets all tasks' rows.

Items are read in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS``
terms (a longer item is a block of its own); only one block is on the driver at a
time, and each block is matched against all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SLICE_BYTES, slices, stage

TOP = 50
BLOCK_ITEMS, BLOCK_TERMS = 1024, 50_000
# Which sums are shared, never what they are: an item's nodes held by most other
# items that take part in the search for pairs.
MINED_NODES = 48
CELLS = 4 << 20  # 64-bit accumulators a task holds at once
TASKS_TOGETHER = 256  # whose best documents are merged before all are ranked

# Term characters in UTF-8: ASCII letters (lower-cased) and digits, and every byte of another character.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, about ``SLICE_BYTES`` of it at a time."""
    clean = raw.translate(_TERM_BYTES)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + SLICE_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


@dataclass
class Graph:
    """Rows 0 .. n_terms - 1 are terms, then shared sets, then one row per item.

    A level is (rows, children, offsets): each row is the sum of its children,
    which are rows of earlier levels.
    """

    n_terms: int
    n_rows: int
    items: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def additions(self) -> int:
        return sum(len(children) - len(rows) for rows, children, _ in self.levels)

    def width(self) -> int:
        """Accumulators per document, with the largest level's children beside them."""
        return self.n_rows + max((len(c) for _, c, _ in self.levels), default=0)

    def sums(self, acc: np.ndarray) -> np.ndarray:
        """Item scores (items, documents); ``acc`` (n_rows, documents) holds the terms' rows."""
        for rows, children, offsets in self.levels:
            acc[rows] = np.add.reduceat(acc[children], offsets, axis=0)
        return acc[self.items]


def shared_sets(item_terms: list[list[int]], n_terms: int) -> Graph:
    """The query-sharing graph of items given as lists of different term numbers.

    An item without terms is a row that stays 0.
    """
    holders = defaultdict(list)
    for i, own in enumerate(item_terms):
        for t in own:
            holders[t].append(i)
    alike = defaultdict(list)  # items -> terms that exactly these items hold
    for t, own in holders.items():
        alike[tuple(own)].append(t)
    parts: list[tuple[int, ...]] = []  # children of each shared set
    held = [set() for _ in item_terms]
    support: dict[int, int] = {}
    for items, same in alike.items():
        nodes = same
        if len(items) > 1 and len(same) > 1:
            nodes = [n_terms + len(parts)]
            parts.append(tuple(same))
        for node in nodes:
            support[node] = len(items)
            for i in items:
                held[i].add(node)
    mined = [set(heapq.nsmallest(MINED_NODES, (n for n in own if support[n] > 1), key=lambda n: (-support[n], n))) for own in held]
    together: Counter = Counter()
    where = defaultdict(set)
    for i, own in enumerate(mined):
        ordered = sorted(own)
        for x, a in enumerate(ordered):
            where[a].add(i)
            for b in ordered[x + 1 :]:
                together[a, b] += 1
    heap = [(-n, pair) for pair, n in together.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        both = where[a] & where[b]
        if len(both) < 2:
            continue
        if len(both) < -n:  # other pairs have taken some of its items meanwhile
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        node = n_terms + len(parts)
        parts.append((a, b))
        beside: Counter = Counter()
        for i in both:
            for s in (mined[i], held[i]):
                s -= {a, b}
            beside.update(mined[i])
            for s in (mined[i], held[i]):
                s.add(node)
        where[a] -= both
        where[b] -= both
        where[node] = both
        for other, m in beside.items():
            if m > 1:
                heapq.heappush(heap, (-m, (other, node)))
    parts += [tuple(sorted(own)) for own in held]
    depth = {}
    by_depth = defaultdict(list)
    for i, children in enumerate(parts):
        node = n_terms + i
        depth[node] = 1 + max((depth.get(c, 0) for c in children), default=0)
        if children:
            by_depth[depth[node]].append((node, children))
    levels = []
    for d in sorted(by_depth):
        rows, children = zip(*by_depth[d])
        sizes = np.array([len(c) for c in children])
        levels.append((np.array(rows), np.array([c for cs in children for c in cs]), np.cumsum(sizes) - sizes))
    n_rows = n_terms + len(parts)
    return Graph(n_terms, n_rows, np.arange(n_rows - len(item_terms), n_rows), levels)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tfs), written: every document's length and its terms of ``vocabulary`` (32-bit numbers)."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most a block's terms

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        for batch in batches:
            for first, part in slices(batch.column(1)):
                lengths, found, times = [], [], []
                for raw in part:
                    n, hits = 0, np.zeros(0, np.int32)
                    for words in terms(raw):
                        n += len(words)
                        hits = np.concatenate([hits, np.array([i for i in map(number, words) if i is not None], np.int32)])
                    own, tf = np.unique(hits, return_counts=True)
                    lengths.append(n)
                    found.append(own.astype(np.int32).tobytes())
                    times.append(tf.astype(np.int32).tobytes())
                ids = batch.column(0).slice(first, len(part))
                yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), pa.array(found, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(read, "doc_id long, n long, terms binary, tfs binary"), "search-postings")


N_DOCS, N_TERMS = -1, -2


def statistics(posted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, documents per term of the block)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = length = 0
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            n = batch.column(0).to_numpy()
            docs, length = docs + int(np.count_nonzero(n)), length + int(n.sum())
            for part in np.array_split(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32), 8):
                df += np.bincount(part, minlength=n_terms)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[N_DOCS, N_TERMS], seen])), pa.array(np.concatenate([[docs, length], df[seen]]))], ["term", "n"])

    rows = posted.select("n", "terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row per term of the block
    got = {r["term"]: r["n"] for r in rows}
    return got.get(N_DOCS, 0), got.get(N_TERMS, 0), np.array([got.get(t, 0) for t in range(n_terms)], np.int64)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """Each item's ``k`` best (score, null id last, id) of what was given so far."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64)]  # item, score, null, id
        self.waiting: list[list[np.ndarray]] = []

    def give(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.floor[:, None])
        self.waiting.append([item, scores[item, at], null[at], ids[at]])
        if sum(len(w[0]) for w in self.waiting) > 4 * self.k * len(self.floor):
            self.merge()

    def merge(self) -> list[np.ndarray]:
        item, score, null, ids = (np.concatenate(x) for x in zip(self.rows, *self.waiting))
        self.waiting = []
        order = np.lexsort((ids, null, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.rows = [x[order] for x in (item, score, null, ids)]
        full = np.bincount(self.rows[0], minlength=len(self.floor)) == self.k
        last = np.searchsorted(self.rows[0], np.arange(len(full)), side="right") - 1
        self.floor[full] = self.rows[1][last[full]]
        return self.rows


def best_documents(posted: DataFrame, graph: Graph, weights: np.ndarray, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(item, doc_id, score): ``k`` best documents of every item of the block, scores above 0."""
    held = posted.sparkSession.sparkContext.broadcast((graph, weights))
    step = max(1, CELLS // graph.width())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = held.value
        best = Best(len(graph.items), k)
        for batch in batches:
            sizes = np.array([len(x) // 4 for x in batch.column(2).to_pylist()], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            found = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32)
            times = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).astype(np.int64)
            null = np.array(batch.column(0).is_null())
            ids, n = np.array(batch.column(0).fill_null(0)), np.array(batch.column(1))
            some = np.flatnonzero(sizes)
            for first in range(0, len(some), step):
                rows = some[first : first + step]
                own = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows])
                place = np.repeat(np.arange(len(rows)), sizes[rows])
                m = 50 + 50 * n[rows] * n_docs // n_words
                acc = np.zeros((graph.n_rows, len(rows)), np.int64)
                acc[found[own], place] = weights[found[own]] * (10**9 * times[own] // (1000 * times[own] + 20 * m[place]))
                best.give(graph.sums(acc), null[rows], ids[rows])
        item, got, none, doc = best.merge()
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=none), pa.array(got)], ["item", "doc_id", "score"])

    found = posted.mapInArrow(score, "item long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = found.withColumn("part", F.floor(F.spark_partition_id() / TASKS_TOGETHER))
    near = near.withColumn("rank", F.row_number().over(W.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return near.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Blocks of (item id, its different terms), streamed in order of the ids."""
    block, size = [], 0
    ordered = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).orderBy("item")
    for row in ordered.toLocalIterator():
        own = {t for words in terms((row["text"] or "").encode()) for t in words}
        if block and block[-1][0] == row["item"]:
            block[-1][1].update(own)
        else:
            if block and (len(block) == BLOCK_ITEMS or size + len(own) > BLOCK_TERMS):
                yield block
                block, size = [], 0
            block.append((row["item"], own))
        size += len(own)
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` highest-scoring documents with a score above 0.

    Rows of ``items`` with one item_id (nulls too) are one item with all their
    terms; an item without a term, or whose terms no document holds, has no
    rows. Null and empty texts have no terms. Repeated rows of ``docs`` are
    documents of their own; a null doc_id comes last among equal scores. Empty
    tables give no rows; other columns are ignored. A very long text is cut
    into terms about 2 MB at a time; what stays of it is at most one number
    pair per term of the block.
    """
    spark, out = docs.sparkSession, None
    kind = items.schema[item_id].dataType
    for block in item_blocks(items, item_id, item_text):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
        graph = shared_sets([sorted(vocabulary[t] for t in own) for _, own in block], len(vocabulary))
        posted = postings(docs, vocabulary, doc_id, text)
        n_docs, n_words, df = statistics(posted, len(vocabulary))
        weights = np.array([term_weight(n_docs, int(d)) for d in df], np.int64)
        found = best_documents(posted, graph, weights, n_docs, n_words, k)
        names = spark.createDataFrame([Row(item=i, item_id=name) for i, (name, _) in enumerate(block)], f"item long, item_id {kind.simpleString()}")
        rows = found.join(F.broadcast(names), "item").select("item_id", F.col("rank"), "doc_id", "score")  # at most BLOCK_ITEMS names
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out
