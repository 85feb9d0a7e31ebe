"""Alignment of two tokenizers' tokens, and how often their ids are linked.

Both tokenizers cut the same bytes (a blank and the text). Every token points to
its farthest-right overlapping token: the token of the other side that holds its
last byte. Doubling these pointers (``next = next[next]``, all tokens of a slab at
once) ends, for every token, at the last token of its connected component, which is
the component's label: a component is a group of the alignment, and its last tokens
on both sides end together and are linked.

Both tokenizers begin a new token where white space begins after something else
with a blank or a line feed (checked on the piece vocabulary when it is loaded), so
a text is cut there and each different unit of a slab (about ``SLAB_BYTES`` of text) is
encoded and aligned once; a document's groups are its units' groups in order.

How often two ids are linked in the whole corpus is counted per slab, then over all
slabs. What a document needs of these counts is looked up per slab: the slab's pairs
are joined with the counts by id pair, and slab by slab they meet the slab's
documents. No table of pairs is broadcast or collected, and a task holds one slab.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, sums
from .packing import encoder

BYTES_TOKENIZER, PIECES_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLAB_BYTES = 4 << 20
BLANK = "▁"  # stands for a blank in pieces
# White space that begins with a blank or a line feed, after something else.
UNIT = re.compile(r"(?<=\S)(?=[ \n])")


class Pieces:
    """The piece tokenizer: ids of a unit, and each id's bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        self.blank = self.model.piece_to_id(BLANK)
        # a cut before a blank or around a line feed must not part a piece
        self.cuts = not any("\n" in p or re.search(f"[^{BLANK}]{BLANK}", p) for p in names) and self.raw[self.blank] == b" "

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units that begin with a blank (which the model adds by itself) or a line feed."""
        out = self.model.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [[self.blank] if u == " " else ids if u[0] == " " else ids[1:] for u, ids in zip(units, out)]


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(2)
def byte_ids(path: str):
    """(ids of a unit, length of each id in bytes) of the byte-level tokenizer; special tokens are plain text."""
    coder = encoder(path)
    whole, single = coder.encode_ordinary, coder._core_bpe.encode_single_piece
    lengths = np.zeros(coder.n_vocab + 1, np.int64)
    for raw in coder.token_byte_values():
        lengths[coder.encode_single_token(raw)] = len(raw)

    def ids(unit: str) -> list[int]:
        return single(unit.encode()) if unit[0] == " " and unit[1:].isalpha() else whole(unit)  # letters after a blank are one match of the pattern

    return ids, lengths


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For every token, first those of A, then those of B: the last A token of its component.

    Ends are byte offsets, rising, and both sides end at the same byte.
    """
    n = len(a_ends)
    right_of_a = np.searchsorted(b_ends, a_ends)  # the B token that holds the last byte
    right_of_b = np.searchsorted(a_ends, b_ends)
    to = np.concatenate([np.where(b_ends[right_of_a] == a_ends, np.arange(n), n + right_of_a), right_of_b])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


@dataclass
class Aligned:
    """Units in order: counts per unit, the linked pairs of all units (``pair``: an index into ``keys``), and their groups as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    keys: np.ndarray
    pair: np.ndarray
    text: list[str]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter((x for one in lists for x in one), np.int64)


def align(a: list[list[int]], b: list[list[int]], a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Alignment of units whose ids on both sides spell the same bytes. A link's key is A's id * 2^32 + B's id."""
    n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    a_ids, b_ids = _flat(a), _flat(b)
    a_ends, b_ends = np.cumsum(a_lengths[a_ids]), np.cumsum(b_lengths[b_ids])
    n = len(a_ids)
    label = groups(a_ends, b_ends)
    last = np.concatenate([label[:n] == np.arange(n), b_ends == a_ends[label[n:]]])
    edges_a, edges_b = (np.concatenate(([0], np.cumsum(x))) for x in (n_a, n_b))
    n_links = sums(last[:n], edges_a)
    linked = np.flatnonzero(last[:n])
    keys, pair = np.unique(a_ids[linked] << 32 | b_ids[np.flatnonzero(last[n:])], return_inverse=True)
    # tokens in the order of the text form: by group, A before B
    order = np.argsort(label * 2 + (np.arange(len(label)) >= n), kind="stable")
    names = np.array(list(map(str, np.concatenate([a_ids, b_ids])[order].tolist())), object)
    sign = np.where(last[order], np.where(order < n, "|", ";"), ",").astype(object)
    marked = (names + sign).tolist()
    edges = (edges_a + edges_b).tolist()
    return Aligned(n_a, n_b, n_links, keys, pair, ["".join(marked[s:e]) for s, e in zip(edges, edges[1:])])


DOC_SCHEMA = "slab long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, key long, n long"


class Slab:
    """The alignment of the texts of one slab."""

    def __init__(self, texts: list[bytes], a_path: str, b_path: str):
        piece = pieces(b_path)
        byte, a_lengths = byte_ids(a_path)
        b_lengths = np.array(list(map(len, piece.raw)))
        units = [self._units(raw, piece.cuts) for raw in texts]
        number: dict[str, int] = {}
        ids = [[number.setdefault(u, len(number)) for u in us] for us in units]
        bad = self._encode(list(number), byte, piece)
        for i, own in enumerate(ids):
            if bad and not bad.isdisjoint(own):  # a unit does not come back: the text as a whole
                whole = "".join(units[i])
                at = number.setdefault(whole, len(number))
                if at == len(self.a):
                    a, b = byte(whole), piece.model.encode(whole[1:])
                    if b"".join([piece.raw[x] for x in b]) != whole.encode():
                        a, b = [], []
                    self.a.append(a)
                    self.b.append(b)
                ids[i] = [at]
        for at in bad:
            self.a[at], self.b[at] = [], []
        self.units = ids
        self.aligned = align(self.a, self.b, a_lengths, b_lengths)

    @staticmethod
    def _units(raw: bytes, cuts: bool) -> list[str]:
        try:
            text = raw.decode()
        except UnicodeDecodeError:  # its tokens cannot spell it
            return []
        return (UNIT.split(" " + text) if cuts else [" " + text]) if text else []

    def _encode(self, units: list[str], byte, piece: Pieces) -> set[int]:
        self.a, self.b = [byte(u) for u in units], piece.encode(units) if units else []
        raw = piece.raw
        return {i for i, (u, ids) in enumerate(zip(units, self.b)) if b"".join([raw[x] for x in ids]) != u.encode()}

    def rows(self, slab: int, doc_ids: pa.Array) -> pa.RecordBatch:
        """A row per document, and one per linked pair of the slab (``key``, ``n``)."""
        al, n = self.aligned, len(self.units)
        flat = _flat(self.units)
        edges = np.concatenate(([0], np.cumsum([len(u) for u in self.units]))).astype(np.int64)
        totals = [sums(x[flat], edges) for x in (al.n_a, al.n_b, al.n_links)]
        text = al.text
        shas = []
        for own in self.units:
            joined = "".join([text[u] for u in own])
            shas.append(hashlib.sha256(joined[:-1].encode()).hexdigest() if joined else "")
        links = al.n_links[flat]
        first = np.concatenate(([0], np.cumsum(al.n_links)))[:-1][flat] - (np.cumsum(links) - links)
        pair = al.pair[np.repeat(first, links) + np.arange(int(links.sum()))]
        owner = np.repeat(np.repeat(np.arange(n), np.diff(edges)), links)
        width = max(1, len(al.keys))
        held, times = np.unique(owner * width + pair, return_counts=True)
        ends = np.searchsorted(held, np.arange(n + 1) * width)
        at, times = (held % width).astype(np.int32), times.astype(np.int32)
        cut = [(s, e) for s, e in zip(ends, ends[1:])]
        used, per_key = np.unique(at, return_inverse=True)
        at = per_key.astype(np.int32)  # pairs that some document has, in order of their keys
        keys, counts = al.keys[used], np.bincount(per_key, weights=times, minlength=len(used)).astype(np.int64)
        k = len(keys)
        none, zero = pa.nulls, np.full(n + k, slab, np.int64)

        def padded(values: pa.Array, kind: pa.DataType) -> pa.Array:
            return pa.concat_arrays([values.cast(kind), none(k, kind)])

        columns = [pa.array(zero), padded(doc_ids, pa.int64()), *[padded(pa.array(t, pa.int64()), pa.int64()) for t in (*totals, totals[2])]]
        columns.append(padded(pa.array(shas, pa.string()), pa.string()))
        columns += [padded(pa.array([x[s:e].tobytes() for s, e in cut], pa.binary()), pa.binary()) for x in (at, times)]
        columns += [pa.concat_arrays([none(n, pa.int64()), pa.array(x, pa.int64())]) for x in (keys, counts)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in DOC_SCHEMA.split(", ")])


def aligned_slabs(docs: DataFrame, doc_id: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """``DOC_SCHEMA``, written: a row per document and one per slab and linked pair."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, part in slices(batch.column(1), SLAB_BYTES):
                yield Slab(part, a_path, b_path).rows(slab, batch.column(0).slice(first, len(part)))
                slab += 1

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(read, DOC_SCHEMA), "aligned-slabs")


def pair_counts(slabs: DataFrame) -> DataFrame:
    """(key, count, best): corpus-wide links of every id pair; ``best``: no other A id is linked with its B id more often."""
    counts = slabs.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("key").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("key", "count", (F.col("count") == F.col("most")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_tokenizers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per input row.

    Null and empty texts, and texts that the tokens of a side do not spell
    (one with U+2581), have no tokens: zeros and ''. Repeated rows and ids stay
    and count; an empty table gives no rows; other columns are ignored. A very
    long text is a slab of its own, held whole by its task.
    """
    a_path, b_path = a_path or public_tokenizers.path(BYTES_TOKENIZER), b_path or public_tokenizers.path(PIECES_TOKENIZER)
    slabs = aligned_slabs(docs, doc_id, text, a_path, b_path)
    rows = slabs.where(F.col("key").isNull()).select("slab", *[c.split()[0] for c in DOC_SCHEMA.split(", ")[1:9]])
    known = slabs.where(F.col("key").isNotNull()).select(F.col("slab").alias("of_slab"), "key").join(pair_counts(slabs), "key")

    def total(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("key")
        count, best = pairs["count"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
        at = docs["pairs"].to_pylist()
        edges = np.concatenate(([0], np.cumsum([len(x) // 4 for x in at]))).astype(np.int64)
        own = np.frombuffer(b"".join(at), np.int32)
        times = np.frombuffer(b"".join(docs["times"].to_pylist()), np.int32).astype(np.int64)
        columns = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        columns["n_best"] = pa.array(sums(best[own] * times, edges), pa.int64())
        columns["count_sum"] = pa.array(sums(count[own] * times, edges), pa.int64())
        return pa.table(columns | {"groups_sha256": docs["groups_sha256"]})

    return rows.groupBy("slab").cogroup(known.groupBy("of_slab")).applyInArrow(total, RESULT)
