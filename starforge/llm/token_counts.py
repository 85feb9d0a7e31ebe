"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. A node's failure link says where matching
goes on once the longest pieces that begin its string are popped, and its pop
count says how many pieces that were, so a word is counted in one pass over its
bytes and no piece is ever built. A word begins with a blank in the vocabulary
(``b" word"``); what follows a popped piece is matched from the same trie.

The automaton is three integer arrays whose size is the vocabulary's; they are
built on the driver and broadcast. All words of a slice step through it at once,
one byte position at a time, each distinct word once; the last few, long words are
walked one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, sums

VOCABULARY = "byte_bpe_50k.tiktoken"
FEW_WORDS = 64  # so many words left are walked one by one: an array step costs as much as some hundred plain ones


@dataclass
class Automaton:
    """``keys``/``to``: trie edges, sorted by node * 256 + byte; ``fail``, ``pops`` by
    node (fail -1: no piece begins the string); ``ends``: pops that empty a node
    (-1: impossible). Node 0 is the root."""

    keys: np.ndarray
    to: np.ndarray
    fail: np.ndarray
    pops: np.ndarray
    ends: np.ndarray

    @cached_property
    def plain(self) -> tuple[dict[int, int], list[int], list[int]]:
        """(edges, fail, pops) as Python objects, for the last few long words of a slice."""
        return dict(zip(self.keys.tolist(), self.to.tolist())), self.fail.tolist(), self.pops.tolist()

    def walk(self, node: int, raw: bytes) -> tuple[int, int] | None:
        """(last node, pieces popped) of stepping through ``raw`` byte by byte; None if it cannot be split."""
        edges, fail, pops = self.plain
        child, count = edges.get, 0
        for byte in raw:
            to = child(node << 8 | byte)
            while to is None:
                if node == 0 or fail[node] < 0:
                    return None
                count += pops[node]
                node = fail[node]
                to = child(node << 8 | byte)
            node = to
        return node, count

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child of each node by its byte, -1 where there is none."""
        want = node.astype(np.int64) * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.to[at], -1)


def read_vocabulary(path: str | None = None) -> list[bytes]:
    """Pieces of a ranks file (base64 piece and rank in each line)."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def build(vocabulary: list[bytes]) -> Automaton:
    """The automaton of a vocabulary; empty pieces are ignored."""
    children: list[dict[int, int]] = [{}]
    piece = [False]
    for word in vocabulary:
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                piece.append(False)
            node = children[node][byte]
        piece[node] = bool(word)
    n = len(children)
    fail, pops = [-1] * n, [0] * n
    todo, order = [0], []
    while todo:
        order += todo
        todo = [c for node in todo for c in children[node].values()]
    for node in order:
        for byte, child in children[node].items():
            if piece[child]:
                fail[child], pops[child] = 0, 1
                continue
            at, popped = fail[node], pops[node]
            while at != -1 and byte not in children[at]:
                popped += pops[at]
                at = fail[at]
            fail[child], pops[child] = (children[at][byte], popped) if at != -1 else (-1, 0)
    ends = [0] * n
    for node in order[1:]:
        ends[node] = -1 if fail[node] == -1 or ends[fail[node]] == -1 else pops[node] + ends[fail[node]]
    edges = sorted((node * 256 + byte, child) for node, kids in enumerate(children) for byte, child in kids.items())
    keys, to = (np.array(x, np.int64) for x in zip(*edges)) if edges else (np.array([-1]), np.array([-1]))
    return Automaton(keys, to, np.array(fail, np.int32), np.array(pops, np.int32), np.array(ends, np.int32))


def piece_counts(a: Automaton, words: list[bytes]) -> np.ndarray:
    """Greedy longest-match pieces of each word; a word that cannot be split is 1 piece."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(words) else lengths
    node, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    stuck = np.zeros(len(words), bool)
    live = np.argsort(-lengths, kind="stable")
    for i in range(int(lengths.max(initial=0))):
        live = live[: np.searchsorted(-lengths[live], -i)]
        live = live[~stuck[live]]
        if len(live) <= FEW_WORDS:
            for w in live.tolist():
                end = a.walk(int(node[w]), raw[starts[w] + i : starts[w] + lengths[w]].tobytes())
                stuck[w] = end is None
                if end:
                    node[w] = end[0]
                    count[w] += end[1]
            break
        todo = live
        while len(todo):
            to = a.step(node[todo], raw[starts[todo] + i])
            went = to >= 0
            node[todo[went]] = to[went]
            todo = todo[~went]
            back = a.fail[node[todo]]
            none = (back < 0) | (node[todo] == 0)
            stuck[todo[none]] = True
            todo, back = todo[~none], back[~none]
            count[todo] += a.pops[node[todo]]
            node[todo] = back
    ends = a.ends[node]
    return np.where(stuck | (ends < 0), 1, count + ends)


def with_token_counts(docs: DataFrame, vocabulary: list[bytes], text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with struct<n_words, n_tokens> of ``text`` (null: 0, 0).

    Words are split at ASCII white space; each is matched as a blank and the
    word's bytes. A word that the vocabulary cannot split counts as one
    (unknown) token.
    """
    held = docs.sparkSession.sparkContext.broadcast(build(vocabulary))

    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint>")
    def counted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = held.value
        for texts in parts:
            n_words, n_tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for first, part in slices(texts):
                words = [t.split() for t in part]
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64)
                each = piece_counts(automaton, [b" " + w for w in number])
                edges = np.concatenate(([0], np.cumsum([len(ws) for ws in words])))
                n_words[first : first + len(part)] = np.diff(edges)
                n_tokens[first : first + len(part)] = sums(each[ids], edges)
            yield pa.StructArray.from_arrays([pa.array(n_words), pa.array(n_tokens)], ["n_words", "n_tokens"])

    return docs.withColumn(out, counted(F.col(text)))


def token_counts(docs: DataFrame, vocabulary_path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens: one row per input row.

    Null and empty texts count 0. Repeated rows and ids stay; an empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_token_counts(rows, read_vocabulary(vocabulary_path)).select("doc_id", "tokens.*")
