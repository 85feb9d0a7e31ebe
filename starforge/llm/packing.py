"""Best-fit packing by linear grouping.

Documents become token pieces; only their lengths' histogram (at most
``sequence_tokens`` rows, whatever the input) comes to the driver, where the plan is
made on counts:

1. Large pieces, longest first, form groups of equal cardinality; each group's
   lengths are rounded up to its longest, so few sizes remain.
2. Configurations of these few sizes are optimised one after another: the
   largest size left plus the best subset of the others (a bit-set dynamic
   programme over the capacity), repeated as often as the counts allow.
3. Actual pieces are substituted for the sizes: the n-th piece of a group
   takes the group's n-th place. The plan is a few intervals of ranks.
4. The space that is really left is counted per sequence (a histogram
   again), and the small pieces, longest first, go to the tightest space that
   holds them, whole ranges of sequences at a time; what fits nowhere opens
   new sequences.

Ranks, spaces and offsets are Spark jobs over the pieces; the intervals, whose
number does not depend on the input's size, are broadcast.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import prefix_sums, slices, stage

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE_TOKENS = 2048
SMALL = 384  # pieces up to this length are placed last, by best fit
GROUPS = 1024  # of equal cardinality among the larger ones
CHUNK_ROWS = 10_000  # pieces of one length that one task puts in order
CACHE_WORDS = 150_000  # words whose ids a task remembers (about 25 MB)
END = b"\0\0\0\0"  # id 0, after every document

@lru_cache(2)
def added_tokens(path: str) -> dict[str, int]:
    """The file's special tokens and their ids."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    special = {t["content"]: t["id"] for t in added if t.get("special")}
    odd = [t["content"] for t in added if t.get("special") and (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])]
    if odd:
        raise ValueError(f"special tokens that take more than their own text: {odd}")
    return special


@lru_cache(2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file (its ids are the merge ranks)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Words(dict):
    """Ids of a blank and a word, or of a word that begins with a line feed.

    None for a word that ends in white space (or is empty): the tokenizer may
    join it to what follows.
    """

    def __init__(self, path: str):
        super().__init__()
        self.encode = encoder(path).encode_ordinary
        self.one_token = encoder(path)._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes | None:
        if word.isalpha():  # letters after a blank are one match of the tokenizer's pattern
            ids = array("I", self.one_token(b" " + word.encode())).tobytes()
        elif word[:-1].isalpha() and word[-1] in ".,;:!?":
            ids = self[word[:-1]] + array("I", self.one_token(word[-1].encode())).tobytes()
        elif not word or word[-1].isspace():
            ids = None
        else:
            ids = array("I", self.encode(word if word[0] == "\n" else " " + word)).tobytes()
        if len(self) < CACHE_WORDS and len(word) < 64:
            self[word] = ids
        return ids


def token_ids(text: str, path: str, known: Words | None = None) -> bytes:
    """Little-endian unsigned 32-bit ids of a text, id 0 last.

    White space after something else always begins a token, so a text is cut
    before its blanks and line feeds and each word's ids are remembered. A
    text with a longer run of white space is encoded in one piece.
    """
    known = Words(path) if known is None else known
    first, *words = text.replace("\n", " \n").split(" ")
    ids = list(map(known.__getitem__, words))
    if None in ids or first[-1:].isspace():
        return array("I", known.encode(text)).tobytes() + END
    return array("I", known.encode(first)).tobytes() + b"".join(ids) + END


@lru_cache(2)
def special_split(path: str) -> re.Pattern | None:
    """A pattern that splits a text at the file's special tokens and keeps them (longer ones first)."""
    names = sorted(added_tokens(path), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def special_token_ids(text: str, path: str, known: Words | None = None) -> bytes:
    """``token_ids``, but a special token inside the text is its own id, as the tokenizers library has it by default."""
    split = special_split(path)
    if split is None or not split.search(text):
        return token_ids(text, path, known)
    ids = added_tokens(path)
    out = []
    for part in split.split(text):
        if part in ids:
            out.append(array("I", [ids[part]]).tobytes())
        elif part:
            out.append(token_ids(part, path, known)[: -len(END)])
    return b"".join(out) + END


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else a shorter first piece and full ones."""
    first = n % most or most
    return [(0, first)] + [(s, most) for s in range(first, n, most)] if n > most else [(0, n)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, most: int = SEQUENCE_TOKENS, with_ids: bool = False, special: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a row per piece; null text: empty.

    ``special``: the file's special tokens inside a text are their own ids,
    else they are plain text.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    encode = special_token_ids if special else token_ids

    @F.arrow_udf("array<struct<start: bigint, length: bigint, crc: bigint, ids: binary>>")
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())]))
        known = Words(path)  # of this task, so that a reused worker keeps none
        for texts in parts:
            rows = []
            for _, held in slices(texts):
                for raw in held:
                    ids = encode(raw.decode("utf-8", "replace"), path, known)
                    own = []
                    for start, n in cuts(len(ids) // 4, most):
                        part = ids[4 * start : 4 * (start + n)]
                        own.append({"start": start, "length": n, "crc": zlib.crc32(part), "ids": part if with_ids else None})
                    rows.append(own)
            yield pa.array(rows, kind)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(cut(F.col(text))).alias("piece", "p"))
    columns = [F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.crc").alias("ids_crc32")]
    return rows.select("doc_id", "piece", *columns, *([F.col("p.ids").alias("ids")] if with_ids else []))


class Intervals:
    """Intervals of non-negative integers, each with a row of integers."""

    def __init__(self, rows: list[tuple[int, ...]], width: int):
        rows = sorted(rows)
        table = np.array(rows, np.int64).reshape(-1, width + 1)
        self.starts, self.values = table[:, 0], table[:, 1:]

    def find(self, x: np.ndarray) -> np.ndarray:
        """(x - start, values...) of the interval that begins last at or before each x."""
        at = np.searchsorted(self.starts, x, side="right") - 1
        return np.column_stack([x - self.starts[at], self.values[at]])


def group_sizes(lengths: dict[int, int], groups: int = GROUPS) -> list[tuple[int, int]]:
    """(rounded size, pieces) of groups of equal cardinality, longest first; groups of equal size are one."""
    ordered = sorted(lengths.items(), reverse=True)
    each = -(-sum(lengths.values()) // groups) if lengths else 1
    out: list[list[int]] = []
    room = 0
    for length, n in ordered:
        while n:
            if not room:
                room = each
                if not out or out[-1][0] != length:
                    out.append([length, 0])
            got = min(n, room)
            out[-1][1] += got
            n, room = n - got, room - got
    return [(s, n) for s, n in out]


def best_subset(sizes: list[tuple[int, int, int]], room: int) -> dict[int, int]:
    """Counts of (name, size, available) whose sum is the largest up to ``room``; larger sizes are preferred."""
    full = (1 << (room + 1)) - 1
    steps, reach = [], 1
    for name, size, n in sizes:
        for _ in range(min(n, room // size)):
            more = reach | reach << size & full
            if more == reach:
                break
            steps.append((name, size, reach))
            reach = more
    at, used = reach.bit_length() - 1, defaultdict(int)
    for name, size, before in reversed(steps):
        if at and not before >> at & 1:
            used[name] += 1
            at -= size
    return used


def configure(sizes: list[tuple[int, int]], most: int) -> tuple[list[tuple[int, int, int]], int]:
    """Intervals (rank, first sequence, pieces of the size in each) over all large pieces, and the sequences used."""
    left = [n for _, n in sizes]
    rank = np.concatenate(([0], np.cumsum(left)))[:-1].tolist() if left else []
    out, used = [], 0
    top = 0
    while True:
        while top < len(left) and not left[top]:
            top += 1
        if top == len(left):
            return out, used
        others = [(i, sizes[i][0], left[i] - (i == top)) for i in range(top, len(left)) if left[i] - (i == top) > 0]
        chosen = best_subset(others, most - sizes[top][0])
        chosen[top] += 1
        times = min(left[i] // a for i, a in chosen.items())
        for i, a in chosen.items():
            out.append((rank[i], used, a))
            rank[i] += a * times
            left[i] -= a * times
        used += times


def fill(small: dict[int, int], spaces: dict[int, int], most: int) -> tuple[list[tuple[int, ...]], int]:
    """Best fit on counts: intervals (length * 2**40 + rank, space, first sequence of that space, offset), new sequences.

    ``spaces``: sequences by the room left in them. Space -1 stands for new sequences.
    """
    rooms: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room left: (space, first, end)
    for space, n in spaces.items():
        if space and n:
            rooms[space].append((space, 0, n))
    order = sorted(rooms)
    out, opened = [], 0
    for length in sorted(small, reverse=True):
        left, rank = small[length], 0
        while left:
            room = next((r for r in order if r >= length and rooms[r]), None)
            if room is None:
                new = -(-left // (most // length))
                rooms[most].append((-1, opened, opened + new))
                opened += new
                order = sorted(r for r in rooms if rooms[r])
                continue
            space, first, end = rooms[room].pop()
            n = min(left, end - first)
            out.append((length * 2**40 + rank, space, first, most - room))
            if first + n < end:
                rooms[room].append((space, first + n, end))
            rooms[room - length].append((space, first, first + n))
            left, rank = left - n, rank + n
            order = sorted(r for r in rooms if rooms[r])
    return out, opened


def ranked(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """``out``: place of each row among those of its group, from 0; a hot group is put in order chunk by chunk."""
    chunks = max(1, -(-df.count() // CHUNK_ROWS))
    rows = df.withColumns({"_one": F.lit(1).cast("long"), "_chunk": F.pmod(F.xxhash64(*order), F.lit(chunks))})
    return prefix_sums(rows, group, "_chunk", order, "_one", out).drop("_one", "_chunk")


def looked_up(df: DataFrame, intervals: Intervals, x: Column, names: list[str]) -> DataFrame:
    """``df`` with the values of the interval that holds ``x``."""
    held = df.sparkSession.sparkContext.broadcast(intervals)

    @F.arrow_udf("struct<" + ", ".join(f"{n}: bigint" for n in names) + ">")
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for xs in parts:
            got = held.value.find(xs.to_numpy(zero_copy_only=False))
            yield pa.StructArray.from_arrays([pa.array(got[:, i]) for i in range(len(names))], names)

    return df.withColumn("_found", find(x)).select("*", "_found.*").drop("_found")


def best_fit_pack(cut: DataFrame, most: int = SEQUENCE_TOKENS, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Every sequence holds at most ``most`` tokens; offsets are gapless from 0.
    Rows equal in all columns are interchangeable. No pieces: no rows.
    """
    keys = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
    cut = stage(cut, "pieces")
    own = stage(ranked(cut, "length", keys, "rank"), "ranked-pieces")
    lengths = {r["length"]: r["count"] for r in own.groupBy("length").count().collect()}
    large = {n: c for n, c in lengths.items() if n > small}
    plan, used = configure(group_sizes(large, groups), most)
    ahead, total = {}, 0
    for n in sorted(large, reverse=True):
        ahead[n], total = total, total + large[n]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    parts = []
    spaces = own.sparkSession.createDataFrame([], "sequence_id long, space long, place long")
    if large:
        first = F.element_at(F.create_map(*[x for n, r in ahead.items() for x in (F.lit(n), F.lit(r).cast("long"))]), F.col("length"))
        at = looked_up(own.where(F.col("length") > small).withColumn("big_rank", first + F.col("rank")), Intervals(plan, 2), F.col("big_rank"), ["nth", "first_sequence", "each"])
        placed = at.withColumn("sequence_id", F.col("first_sequence") + F.floor(F.col("nth") / F.col("each")))
        before = W.partitionBy("sequence_id").orderBy("big_rank").rowsBetween(W.unboundedPreceding, -1)
        placed = stage(placed.select(*columns, "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")), "placed-large")
        parts.append(placed)
        room = placed.groupBy("sequence_id").agg((F.lit(most) - F.sum("length")).alias("space"))
        spaces = stage(ranked(stage(room, "spaces"), "space", [F.col("sequence_id")], "place").select("sequence_id", "space", "place"), "ranked-spaces")
    if len(large) < len(lengths):
        room = {r["space"]: r["count"] for r in spaces.groupBy("space").count().collect()}
        plan, _ = fill({n: c for n, c in lengths.items() if n <= small}, room, most)
        at = looked_up(own.where(F.col("length") <= small), Intervals(plan, 3), F.col("length") * F.lit(2**40) + F.col("rank"), ["nth", "space", "first_place", "offset"])
        at = at.select(*columns, "space", (F.col("first_place") + F.col("nth")).alias("place"), "offset")
        new = at.where("space < 0").withColumn("sequence_id", F.col("place") + F.lit(used))
        old = at.where("space >= 0").join(spaces, ["space", "place"])
        parts += [x.select(*columns, "sequence_id", "offset") for x in (new, old)]
    if not parts:
        return cut.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.select(*columns, F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, most: int = SEQUENCE_TOKENS, special: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece.

    A null or empty text is one piece of the end token. Only documents of more
    than ``most`` tokens are cut. Repeated rows are packed each; null ids
    stay; an empty table gives no rows; other columns are ignored. ``special`` as in ``pieces``; the registered query and the
    pipeline set it.
    """
    return best_fit_pack(pieces(docs, doc_id, text, tokenizer, most, special=special), most)


def packed_ids(docs: DataFrame, packed: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, most: int = SEQUENCE_TOKENS, special: bool = False) -> DataFrame:
    """(sequence_id, ids): the sequences' token ids (little-endian unsigned 32-bit), for documents with unique ids; ``special`` as they were packed."""
    held = pieces(docs, doc_id, text, tokenizer, most, with_ids=True, special=special).select("doc_id", "piece", "ids")
    rows = packed.join(held, ["doc_id", "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
