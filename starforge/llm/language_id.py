"""Language identification with bit-sliced Bloom filters of n-grams.

The filters of all languages are one table: a slot holds a bit per language, so
looking an n-gram up in its few slots and combining them by AND returns all
languages that contain it. A document's bits are counted per language; the share
of its n-grams found in a language is corrected for the filter's false positives
(their rate is the language's fill to the power of the probes), and the largest
corrected share decides.

Learning counts n-grams per language in Spark, on a bounded sample of labelled
rows, and combines the bits per slot; only the tables, one of fixed size for each
64 languages, come to the driver and are broadcast. Prediction reads every whole text in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, crc_split, slices, stage, sums

SIZES = (3, 4)
SLOT_BITS = 20
PROBES = 3
WORD_BITS = 64  # languages in one table
# Learning: distinct texts per language at most (about; drawn by the text's hash), how
# often an n-gram must occur, and how frequent it must be against the
# language in which it is most frequent.
SAMPLE_ROWS = 2000
MIN_COUNT = 3
MIN_SHARE = 0.05
UNDETERMINED = "und"
# Up to so many languages a row per language is broadcast (some hundred bytes each); beyond, joined by shuffle.
BROADCAST_LANGS = 10_000
# The n-grams of a slice take about 90 bytes a byte of text.
PART_BYTES = SLICE_BYTES // 4


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@dataclass
class Model:
    """``langs`` in order; ``table``: one word per slot, a bit per language; ``chance``: false-positive rates.

    A word holds ``WORD_BITS`` languages; ``more``: the tables of the next ones.
    """

    langs: list[str]
    table: np.ndarray
    chance: np.ndarray
    more: list[np.ndarray] = field(default_factory=list)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text of each, has a letter) of the texts' n-grams.

    Lower case; whatever is not a letter is a word's edge; an n-gram holds
    letters, but for an edge at either end.
    """
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le"), np.uint32)
    codes = np.where(letters()[codes], codes, 0).astype(np.uint64)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))
    starts = np.concatenate(([0], ends))
    lettered = sums(codes > 0, starts) > 0
    edged = np.concatenate(([0], codes, np.zeros(max(SIZES), np.uint64))).astype(np.uint64)
    inner = edged > 0
    hashes, owner = [], []
    for size in SIZES:
        n = len(edged) - size + 1
        whole = np.ones(n, bool)
        h = np.full(n, size, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + edged[j : j + n]
            if 0 < j < size - 1:
                whole &= inner[j : j + n]
        at = np.flatnonzero(whole)
        h = h[at]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        hashes.append(h ^ h >> np.uint64(32))
        owner.append(np.searchsorted(ends, at, side="right"))
    return np.concatenate(hashes), np.minimum(np.concatenate(owner), len(texts) - 1), lettered


def probes(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [(hashes >> np.uint64(SLOT_BITS * j) & mask).astype(np.int64) for j in range(PROBES)]


def _small(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= BROADCAST_LANGS else rows


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The filters of every language of ``labelled`` (rows without text or language are ignored).

    About ``sample_rows`` distinct texts per language at most are read for
    n-grams, each once however many copies it has; with no labelled row the
    model has no languages.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    held = {r["lang"]: r["count"] for r in rows.select("lang", "hash").distinct().groupBy("lang").count().collect()}  # distinct texts; one row per language
    langs = sorted(held)
    if not langs:
        return Model([], np.zeros(1 << SLOT_BITS, np.uint8), np.zeros(0))
    draw = F.shiftrightunsigned("hash", 1)
    limits = [(code, name, min(1 << 63, max(1, (sample_rows << 63) // held[name])) - 1) for code, name in enumerate(langs)]
    limits = labelled.sparkSession.createDataFrame(limits, "code int, lang string, last long")
    drawn = rows.join(_small(limits, len(langs)), "lang").where(draw <= F.col("last")).dropDuplicates(["code", "hash"]).select("code", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy()
            for first, part in slices(batch.column(1), PART_BYTES):
                own = codes[first : first + len(part)]
                for code in np.unique(own):
                    hashes, _, _ = ngrams([t for t, c in zip(part, own) if c == code])
                    values, n = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), code, np.int32)), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["code", "gram", "n"])

    grams = drawn.mapInArrow(count, "code int, gram long, n long").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    counted = grams.groupBy("code").agg(F.sum("n").alias("n"), F.max("n").alias("top")).collect()
    facts = []
    for r in counted:
        code, bit = r["code"], 1 << r["code"] % WORD_BITS
        least = min(MIN_COUNT, held[langs[code]], r["top"])  # a language of one text has a filter too
        facts.append((code, code // WORD_BITS, bit - (1 << 64) if bit >> 63 else bit, r["n"], least))
    facts_table = labelled.sparkSession.createDataFrame(facts, "code int, word int, bit long, total long, least long")
    by_gram = grams.join(_small(facts_table, len(facts)), "code").withColumn("share", F.col("n") / F.col("total"))
    most = by_gram.groupBy("gram").agg(F.max("share").alias("most"))
    kept = by_gram.join(most, "gram").where((F.col("n") >= F.col("least")) & (F.col("share") >= MIN_SHARE * F.col("most")))
    slots = F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * j).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for j in range(PROBES)])
    found = kept.select("word", "bit", F.explode(slots).alias("slot")).groupBy("word", "slot").agg(F.bit_or("bit").alias("bits"))
    words = -(-len(langs) // WORD_BITS)
    if words > 1:
        found = stage(found, "language-bits")  # read word by word
    tables, fill = [], []
    for w in range(words):
        n = min(WORD_BITS, len(langs) - w * WORD_BITS)
        got = found.where(F.col("word") == w).select("slot", "bits").toArrow()
        table = np.zeros(1 << SLOT_BITS, np.uint64)
        table[got["slot"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
        fill += [np.count_nonzero(table >> np.uint64(i) & np.uint64(1)) / len(table) for i in range(n)]
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if n <= k(0).itemsize * 8)
        tables.append(table.astype(kind))
    return Model(langs, tables[0], np.array(fill) ** PROBES, tables[1:])


def shares(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(corrected share per text and language, whether the text has a letter)."""
    hashes, owner, lettered = ngrams(texts)
    at = probes(hashes)
    n = np.bincount(owner, minlength=len(texts)).astype(float)
    out = np.zeros((len(texts), len(model.langs)))
    for w, table in enumerate([model.table, *model.more]):
        found = table[at[0]]
        for slot in at[1:]:
            found = found & table[slot]
        # bits of the n-grams that any of these languages contains, added up per text
        some = np.flatnonzero(found)
        own = owner[some]
        runs = np.flatnonzero(np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]]))
        first = w * WORD_BITS
        last = min(first + WORD_BITS, len(model.langs))
        bits = np.unpackbits(found[some].view(np.uint8).reshape(len(some), table.itemsize), axis=1, bitorder="little")[:, : last - first]
        hit = np.zeros((len(texts), last - first))
        if len(runs):
            np.add.at(hit, own[runs], np.add.reduceat(bits, runs, axis=0, dtype=np.int32))
        chance = model.chance[first:last]
        out[:, first:last] = (hit / np.maximum(n, 1)[:, None] - chance) / np.maximum(1 - chance, 1e-9)
    return np.clip(out, 0, 1), lettered


def with_language(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with struct<lang, score> of ``text``.

    ``und`` and score 0 for a null text, one without a letter, and a model
    without languages; ties go to the first language by name; score is the
    corrected share of the chosen language.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for texts in parts:
            names, scores = [], []
            for _, part in slices(texts, PART_BYTES):
                got, lettered = shares(m, part)
                known = lettered & bool(m.langs)
                best = got.argmax(axis=1) if m.langs else np.zeros(len(part), int)
                names += [m.langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
                scores += [float(g[b]) if k else 0.0 for g, b, k in zip(got, best, known)]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return docs.withColumn(out, predicted(F.col(text)))


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: crc32 of the id modulo 4 is not 2."""
    return docs.where(crc_split(F.col(doc_id), 4) != 2)


def language_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row.

    Null, empty and letterless texts: ``und``, 0. A null id is not held out.
    Repeated rows and ids stay; an empty table gives no rows; other columns
    are ignored.
    """
    model = learn(training_rows(docs, doc_id), text, lang)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_language(rows, model).select("doc_id", (crc_split(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
