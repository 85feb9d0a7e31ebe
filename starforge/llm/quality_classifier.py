"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters look at every ``WIDTH`` bytes, ``STRIDE`` apart;
their rectified responses are max-pooled in chunks of ``CHUNK`` bytes that overlap by
half and cover the whole document; a logistic layer turns each chunk's pooled
features into a logit, and the document's probability comes from the mean of its
chunks' logits. The layer is linear in the features, so that mean is the layer
applied to the mean features.

Learning reads a bounded sample: about ``SAMPLE_ROWS`` labelled rows per class, then
about ``SAMPLE_CHUNKS`` of their chunks per class, drawn by hash from anywhere in the
text. The network (some thousand numbers) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_split, slices, stage

CHUNK, HALF = 512, 256
WIDTH, STRIDE = 8, 2
EMBED, FILTERS = 6, 40
SAMPLE_ROWS = 3000
SAMPLE_CHUNKS = 6000
EPOCHS, BATCH, RATE = 14, 64, 0.004
CUT_SHARE, SHORTEST = 0.35, 4  # learning also sees chunks cut short, as short texts are
THRESHOLD = 0.3
SEED = 7


@dataclass
class Network:
    """``embed`` (256, EMBED), ``filters`` (WIDTH * EMBED, FILTERS), ``bias``, ``weight`` (FILTERS), ``offset``;
    ``scale`` and ``shift`` turn a document's mean logit into its own."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0


def constant(share: float) -> Network:
    """A network that gives every document the same probability."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    zero = np.zeros
    return Network(zero((256, EMBED), np.float32), zero((WIDTH * EMBED, FILTERS), np.float32), zero(FILTERS, np.float32), zero(FILTERS, np.float32), float(np.log(share / (1 - share))))


def _responses(net: Network, raw: np.ndarray) -> np.ndarray:
    """Filter responses of every window that begins in ``raw`` (its length a multiple of HALF)."""
    embedded = net.embed[np.concatenate((raw, np.zeros(WIDTH, np.uint8)))]
    windows = np.lib.stride_tricks.sliding_window_view(embedded.reshape(-1), WIDTH * EMBED)[: len(raw) * EMBED : STRIDE * EMBED]
    return np.ascontiguousarray(windows) @ net.filters


def chunk_logits(net: Network, texts: list[bytes], at_once: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit of the chunk that begins at each half, whether one does, first half of each text)."""
    halves = np.array([(len(t) + WIDTH + HALF - 1) // HALF for t in texts])  # each text ends in at least WIDTH zero bytes
    raw = np.frombuffer(b"".join(t.ljust(h * HALF, b"\0") for t, h in zip(texts, halves.tolist())), np.uint8)
    pooled = np.empty((len(raw) // HALF, FILTERS), np.float32)
    ends = np.cumsum(halves)
    final = np.zeros(len(pooled), bool)
    final[ends - 1] = True
    for first in range(0, len(raw), at_once):
        part = raw[first : first + at_once + HALF]  # a further half, so that windows see what follows
        n = min(at_once, len(raw) - first) // HALF
        seen = _responses(net, part)[: n * HALF // STRIDE].reshape(n, HALF // STRIDE, FILTERS)
        # windows that reach into the next text are not this one's
        seen[np.flatnonzero(final[first // HALF : first // HALF + n]), 1 - WIDTH // STRIDE :] = -np.inf
        pooled[first // HALF : first // HALF + n] = seen.max(axis=1)
    begins = np.ones(len(pooled), bool)
    begins[ends - 1] = False
    at = np.flatnonzero(begins)
    both = pooled.copy()
    both[at] = np.maximum(pooled[at], pooled[at + 1])
    begins[ends[halves == 1] - 1] = True  # a text of one half is one chunk
    return np.maximum(both + net.bias, 0) @ net.weight + net.offset, begins, ends - halves


def scores(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for each UTF-8 text."""
    logits, counted, first = chunk_logits(net, texts)
    total = np.add.reduceat(np.where(counted, logits, 0.0).astype(np.float64), first)
    mean = total / np.add.reduceat(counted.astype(np.int64), first)
    return 1 / (1 + np.exp(-np.clip(net.scale * mean + net.shift, -30, 30)))


def calibrate(net: Network, logits: np.ndarray, labels: np.ndarray, share: float) -> Network:
    """``net`` with scale and shift from a logistic fit of documents' mean logits, label 1 weighted to ``share``."""
    if len(labels) and labels.min() != labels.max():
        weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
        x = np.column_stack([logits, np.ones(len(logits))])
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (weight * (p - labels)) + 1.0 * (beta - [1.0, 0.0])
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
            beta = beta - np.linalg.solve(bend, slope)
        net.scale, net.shift = float(max(beta[0], 0.1)), float(beta[1])
    return net


def fit(chunks: list[bytes], labels: np.ndarray, share: float, seed: int = SEED) -> Network:
    """The network for chunks (at most CHUNK bytes) and their 0/1 labels, either class weighing as much.

    With one class only, the constant ``share`` (of label 1).
    """
    if not len(labels) or labels.min() == labels.max():
        return constant(share)
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.5, (256, EMBED)), rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)), np.zeros(FILTERS), rng.normal(0, FILTERS**-0.5, FILTERS), 0.0)
    net.embed[0] = 0  # padding
    data = np.frombuffer(b"".join(c[:CHUNK].ljust(CHUNK, b"\0") for c in chunks), np.uint8).reshape(-1, CHUNK)
    weights = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    names = ("embed", "filters", "bias", "weight", "offset")
    first, second, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    starts = np.arange(0, CHUNK - WIDTH + 1, STRIDE)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(data))
        for b in range(0, len(order), BATCH):
            at = order[b : b + BATCH]
            x, y, w = data[at], labels[at], weights[at]
            cut = np.where(rng.random(len(at)) < CUT_SHARE, np.exp(rng.uniform(np.log(SHORTEST), np.log(CHUNK), len(at))), CHUNK)
            x = np.where(np.arange(CHUNK) < cut[:, None], x, 0).astype(np.uint8)
            windows = x[:, starts[:, None] + np.arange(WIDTH)]  # (batch, window, WIDTH)
            seen = net.embed.astype(np.float32)[windows].reshape(len(at), len(starts), -1)
            response = seen @ net.filters.astype(np.float32)
            best = response.argmax(axis=1)  # (batch, FILTERS)
            pooled = np.take_along_axis(response, best[:, None, :], 1)[:, 0, :] + net.bias
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.weight + net.offset, -30, 30)))
            d = w * (p - y) / len(at)
            dpooled = (d[:, None] * net.weight) * (pooled > 0)
            rows = np.arange(len(at))[:, None]
            taken = seen[rows, best]  # (batch, FILTERS, WIDTH * EMBED)
            grads = {"weight": active.T @ d, "offset": d.sum(), "bias": dpooled.sum(axis=0), "filters": np.einsum("bf,bfk->kf", dpooled, taken)}
            back = (dpooled[:, :, None] * net.filters.T[None]).reshape(-1, EMBED)
            grads["embed"] = np.stack([np.bincount(windows[rows, best].reshape(-1), weights=back[:, e], minlength=256) for e in range(EMBED)], axis=1)
            grads["embed"][0] = 0
            step += 1
            for n in names:
                g = grads[n] + (1e-4 * getattr(net, n) if n in ("filters", "weight") else 0)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                rate = RATE * (1 - 0.9 * epoch / EPOCHS)
                setattr(net, n, getattr(net, n) - rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8))
    return Network(*(getattr(net, n).astype(np.float32) for n in names[:4]), float(net.offset))


def training_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(doc_id, label) that may be learned from: crc32 of the id modulo 5 is not 0; label 0 or 1."""
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rows.where(rows["doc_id"].isNotNull() & rows["label"].isin(0, 1) & (crc_split(rows["doc_id"], 5) != 0)).distinct()


def _share(wanted: int, of: int) -> int:
    """The last 63-bit number that is drawn, for ``wanted`` of ``of`` rows."""
    return min(1 << 63, max(1, (wanted << 63) // of)) - 1


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, sample_chunks: int = SAMPLE_CHUNKS) -> Network:
    """The network for ``labels`` (doc_id, label) of ``docs``; without both classes a constant."""
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    keep = F.lit(False)
    for k, n in counts.items():
        keep = keep | ((F.col("label") == k) & (draw <= _share(sample_rows, n)))
    # at most about 2 * sample_rows small rows, so their broadcast is bounded
    chosen = F.broadcast(labels.where(keep).select(F.col("doc_id").alias("_id"), "label"))
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.join(chosen, docs[doc_id] == chosen["_id"]).select("label", F.xxhash64("_id", F.col(text)).alias("doc"), raw.alias("raw"))
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("raw") / HALF).cast("int") - 2)
    cut = rows.select("label", "doc", F.explode(F.sequence(F.lit(0), last)).alias("i"), "raw")
    chunks = stage(cut.select("label", "doc", "i", F.substring("raw", F.col("i") * HALF + 1, F.lit(CHUNK)).alias("chunk")), "quality-chunks")
    held = {r["label"]: r["count"] for r in chunks.groupBy("label").count().collect()}
    # by document and place: equal chunks of different documents are drawn one by one
    draw = F.shiftrightunsigned(F.xxhash64("doc", "i", "label"), 1)
    keep = F.lit(False)
    for k, n in held.items():
        keep = keep | ((F.col("label") == k) & (draw <= _share(sample_chunks, n)))
    got = chunks.where(keep).orderBy("label", "chunk").select("label", "chunk").toArrow()  # bounded by sample_chunks
    net = fit([c or b"" for c in got["chunk"].to_pylist()], got["label"].to_numpy().astype(np.int64), share)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def logit(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            values = np.zeros(len(part))
            for first, some in slices(part):
                logits, _, at = chunk_logits(sent.value, some)
                values[first : first + len(some)] = logits[at]
            yield pa.array(values)

    means = chunks.withColumn("logit", logit("chunk")).groupBy("doc", "label").agg(F.avg("logit").alias("logit")).toArrow()  # one row per sampled document
    return calibrate(net, means["logit"].to_numpy(), means["label"].to_numpy().astype(np.int64), share)


def with_quality(docs: DataFrame, net: Network, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 for the whole ``text`` (null: empty)."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            values = np.zeros(len(texts))
            for first, part in slices(texts):
                values[first : first + len(part)] = scores(held.value, part)
            yield pa.array(values)

    return docs.withColumn(out, scored(F.col(text)))


def quality_report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    Empty and null texts get a score like any other (padding only). A null id
    is not held out. Repeated rows and ids stay; without labels of both
    classes every score is the share of label 1 (0.5 without any); an empty
    table gives no rows; other columns are ignored.
    """
    net = learn(docs, training_labels(labels), doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    score = F.col("quality_score")
    return with_quality(rows, net).select("doc_id", (crc_split(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
