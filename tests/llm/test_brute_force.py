"""Operators without SQL against plain loops: language shares, the classifier's forward pass, fingerprints, the mix."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import xxhash

from starforge.llm import fingerprints, language_id, mixing, quality_classifier
from tests.llm.conftest import ROWS


def plain_grams(text):
    codes = [0, *(ord(c) if c.isalpha() else 0 for c in text.lower()), 0]
    for size in language_id.SIZES:
        for i in range(len(codes) - size + 1):
            gram = codes[i : i + size]
            if all(gram[1:-1]):
                yield size, tuple(gram)


def test_language_ngrams_are_the_plain_ones():
    texts = [t for _, t, _, _ in ROWS if t and len(t) < 5000] + ["", "a", "ab cd", "ÀÉ ñ"]
    hashes, owner, _ = language_id.ngrams([t.encode() for t in texts])
    for i, t in enumerate(texts):
        got = Counter(hashes[owner == i].tolist())
        # grams of nothing but edges are none; one hash per gram
        want = Counter(g for g in plain_grams(t) if any(g[1]))
        assert sorted(got.values()) == sorted(want.values())


def test_language_shares_by_plain_sets(spark):
    rows = [("aa", "aba bab abab " * 40), ("bb", "xyz zyx xyzzy " * 40), ("cc", "abz zba " * 40)]
    model = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    texts = ["abab bab xyz", "zyx abz", "qqq", ""]
    got, _ = language_id.shares(model, [t.encode() for t in texts])
    for i, t in enumerate(texts):
        hashes, _, _ = language_id.ngrams([t.encode()])
        at = [[int(p[j]) for p in language_id.probes(hashes)] for j in range(len(hashes))]
        for k in range(3):
            hit = sum(all(int(model.table[s]) >> k & 1 for s in slots) for slots in at)
            share = min(1.0, max(0.0, (hit / max(1, len(at)) - model.chance[k]) / (1 - model.chance[k])))
            assert math.isclose(got[i, k], share, abs_tol=1e-12)


def test_classifier_scores_by_plain_loops():
    q = quality_classifier
    rng = np.random.default_rng(1)
    net = q.Network(*(rng.normal(0, 0.5, s).astype(np.float32) for s in ((256, q.EMBED), (q.WIDTH * q.EMBED, q.FILTERS), (q.FILTERS,), (q.FILTERS,))), 0.1)
    net.embed[0] = 0
    net.scale, net.shift = 1.3, -0.2
    texts = [b"", b"x", b"hello world " * 5, bytes(rng.integers(32, 127, 700).astype(np.uint8)), bytes(rng.integers(32, 127, 1500).astype(np.uint8))]
    got = q.scores(net, texts)
    for text, score in zip(texts, got):
        halves = (len(text) + q.WIDTH + q.HALF - 1) // q.HALF
        raw = text.ljust(halves * q.HALF, b"\0")
        logits = []
        for c in range(max(1, halves - 1)):
            end = min(len(raw), (c + 2) * q.HALF)
            best = np.full(q.FILTERS, -np.inf)
            for at in range(c * q.HALF, end, q.STRIDE):
                if at + q.WIDTH > end and end == len(raw):
                    continue  # beyond the text
                window = raw[at : at + q.WIDTH].ljust(q.WIDTH, b"\0")
                best = np.maximum(best, np.concatenate([net.embed[b] for b in window]) @ net.filters)
            logits.append(float(np.maximum(best + net.bias, 0) @ net.weight + net.offset))
        want = 1 / (1 + math.exp(-(net.scale * sum(logits) / len(logits) + net.shift)))
        assert math.isclose(score, want, rel_tol=1e-4, abs_tol=1e-5)


def test_mix_takes_each_source_in_blocks_of_its_permutation(docs):
    """Every span is inside its document, and a source's spans cover its stream as often as its target says."""
    out = mixing.mix_report(docs).collect()
    sizes = {}
    for (_, t, _, s), n in zip(ROWS, [len([w for w in (t or "").split() if w]) for _, t, _, _ in ROWS]):
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets([sizes[s] for s in names], mixing.WEIGHTS, 1.5, 2.0)
    assert {(r.source_size, round(r.target, 6)) for r in out} == {(sizes[s], round(t, 6)) for s, t in zip(names, want)}
    for size, target in {(r.source_size, r.target) for r in out}:
        taken = [(r.taken, r["size"]) for r in out if (r.source_size, r.target) == (size, target)]
        whole = int(target // size) if size else 0
        assert all(whole * n <= t <= (whole + 1) * n for t, n in taken)  # whole passes, and a part of the next


def test_held_out_folds_are_by_crc(docs):
    out = language_id.language_report(docs).collect()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_edited_texts_by_plain_rules(docs):
    """sha-256 and character counts of the edited texts, and equal fingerprints for equal texts."""
    rows = [(i, t or "") for i, t, _, _ in ROWS if i is not None and [x for x, *_ in ROWS].count(i) == 1]
    out = {r.doc_id: r for r in fingerprints.fingerprint_report(docs.where("doc_id in ({})".format(",".join(str(i) for i, _ in rows)))).collect()}
    ordered = sorted(rows, reverse=True)
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert out[i].n_chars == len(t) and out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if edited == t:
            assert out[i].edited_fingerprint == out[i].fingerprint and out[i].near_edited == 1.0
    assert xxhash.xxh64_intdigest(b"") != 0 and out[1].fingerprint == out[2].fingerprint
