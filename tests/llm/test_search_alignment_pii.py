"""Ranked search, tokenizer alignment and personal data against brute force, on odd rows, long texts and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starforge.llm import pii, ranked_search, token_alignment
from tests.conftest import SF001
from tests.llm.conftest import ROWS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {65 + i: 97 + i for i in range(26)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for (i, bag), length in zip(bags, lengths):
            m = 50 + 50 * length * n // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in set(terms(text)) if bag[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


ITEMS = [(1, "The QUICK brown fox, quick!"), (2, "quick fox of the words"), (3, None), (4, "..."), (5, "word5x5 word6x6 fox the"), (None, "ça va bien élèves"), (7, "nowhere-to-be-found zzzz"), (8, "the fox the fox some words id")]


@pytest.mark.parametrize("k", [2, 50])
def test_ranked_search_by_brute_force(spark, docs, k):
    items = spark.createDataFrame([(i, t, "s") for i, t in ITEMS], "item_id long, text string, score string")
    got = [tuple(r) for r in ranked_search.ranked_search(docs, items, k).collect()]
    assert sorted(got, key=repr) == sorted(plain_search([(i, t) for i, t, _, _ in ROWS], ITEMS, k), key=repr)


def test_ranked_search_in_blocks_and_with_repeated_items(spark, docs, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 3)
    items = spark.createDataFrame([*ITEMS, (2, "brown lazy")], "item_id long, text string")
    want = plain_search([(i, t) for i, t, _, _ in ROWS], [(i, t + " brown lazy" if i == 2 else t) for i, t in ITEMS], 50)
    assert sorted(map(tuple, ranked_search.ranked_search(docs, items).collect()), key=repr) == sorted(want, key=repr)


def test_ranked_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.ranked_search(empty, items).collect() == []
    assert ranked_search.ranked_search(docs, items.limit(0)).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), max_size=10), min_size=1, max_size=9), st.integers(0, 2**32))
def test_shared_sums_are_the_items_sums(items, seed):
    graph = ranked_search.shared_sets([sorted(x) for x in items], 15)
    values = np.random.default_rng(seed).integers(0, 1000, (15, 4))
    acc = np.zeros((graph.n_rows, 4), np.int64)
    acc[:15] = values
    assert graph.sums(acc).tolist() == [values[sorted(x)].sum(axis=0).tolist() for x in items]
    assert graph.additions() <= sum(max(0, len(x) - 1) for x in items)


def test_a_shared_set_is_summed_once():
    graph = ranked_search.shared_sets([[0, 1, 2, 3, 4], [0, 1, 2, 3, 5], [0, 1, 2, 3, 6], [2, 3, 7]], 8)
    assert graph.additions() < 4 + 4 + 4 + 2 - 4


# tokenizer alignment


def plain_alignment(texts):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    rows, count = [], Counter()
    for text in texts:
        links, parts, a, b = [], [], [], []
        if text:
            a = [(i, bytes(byte_of[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
            for i in b_model.encode(text):
                p = b_model.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
            if not b"".join(r for _, r in a) == (" " + text).encode() == b"".join(r for _, r in b):
                a, b = [], []
        ends = [[(i, e) for (i, _), e in zip(x, itertools.accumulate(len(r) for _, r in x))] for x in (a, b)]
        at_b, low = {e: i for i, e in ends[1]}, 0
        ids_a, ids_b = list(ends[0]), list(ends[1])
        for i, e in ends[0]:
            if e in at_b:
                links.append((i, at_b[e]))
                parts.append(",".join(str(x) for x, y in ids_a if low < y <= e) + "|" + ",".join(str(x) for x, y in ids_b if low < y <= e) if len(ids_a) < 400 else "")
                low = e
        count.update(links)
        rows.append((len(a), len(b), links, ";".join(parts) if len(ids_a) < 400 else None))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return [(na, nb, len(x), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), None if s is None else hashlib.sha256(s.encode()).hexdigest() if na else "") for na, nb, x, s in rows]


ALPHABET = ["a", "b", "the", "foo", " ", "  ", "\n", " \n", "\t", " ", "　", "▁", "é", "ß", "漢字", "🙂", "1", "23", ".", ",", "'s", "'ll", "<|endoftext|>", "<s>", "<0x41>", "\x1c", "\x85", "\r\n", "​", "é", "ﬁ", "THE", "{", "())", "==", " "]


def test_alignment_by_brute_force(spark, docs):
    rng = random.Random(5)
    texts = [t for _, t, _, _ in ROWS] + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align_tokenizers(rows).collect()}
    want = plain_alignment(texts)
    for i, w in enumerate(want):
        assert got[i][:6] == w[:6], texts[i]
        assert w[6] is None or got[i][6] == w[6], texts[i]


def test_alignment_keeps_rows_whatever_the_slabs(spark, docs, empty, monkeypatch):
    out = sorted(map(tuple, token_alignment.align_tokenizers(docs).collect()), key=repr)
    assert len(out) == len(ROWS) and all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in out if r[0] in (3, 4))
    monkeypatch.setattr(token_alignment, "SLAB_BYTES", 1)  # every text a slab
    assert sorted(map(tuple, token_alignment.align_tokenizers(docs).collect()), key=repr) == out
    assert token_alignment.align_tokenizers(empty).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), min_size=1, max_size=12))
def test_pointer_jumping_ends_at_each_components_last_token(a, b):
    b = b + [sum(a) - sum(b)] if sum(b) < sum(a) else b
    a = a + [sum(b) - sum(a)] if sum(a) < sum(b) else a
    ea, eb = np.cumsum(a), np.cumsum(b)
    common = sorted(set(ea.tolist()) & set(eb.tolist()))
    ends = [next(c for c in common if c >= e) for e in [*ea.tolist(), *eb.tolist()]]
    assert ea[token_alignment.groups(ea, eb)].tolist() == ends


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (kind == "card" and 13 <= len(digits) <= 19 and plain_luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"019.@+- ()a-é:#_%\n", "4111111111111111", "a@b.co", "1.2.3.4", " +1 (555) 010-9999 ", "256", "0255"]), max_size=20).map("".join))
def test_base_spans_by_brute_force(text):
    assert [f"{pii.KINDS[k - 1]}:{s}:{e}" for k, s, e in pii.base_spans(text)[0]] == plain_spans(text)


ODD = ["Call +1 (743) 555-3824 today. Some words. Or dial 743-555-3824 then.", "pay 12 4111111111111111 now", "only 743-555-3824 here, version 4.0.1.2.3 and 1234567890123456", "+1 (826) 555-4081 190.137.223.204", None, ""]


def test_personal_data_of_documents(spark):
    known = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    phones = [(10_000 + i, f"my number is +1 ({200 + i}) 555-{1000 + 7 * i} and again +1 ({200 + i}) 555-{1000 + 7 * i} ok") for i in range(40)]
    cards = [(20_000 + i, f"card {c} paid" if plain_luhn(c) else f"order {c} sent, order {c} paid") for i in range(300) for c in [f"4{731_000_000_000_000 + 7919 * i}"]]
    odd = [(-1 - i, t) for i, t in enumerate(ODD)]
    extra = spark.createDataFrame([*phones, *cards, *odd, *odd], "doc_id long, text string")
    docs = known.unionByName(extra).selectExpr("*", "'x' as spans", "1 as n_ip")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = pii.find_personal_data(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in PATTERNS]
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        assert r.doc_id < 0 or r.doc_id >= 10_000 or r.n_added == 0
    found = {r.doc_id: r.spans for r in out if r.doc_id < 0}
    assert found[-1] == "phone:5:22,phone:50:62"  # the second way of writing it, from the first
    assert found[-2] == "card:7:23"
    assert found[-3] == "ip:32:39"  # nothing said of the same words without a clear occurrence
    assert found[-4] == "ip:18:33,phone:0:17"
    assert found[-5] == found[-6] == ""


def test_personal_data_of_nothing(spark, docs, empty):
    assert pii.find_personal_data(empty).collect() == []
    assert len(pii.find_personal_data(docs).collect()) == len(ROWS)


def test_beliefs_are_exact_without_loops():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.FORM_BITS + 1, 7)), rng.normal(size=(7, 7)) + pii.possible_steps(), rng.normal(size=(5, 5)))
    form = np.array([pii.PLUS | 1 << 9, 1 << 11, 1 << 14 | pii.HYPHEN, 1 << 16, pii.IS_EMAIL])
    joins, entity, seen = np.array([1, 1, 0, 0, 0], bool), np.array([-1, -1, 0, 0, -1]), np.array([-1, -1, -1, -1, -1])
    got = pii.beliefs(field, form, seen, joins, entity, rounds=50)
    unary = field.unary(form)
    first = [True, False, False, True, True]
    total = np.zeros((5, 7))
    for labels in itertools.product(range(7), repeat=5):
        if any(f and y in (pii.CARD_I, pii.PHONE_I) for f, y in zip(first, labels)):
            continue
        z = sum(unary[i, y] for i, y in enumerate(labels)) + field.steps[labels[0], labels[1]] + field.steps[labels[1], labels[2]]
        both = field.entity[:, pii.KIND_OF[labels[2]]] + field.entity[:, pii.KIND_OF[labels[3]]]
        w = np.exp(z) * np.exp(both).sum()
        for i, y in enumerate(labels):
            total[i, y] += w
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True), atol=1e-6)


def test_very_long_texts_stay_linear():
    """Runs that would make a pattern start again at every character."""
    began = time.time()
    for text in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+" * 1_000_000, "a@" * 500_000, "(" * 500_000 + "1", "1 " * 500_000):
        spans, failed = pii.base_spans(text)
        pii.tokens(text, spans, failed)
    assert time.time() - began < 60
