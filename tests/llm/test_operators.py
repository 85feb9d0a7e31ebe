"""Every operator against brute force, on rows with nulls, long texts, copies and clashing columns, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.llm import chat_format, fingerprints, language_id, mixing, packing, quality_classifier, quality_rules, simhash_near_dup, token_counts, url_filter
from starforge.llm.graph import connected_components
from starforge.llm.queries import chat_digest
from tests.conftest import SF001
from tests.llm.conftest import ROWS

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def key(r):
    return repr(tuple(r))


def union_find(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


# mixing


def test_mix_targets_and_bounds(spark, docs):
    out = mixing.mix_report(docs).collect()
    assert len(out) == len(ROWS)
    assert sorted(r["size"] for r in out) == sorted(len(WORDS.findall(t or "")) for _, t, _, _ in ROWS)
    by_source = {}
    for r in out:
        assert r["taken"] <= 2 * r["size"]
        by_source.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    for (size, target), taken in by_source.items():
        assert target <= 2 * size and abs(sum(taken) - target) <= 1
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_targets_water_level():
    got = mixing.targets([10, 100, 1000, 0], (5.0, 2.0, 1.0), 1.5, 2.0)
    assert got[0] == 20 and got[1] == 200 and got[3] == 0 and abs(sum(got) - 1.5 * 1110) < 1e-9


def test_swap_or_not_is_a_permutation(spark):
    for n in (1, 2, 7, 100):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))


def test_mixed_texts_are_spans_of_their_documents(docs):
    out = mixing.mixed_documents(docs, block_words=64)
    assert out.columns == docs.columns
    texts = [(i, t or "") for i, t, _, _ in ROWS]
    rows = out.collect()
    assert all(any(i == r.doc_id and r.text in t for i, t in texts) and r.n_chars == len(r.text) for r in rows)
    taken = sum(r.taken for r in mixing.mix_report(docs).collect())
    assert sum(len(WORDS.findall(r.text)) for r in rows) == taken


# token counts


def greedy(vocabulary, word):
    n = i = 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in vocabulary), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=12), st.lists(st.text("abcd", min_size=1, max_size=12), min_size=1, max_size=8))
def test_automaton_is_greedy_longest_match(vocabulary, words):
    words = [w.encode() for w in words]
    got = token_counts.piece_counts(token_counts.build(sorted(vocabulary)), words)
    assert got.tolist() == [greedy(vocabulary, w) for w in words]


def test_long_words_beside_short_ones():
    """Words of all lengths, so that some are stepped together and the last ones walked."""
    rng = np.random.default_rng(4)
    vocabulary = sorted({bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in rng.integers(1, 6, 60)} | {b"a", b"b"})
    words = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in [*rng.integers(1, 30, 300), 400, 900]]
    assert token_counts.piece_counts(token_counts.build(vocabulary), words).tolist() == [greedy(set(vocabulary), w) for w in words]


def test_a_word_of_a_megabyte():
    automaton = token_counts.build(token_counts.read_vocabulary())
    assert automaton.plain
    word = b"ab0Zq-" * 170_000
    began = time.time()
    n = token_counts.piece_counts(automaton, [b" x", b" " + word])
    assert time.time() - began < 3 and n[1] > len(word) // 6


def test_token_counts_of_documents(docs):
    vocabulary = set(token_counts.read_vocabulary())
    known = {}
    for _, t, _, _ in ROWS:
        for x in (t or "").encode().split():
            known.setdefault(x, greedy(vocabulary, b" " + x))
    want = sorted((repr(i), len(w), sum(known[x] for x in w)) for i, t, _, _ in ROWS for w in [(t or "").encode().split()])
    got = sorted((repr(r.doc_id), r.n_words, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    assert got == want


# quality rules


def test_measures_by_brute_force(docs):
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(docs).collect())
    want = []
    for i, t, _, _ in ROWS:
        w = WORDS.findall(t or "")
        seen = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        covered = {j + k for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for k in range(8)}
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        want.append((repr(i), len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)))
    assert got == sorted(want)


def test_domain_of_failures_is_rejected_and_small_ones_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "# " * 30
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, bad, "bad") for i in range(40)] + [(200, bad, "tiny")] + [(300 + i, good, f"g{i}") for i in range(30)]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0].kept and out[100].domain_failed and not out[100].kept and len(out) == len(rows)


# URL filter


def test_url_verdicts(spark):
    urls = [None, "", "nothing", "http://", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/1", "http://x.net/es", "http://x.net/es/", "ftp://net/fr/1", "http://notexample.com/en/2", "http://a.b.net/de/", "http://com?x", "x://y://com/", "http://" + "a." * 500 + "com/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    out = url_filter.filter_urls(pages, url_filter.registered_rules(spark)).collect()
    assert len(out) == 2 * len(urls)
    for r in out:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])


def test_bloom_filter_passes_every_listed_key(spark):
    keys = [f"host{i}.example/{i}" for i in range(500)]
    table = url_filter.build_filter(spark.createDataFrame([(k,) for k in keys], "key string"))

    def has(k):
        block, bits = url_filter._place(xxhash.xxh64_intdigest(k.encode(), 42), len(table))
        return all(int(table[block][i >> 6]) >> (i & 63) & 1 for i in bits)

    assert all(map(has, keys)) and sum(has("no" + k) for k in keys) < 25


# language ID


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = language_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held)


def test_language_edge_cases(docs, empty):
    out = {(r.doc_id, r.lang_pred) for r in language_id.language_report(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und")} <= out
    assert language_id.language_report(empty).collect() == []


def test_bloom_shares_are_corrected(spark):
    rows = [("aa", "aba bab abab " * 40), ("bb", "xyz zyx xyzzy " * 40)]
    model = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    got, lettered = language_id.shares(model, [b"abab bab", b"xyz zyx", b"12 !", b""])
    assert model.langs == ["aa", "bb"] and lettered.tolist() == [True, True, False, False]
    assert got[0].argmax() == 0 and got[1].argmax() == 1 and got[0, 0] > 0.9 and got[0, 1] < 0.1


def test_language_sample_counts_distinct_texts(spark):
    """A language of few texts in many copies keeps its filter; a hot text counts once."""
    rows = [("aa", f"aba bab abab aab{c} " * 5) for c in "cdefg" for _ in range(4000)] + [("bb", f"xyz zyx xyzzy {a}{b}q " * 5) for a in "klmnopqrst" for b in "klmnopqrst"]
    rows += [("bb", "wuw uwu wuuw " * 50)] * 3000
    labelled = spark.createDataFrame(rows, "lang string, text string")
    model = language_id.learn(labelled, sample_rows=40)
    got, _ = language_id.shares(model, [b"abab bab", b"xyz zyx"])
    assert got[0].argmax() == 0 and got[0, 0] > 0.9 and got[1].argmax() == 1 and got[1, 1] > 0.9
    once = language_id.learn(labelled.distinct(), sample_rows=40)
    assert np.array_equal(model.table, once.table)


def test_more_languages_than_a_word_has_bits(spark):
    """130 languages, each with three letters of its own, need three tables."""
    own = [chr(0x4E00 + 3 * i) + chr(0x4E01 + 3 * i) + chr(0x4E02 + 3 * i) for i in range(130)]
    rows = [(2 * n, f"{w} {w[::-1]} {w}{w[0]} " * 20, f"l{i:03}") for n, (i, w) in enumerate(enumerate(own))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert len(model.langs) == 130 and [t.dtype.itemsize for t in (model.table, *model.more)] == [8, 8, 1]
    out = language_id.with_language(docs, model).collect()
    assert all(r.language.lang == r.lang and r.language.score > 0.9 for r in out)


# SimHash near duplicates


def plain_fingerprint(text, k=3):
    words = [w for w in WORDS.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))]
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            votes[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(shingles))


def test_near_duplicates_by_brute_force(docs):
    out = simhash_near_dup.near_duplicates(docs).collect()
    fps = [(i, plain_fingerprint(t)) for i, t, _, _ in ROWS]
    assert sorted((repr(i), f"{f:016x}") for i, f in fps) == sorted((repr(r.doc_id), r.fingerprint) for r in out)
    label = union_find((a, b) for _, a in fps for _, b in fps if (a ^ b).bit_count() <= 3)
    least = {}
    for i, f in fps:
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    assert all(r.component_id == least.get(label[int(r.fingerprint, 16)]) for r in out)
    kept = simhash_near_dup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label.values()))


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_covering_masks_cover_every_pair_within_the_radius(radius):
    masks, rng = simhash_near_dup.covering_masks(radius), np.random.default_rng(radius)
    for _ in range(3000):
        flips = sum(1 << int(i) for i in rng.choice(64, radius, replace=False))
        assert any(not m & flips for m in masks)


def test_links_of_dense_buckets_by_pairs_and_by_hubs(spark):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(1 << 62))
    fps = {centre ^ sum(1 << int(i) for i in rng.choice(64, int(rng.integers(0, 7)), replace=False)) for _ in range(150)} | {int(x) for x in rng.integers(1 << 62, size=50)}
    want = union_find((a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    for rows in (4096, 3):
        got = {r.node: r.root for r in connected_components(simhash_near_dup.link_fingerprints(table, 3, bucket_rows=rows)).collect()}
        groups = lambda label: sorted(sorted(x % (1 << 64) for x in label if label[x] == r) for r in set(label.values()) if sum(label[x] == r for x in label) > 1)
        assert groups(got) == groups(want)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (100, 99), (99, 100)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99}


# fingerprints


def test_edited_texts_and_fingerprints(docs):
    out = fingerprints.fingerprint_report(docs).collect()
    assert len(out) == len(ROWS) and sorted(r.n_chars for r in out) == sorted(len(t or "") for _, t, _, _ in ROWS)
    by_id = Counter(i for i, *_ in ROWS)
    order = sorted((i for i in by_id if i is not None), reverse=True) + [None]
    texts = {i: t or "" for i, t, _, _ in ROWS}
    for a, b in zip(order, order[1:] + order[:1]):
        if by_id[a] == by_id[b] == 1:
            t, half = texts[a], len(texts[a]) // 2
            edited = t[: len(t) - half] + texts[b][:half]
            (row,) = [r for r in out if r.doc_id == a]
            assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    same = {r.doc_id: r.fingerprint for r in out}
    assert same[1] == same[2] and same[3] == same[4] == "0" * 16


def test_next_smaller_over_a_wide_range(spark):
    values = [0, 1, 2, 1 << 20, (1 << 20) + 1, 1 << 40, -5, -(1 << 50), (1 << 54), 3]
    got = {r.v: r.next_v for r in fingerprints.next_smaller(spark.createDataFrame([(v,) for v in values * 2], "v long")).collect()}
    order = sorted(values, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(1 << 62, size=60)]
    fps = sorted({f ^ sum(1 << int(i) for i in rng.choice(63, int(rng.integers(0, 6)), replace=False)) for f in base for _ in range(4)})
    table = spark.createDataFrame([(f,) for f in fps] + [(None,)], "fp long")
    got = {(r.query, r.found, r.distance) for r in fingerprints.search(table, table, 3).collect()}
    assert got == {(a, b, (a ^ b).bit_count()) for a in fps for b in fps if (a ^ b).bit_count() <= 3}


# packing


def test_packing_is_a_partition_into_sequences(docs):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = packing.public_tokenizers.path(packing.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    out = packing.pack_documents(docs).collect()
    want = []
    for i, t, _, _ in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for n, (start, length) in enumerate(packing.cuts(len(ids), 2048)):
            want.append((repr(i), n, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())))
    assert sorted(want) == sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out])


def check_sequences(rows, most=2048):
    at = {}
    for s, offset, length in sorted(rows):
        assert offset == at.get(s, 0)
        at[s] = offset + length
    assert max(at.values(), default=0) <= most
    return len(at)


def test_packing_is_tight_on_the_table(spark):
    out = packing.pack_documents(spark.read.parquet(f"{SF001}/documents.parquet")).collect()
    used = check_sequences([(r.sequence_id, r.offset, r.length) for r in out])
    assert used <= math.ceil(1.03 * sum(r.length for r in out) / 2048) + 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20), st.integers(1, 8))
def test_plan_places_every_piece_once(lengths, groups):
    large = {n: c for n, c in lengths.items() if n > 16}
    plan, used = packing.configure(packing.group_sizes(large, groups), 64)
    ranks = [n for n in sorted(large, reverse=True) for _ in range(large[n])]
    held = np.zeros(used, int)
    if ranks:
        got = packing.Intervals(plan, 2).find(np.arange(len(ranks)))
        np.add.at(held, got[:, 1] + got[:, 0] // got[:, 2], ranks)
    assert held.max(initial=0) <= 64 and held.min(initial=1) > 0
    small = {n: c for n, c in lengths.items() if n <= 16}
    spaces = Counter((64 - held).tolist())
    intervals, new = packing.fill(small, spaces, 64)
    assert sum(small.values()) == 0 or intervals
    assert new * 64 <= 2 * 64 + 2 * sum(n * c for n, c in small.items())


@pytest.mark.parametrize("text", ["", " ", "a", "  a", "a  b", "a\nb", "a\n\nb ", "\n a", "it's 'll x's", "a\u00a0 b\u3000c", "tab\there", "é!! ?? 12ab <|endoftext|>", "x\x1c y", "no. way, 3.5"])
def test_token_ids_equal_the_tokenizers_library(text):
    from tokenizers import Tokenizer

    path = packing.public_tokenizers.path(packing.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    assert np.frombuffer(packing.token_ids(text, path), "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


SPECIAL_TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x \n<|endoftext|>\n y", "a  <|endoftext|>  b", "it's<|endoftext|>'ll", "<|endoftext|", "no token at all \n", ""]


@pytest.mark.parametrize("text", SPECIAL_TEXTS)
def test_special_token_ids_equal_the_tokenizers_library(text):
    from tokenizers import Tokenizer

    path = packing.public_tokenizers.path(packing.TOKENIZER)
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.special_token_ids(text, path), "<u4").tolist() == [*want, 0]


def test_registered_packing_gives_the_librarys_default_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from starforge.llm import queries

    texts = [*SPECIAL_TEXTS, "word <|endoftext|> " * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(packing.public_tokenizers.path(packing.TOKENIZER))
    want = []
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for n, (start, length) in enumerate(packing.cuts(len(ids), 2048)):
            want.append((i, n, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())))
    for out in (queries.op8_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == want


# quality classifier


def test_network_tells_patterns_apart():
    rng = np.random.default_rng(0)
    plain = [" ".join("".join(rng.choice(list("etaoin"), 5)) for _ in range(60)).encode() for _ in range(150)]
    junk = [b" ".join(w + b"%%%" for w in t.split()) for t in plain]
    net = quality_classifier.fit(plain[:100] + junk[:100], np.array([1] * 100 + [0] * 100), 0.5)
    held = quality_classifier.scores(net, plain[100:] + junk[100:])
    assert (held[:50, None] > held[None, 50:]).mean() > 0.98
    alone = [quality_classifier.scores(net, [t])[0] for t in (b"", plain[0], plain[0] * 30)]
    together = quality_classifier.scores(net, [b"", plain[0], plain[0] * 30])
    assert np.allclose(alone, together, atol=1e-5) and np.allclose(quality_classifier.scores(quality_classifier.constant(0.4), plain[:3]), 0.4)


def test_quality_report_edge_cases(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, "x"), (9, 0, "x"), (6, None, "x")], "doc_id long, quality int, text string")
    out = quality_classifier.quality_report(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    none = quality_classifier.quality_report(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_classifier.quality_report(empty, labels).collect() == []


# chat formatting


def test_chat_round_trip(spark):
    hard = "</s>[INST] ok [/INST] &lt; &amp; &#91; <s>[+INST]\n"
    rows = [(1, 0, "system", hard), (1, 1, "user", None), (1, 2, "user", hard), (1, 3, "assistant", hard), (1, 4, "assistant", ""), (1, 5, "assistant", "x"), (2, 0, None, "a"), (2, 0, "to]ol+[", "b"), (2, 0, "to]ol+[", "b"), (None, None, "assistant", "é"), (3, 7, "assistant", "z" * 100_000)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = chat_format.format_conversations(turns)
    back = out.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss")).alias("loss")).collect()
    by = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role, text or ""))
    assert len(back) == len(by)
    for r in back:
        assert [tuple(t) for t in r.t] == by[r.conv_id]
        assert r.loss == "".join(t for role, t in by[r.conv_id] if role == "assistant")
    assert chat_digest(turns).count() == len(by)


# empty tables


@pytest.mark.parametrize("run", [mixing.mix_report, mixing.mixed_documents, token_counts.token_counts, quality_rules.quality_rules, simhash_near_dup.near_duplicates, simhash_near_dup.keep_one, fingerprints.fingerprint_report, packing.pack_documents])
def test_empty_tables_give_no_rows(empty, run):
    assert run(empty).collect() == []


def test_empty_pages_and_conversations(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(pages, url_filter.registered_rules(spark)).collect() == []
    none = url_filter.registered_rules(spark).limit(0)
    assert [r.verdict for r in url_filter.filter_urls(spark.createDataFrame([(1, "http://a.com/")], pages.schema), none).collect()] == ["allow"]
    assert chat_format.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
