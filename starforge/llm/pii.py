"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans; these always stay. Patterns lose what stands beside
other numbers (a card after a digit, a phone before an address) and what is written
otherwise a second time (a phone without its plus). The field finds such spans.

Its variables are the document's tokens that hold a digit or an at sign (every
other token can only be outside). Labels: outside, email, ip, first and further
token of a card and of a phone. Potentials: a token's form; adjacent tokens; and,
for distant repeated or similar tokens (the same last seven digits, the same
address, the same mailbox), a shared variable for what that entity is, joined to
every occurrence. So the work is linear in the occurrences, and one clear
occurrence decides the unclear ones. Tokens of base spans are observed. A form
that cannot be of a kind excludes its labels (hard potentials), and an added span
must pass the kind's own check (Luhn, digit counts, parts).

Steps: (1) every whole text once: base spans and tokens, written; (2) the
weights, by piecewise training on the tokens of base spans and those outside any
match that are nowhere in one: their forms, their neighbours' labels and their
other occurrences' kind. Equal cases are
counted in Spark, so the driver gets one row per different case of a fixed
alphabet, over all documents; (3) loopy belief propagation for all tokens of some
documents at once, in numpy, and the added spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage

KINDS = ("email", "ip", "card", "phone")

# The base patterns (fixed values of the contract); an email's user part is found backwards from its at sign.
USER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Tokens
ANY = re.compile(r"[0-9@]")
REST = re.compile(r"[^\x20\x09-\x0D]+")
MAILBOX = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
NUMBER = re.compile(r"[0-9().+-]*[0-9][0-9().+-]*")
SPACES = frozenset(" \t\n\x0b\f\r")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")

OUTSIDE, EMAIL, IP, CARD_B, CARD_I, PHONE_B, PHONE_I = range(7)
LABELS = 7
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])  # 0: none, then KINDS
FIRST = {1: EMAIL, 2: IP, 3: CARD_B, 4: PHONE_B}
FURTHER = {1: EMAIL, 2: IP, 3: CARD_I, 4: PHONE_I}
NONE, UNSURE = 7, 8  # neighbour: there is none; label: in a failed match together with another token
NO_ENTITY = 5
NEVER = -1e3
CONSISTENT = 0.01  # cases of disagreement to one of agreement that are added to an entity's occurrences

# Bits of a token's form
IS_EMAIL, IS_MAILBOX, IS_IP, BAD_IP, IS_DOTTED, PLUS, PAREN, HYPHEN, LUHN = (1 << i for i in range(9))
SIZES = (1, 2, 3, 4, 6, 7, 9, 12, 15, 16, 19)  # digits up to, a bit each; one more for longer ones
BEFORE, AFTER, NAMED = (1 << i for i in range(21, 24))  # a token is next to it; the word before ends with : or =
FORM_BITS = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += (2 * x - 9 if x > 4 else 2 * x) if i % 2 else x
    return total % 10 == 0


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_part(digits: str) -> bool:
    """A number of at most 255, however many zeros lead it."""
    own = digits.lstrip("0")
    return len(own) <= 3 and int(own or 0) <= 255


def addresses(text: str, domain: re.Pattern, lo: int = 0, hi: int | None = None) -> list[tuple[int, int]]:
    """Leftmost non-overlapping user@domain; every character is looked at a few times only."""
    out, end, hi = [], lo, len(text) if hi is None else hi
    at = text.find("@", lo, hi)
    while at >= 0:
        start = at
        while start > end and text[start - 1] in USER:
            start -= 1
        m = domain.match(text, at + 1, hi) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end), hi)
    return out


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((kind 1.., start, end) by kind and start, (start, end) of card and phone matches that failed)."""
    out, failed = [(1, s, e) for s, e in addresses(text, DOMAIN)], []
    for m in DOTTED.finditer(text):
        if text.find(".", m.start(), m.end()) < 0:
            continue
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = start + sum(map(len, own)) + 3
            if all(map(is_part, own)):
                out.append((2, start, end))
            start = end + 1
    for kind, pattern, fits in ((3, CARD, is_card), (4, PHONE, lambda d: 9 <= len(d) <= 15)):
        for m in pattern.finditer(text):
            if fits(NOT_DIGIT.sub("", m.group())):
                out.append((kind, *m.span()))
            else:
                failed.append(m.span())
    return out, failed


def words(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the words that hold a digit or an at sign."""
    m = ANY.search(text)
    last = 0
    while m:
        start = m.start()
        while start > last and text[start - 1] not in SPACES:
            start -= 1
        last = REST.match(text, start).end()
        yield start, last
        m = ANY.search(text, last)


def parts(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, with an at sign) of the field's tokens: addresses, and numbers that no letter touches."""
    for start, end in words(text):
        at = addresses(text, MAILBOX, start, end)
        yield from ((s, e, True) for s, e in at)
        for m in NUMBER.finditer(text, start, end):
            s, e = m.span()
            while text[s] in ").-":
                s += 1
            while text[e - 1] in "(.+-":
                e -= 1
            touched = (s > start and text[s - 1] in LETTERS) or (e < end and text[e] in LETTERS)
            if not touched and not any(a < e and s < b for a, b in at):
                yield s, e, False


def form(text: str, start: int, end: int, mail: bool) -> tuple[int, int, int, int]:
    """(form bits, entity key or 0, its digits as a number, how many; 0 with more than 19)."""
    own = text[start:end]
    if mail:
        user, domain = own.split("@", 1)
        box = f"{user}@{domain.split('.', 1)[0]}".lower()  # the mailbox and its host's first name
        return IS_EMAIL if DOMAIN.fullmatch(domain) else IS_MAILBOX, zlib.crc32(box.encode()) + 1, 0, 0
    digits = NOT_DIGIT.sub("", own)
    n = len(digits)
    size = next((i for i, most in enumerate(SIZES) if n <= most), len(SIZES))
    bits = 1 << 9 + size
    numbers = own.split(".") if "." in own else []
    if len(numbers) == 4 and all(map(str.isdigit, numbers)) and all(map(is_part, numbers)):
        return bits | IS_IP, zlib.crc32(own.encode()) + (1 << 40), int(digits), n
    bits |= (BAD_IP if len(numbers) > 3 else IS_DOTTED) if numbers else 0
    bits |= (PLUS if own[0] == "+" else 0) | (PAREN if "(" in own or ")" in own else 0) | (HYPHEN if "-" in own else 0) | (LUHN if is_card(digits) else 0)
    return bits, (1 << 41) + int(digits[-7:]) if 7 <= n else 0, int(digits) if n <= 19 else 0, n if n <= 19 else 0


@dataclass
class Tokens:
    """Columns of a document's tokens; ``joins``: the next token follows after blanks only."""

    start: list[int]
    end: list[int]
    form: list[int]
    key: list[int]
    value: list[int]
    digits: list[int]
    label: list[int]  # base label, OUTSIDE, or UNSURE
    joins: list[int]

    TYPES = (np.int32, np.int32, np.int32, np.int64, np.uint64, np.int8, np.int8, np.int8)


def tokens(text: str, spans: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> Tokens:
    out = Tokens([], [], [], [], [], [], [], [])
    begins = sorted((s, e, k) for k, s, e in spans)
    at, open_ = 0, []
    lost, lost_at, lost_start, lost_end = sorted(failed), 0, 0, 0
    seen: set[tuple[int, int, int]] = set()
    for start, end, mail in parts(text):
        while at < len(begins) and begins[at][0] < end:
            open_.append(begins[at])
            at += 1
        open_ = [x for x in open_ if x[1] > start]
        while lost_at < len(lost) and lost[lost_at][0] < end:
            if lost[lost_at][0] >= lost_end:
                lost_start = lost[lost_at][0]
            lost_end = max(lost_end, lost[lost_at][1])
            lost_at += 1
        bits, key, value, digits = form(text, start, end, mail)
        over = min(open_, key=lambda x: x[2], default=None)
        if over:
            label = (FURTHER if over in seen else FIRST)[over[2]]
            seen.add(over)
        else:
            label = UNSURE if lost_end > start and (lost_start < start or lost_end > end) else OUTSIDE
        joined = bool(out.end) and start > out.end[-1] and not text[out.end[-1] : start].strip(" ")
        if joined:
            out.joins[-1] = 1
            out.form[-1] |= AFTER
            bits |= BEFORE
        if start > 1 and text[start - 1] == " " and text[start - 2] in ":=":
            bits |= NAMED
        for column, x in zip((out.start, out.end, out.form, out.key, out.value, out.digits, out.label, out.joins), (start, end, bits, key, value, digits, label, 0)):
            column.append(x)
    return out


def allowed(form: np.ndarray) -> np.ndarray:
    """Which labels a form can have (one row per token)."""
    has = lambda bits: (form & bits) != 0
    mail, size = has(IS_EMAIL | IS_MAILBOX), lambda n: (form >> 9 & (2 << SIZES.index(n)) - 1) != 0
    out = np.ones((len(form), LABELS), bool)
    out[:, EMAIL], out[:, IP] = mail, has(IS_IP)
    out[:, CARD_B] = ~mail & ~has(PLUS | PAREN | IS_IP | BAD_IP | IS_DOTTED) & size(19)
    out[:, PHONE_B] = ~mail & ~has(IS_IP | BAD_IP) & size(15)
    out[:, CARD_I], out[:, PHONE_I] = out[:, CARD_B], out[:, PHONE_B]
    return out


@dataclass
class Field:
    """``forms`` (bits + 1, labels), the last row for every token; ``steps`` (label, next label);
    ``entity`` (entity's kind, label's kind)."""

    forms: np.ndarray
    steps: np.ndarray
    entity: np.ndarray

    def unary(self, form: np.ndarray) -> np.ndarray:
        bits = (form[:, None] >> np.arange(FORM_BITS) & 1).astype(float)
        return np.where(allowed(form), bits @ self.forms[:-1] + self.forms[-1], NEVER)


def possible_steps() -> np.ndarray:
    out = np.zeros((LABELS, LABELS))
    for further, first in ((CARD_I, CARD_B), (PHONE_I, PHONE_B)):
        out[:, further] = NEVER
        out[[first, further], further] = 0
    return out


def _association(a: np.ndarray, b: np.ndarray, weight: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """log of how often a and b meet against how often they would by chance, one case added to either."""
    n = np.zeros(shape)
    np.add.at(n, (a, b), weight)
    return np.log((n + 1) / (np.outer(n.sum(axis=1), n.sum(axis=0)) / max(1.0, n.sum()) + 1))


def fit(cases: np.ndarray, weight: np.ndarray, rounds: int = 1500, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """The field of ``cases`` (form, label, label before, label after, other occurrences' kind), each counted
    ``weight`` times.

    Each kind of potential is learned as a piece of its own (together, a clear form
    would explain a label before its other occurrences do): forms by logistic
    regression, adjacent labels by their association, an entity's occurrences by the
    share of each kind among them.
    """
    bits, hard = np.zeros((FORM_BITS + 1, LABELS)), possible_steps()
    bits[-1, OUTSIDE] = 2.0
    start = bits
    fits = allowed(cases[:, 0])[np.arange(len(cases)), cases[:, 1]] if len(cases) else np.zeros(0, bool)  # a base span may cut its token's form
    cases, weight = cases[fits], weight[fits]
    if not len(cases):
        return Field(bits, hard, np.zeros((5, 5)))
    joined, again = cases[:, 3] != NONE, cases[:, 4] != NO_ENTITY
    steps = _association(cases[joined, 1], cases[joined, 3], weight[joined], (LABELS, LABELS))
    entity = np.eye(5) + CONSISTENT  # how often an occurrence is of a kind if the others are of another
    np.add.at(entity, (cases[again, 4], KIND_OF[cases[again, 1]]), weight[again])
    entity = np.log(entity / entity.sum(axis=1, keepdims=True))
    # a form that no pattern knows is outside unless the corpus says otherwise
    unknown = np.array([1 << i for i in range(FORM_BITS) if not 1 << i & (IS_EMAIL | IS_IP | LUHN)])
    form, label = np.concatenate([cases[:, 0], unknown]), np.concatenate([cases[:, 1], np.full(len(unknown), OUTSIDE)])
    w = np.log1p(np.concatenate([weight, np.ones(len(unknown))]))[:, None]  # frequent cases do not drown the rare ones
    w /= w.sum()
    x, can, goal = np.column_stack([form[:, None] >> np.arange(FORM_BITS) & 1, np.ones(len(form))]).astype(float), allowed(form), np.eye(LABELS)[label]
    speed = np.zeros_like(bits)
    for _ in range(rounds):
        ahead = bits + 0.9 * speed
        z = np.where(can, x @ ahead, NEVER)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        speed = 0.9 * speed - rate * (x.T @ (w * (p / p.sum(axis=1, keepdims=True) - goal)) + decay * (ahead - start))
        bits = bits + speed
    return Field(bits, steps + hard, entity)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def beliefs(field: Field, form: np.ndarray, seen: np.ndarray, joins: np.ndarray, entity: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Label probabilities (tokens, labels) by loopy message passing.

    ``seen``: an observed label or -1. ``joins``: chained to the next token.
    ``entity``: number of the token's entity from 0, or -1. Every round all
    messages are sent at once; it ends when they no longer change.
    """
    n = len(form)
    own = field.unary(form)
    first = np.concatenate([[True], ~joins[:-1]]) if n else np.zeros(0, bool)
    own[np.ix_(first, [CARD_I, PHONE_I])] = NEVER
    fixed = seen >= 0
    own[fixed] = NEVER
    own[fixed, seen[fixed]] = 0
    link = np.flatnonzero(joins)
    member = np.flatnonzero(entity >= 0)
    group = entity[member]
    agree = field.entity[:, KIND_OF]  # (entity's kind, label)
    ahead, back, shared = (np.zeros((n, LABELS)) for _ in range(3))
    for _ in range(rounds):
        here = own + shared
        to_next, to_last, to_all = np.zeros((n, LABELS)), np.zeros((n, LABELS)), np.zeros((n, LABELS))
        if len(link):
            m = _logsum((here + ahead)[link][:, :, None] + field.steps[None], 1)
            to_next[link + 1] = m - m.max(axis=1, keepdims=True)
            m = _logsum((here + back)[link + 1][:, None, :] + field.steps[None], 2)
            to_last[link] = m - m.max(axis=1, keepdims=True)
        if len(member):
            up = _logsum((own + ahead + back)[member][:, None, :] + agree[None], 2)  # what each occurrence says of the entity
            up -= up.max(axis=1, keepdims=True)
            total = np.zeros((int(group.max()) + 1, up.shape[1]))
            np.add.at(total, group, up)
            m = _logsum((total[group] - up)[:, :, None] + agree[None], 1)
            to_all[member] = m - m.max(axis=1, keepdims=True)
        change = max(np.abs(to_next - ahead).max(initial=0), np.abs(to_last - back).max(initial=0), np.abs(to_all - shared).max(initial=0))
        ahead, back, shared = to_next, to_last, to_all
        if change < 1e-4:
            break
    z = own + ahead + back + shared
    p = np.exp(z - z.max(axis=1, keepdims=True)) if n else z
    return p / p.sum(axis=1, keepdims=True)


def added_spans(label: np.ndarray, seen: np.ndarray, joins: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray, digits: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of unobserved tokens with a label, that pass their kind's check."""
    out = []
    free = np.flatnonzero((seen < 0) & (label != OUTSIDE))
    i = 0
    while i < len(free):
        run = [free[i]]
        i += 1
        more = {CARD_B: CARD_I, PHONE_B: PHONE_I}.get(int(label[run[0]]))
        while more and i < len(free) and free[i] == run[-1] + 1 and joins[run[-1]] and label[free[i]] == more:
            run.append(free[i])
            i += 1
        kind = int(KIND_OF[label[run[0]]])
        text = "".join(str(int(value[t])).zfill(int(digits[t])) for t in run) if kind > 2 else ""
        if kind <= 2 or (is_card(text) if kind == 3 else 9 <= len(text) <= 15):
            out.append((kind, int(start[run[0]]), int(end[run[-1]])))
    return out


ROW = "doc_id long, base binary, " + ", ".join(f"{c} binary" for c in ("start", "end", "form", "key", "value", "digits", "label", "joins"))


def found_tokens(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``ROW``, written: every document's base spans (triples of 32-bit numbers) and tokens (a column of numbers each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                rows = []
                for raw in part:
                    own = raw.decode("utf-8", "replace")
                    spans, failed = base_spans(own) if ANY.search(own) else ([], [])
                    columns = list(vars(tokens(own, spans, failed)).values())
                    rows.append([np.array(spans, np.int32).tobytes(), *(np.array(c, t).tobytes() for c, t in zip(columns, Tokens.TYPES))])
                columns = [pa.array(c, pa.binary()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *columns], [c.split()[0] for c in ROW.split(", ")])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(read, ROW), "pii-tokens")


@dataclass
class Batch:
    """The tokens of some documents, one document after another."""

    edges: np.ndarray
    start: np.ndarray
    end: np.ndarray
    form: np.ndarray
    value: np.ndarray
    digits: np.ndarray
    label: np.ndarray
    joins: np.ndarray
    entity: np.ndarray  # numbered over all documents; -1: not repeated


def batch_of(columns: dict[str, list[bytes]]) -> Batch:
    names = ("start", "end", "form", "key", "value", "digits", "label", "joins")
    flat = {c: np.frombuffer(b"".join(columns[c]), t) for c, t in zip(names, Tokens.TYPES)}
    edges = np.concatenate(([0], np.cumsum([len(x) for x in columns["digits"]]))).astype(np.int64)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((flat["key"], owner))
    key, doc = flat["key"][order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    number = np.cumsum(new) - 1
    often = (np.bincount(number, minlength=1)[number] > 1) & (key != 0) if len(order) else np.zeros(0, bool)
    entity = np.full(len(order), -1, np.int64)
    if often.any():
        entity[order[often]] = np.unique(number[often], return_inverse=True)[1]
    return Batch(edges, flat["start"], flat["end"], flat["form"], flat["value"], flat["digits"], flat["label"], flat["joins"].astype(bool), entity)


def cases(b: Batch) -> np.ndarray:
    """(form, label, label before, label after, other occurrences' kind) of every token whose label is known."""
    n = len(b.label)
    label = np.where(b.label == UNSURE, NONE, b.label).astype(np.int64)
    before, after = np.full(n, NONE), np.full(n, NONE)
    link = np.flatnonzero(b.joins)
    before[link + 1], after[link] = label[link], label[link + 1]
    kind = np.full(n, NO_ENTITY)
    member = np.flatnonzero((b.entity >= 0) & (b.label != UNSURE))
    if len(member):
        votes = np.zeros((int(b.entity.max()) + 1, 5), np.int64)
        own = KIND_OF[label[member]]
        np.add.at(votes, (b.entity[member], own), 1)
        votes[votes[:, 1:].any(axis=1), 0] = 0  # what the patterns did not find there is not known to be outside
        own = np.where(votes[b.entity[member], 0] + own > 0, own, -1)
        others = votes[b.entity[member]]
        others[np.flatnonzero(own >= 0), own[own >= 0]] -= 1
        kind[member] = np.where(others.sum(axis=1) > 0, others.argmax(axis=1), NO_ENTITY)
    # outside by the patterns, but personal data where it occurs again: what the field is to decide
    known = (b.label != UNSURE) & ~((b.label == OUTSIDE) & (kind > 0) & (kind != NO_ENTITY))
    return np.column_stack([b.form, label, before, after, kind])[known].astype(np.int64)


CASE = ("form", "label", "before", "after", "kind")
CASE_TYPES = ", ".join(f"{c} long" for c in (*CASE, "n"))
COLUMNS = ("start", "end", "form", "key", "value", "digits", "label", "joins")
HELD_TOKENS = 50_000  # of whole documents that are worked on at once


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Batch]]:
    for batch in batches:
        sizes = np.array([len(x) for x in batch.column(batch.schema.get_field_index("digits")).to_pylist()])
        part = np.cumsum(sizes) // HELD_TOKENS
        cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for s, e in zip(cut, cut[1:]):
            if e > s:
                rows = batch.slice(s, e - s)
                yield rows, batch_of({c: rows.column(rows.schema.get_field_index(c)).to_pylist() for c in COLUMNS})


def learn(found: DataFrame) -> Field:
    """The field's weights from the tokens of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, b in _batches(batches):
            rows, n = np.unique(cases(b), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*rows.T, n)], [*CASE, "n"])

    rows = found.where(F.octet_length("digits") > 0).select(*COLUMNS).mapInArrow(count, CASE_TYPES)
    got = rows.groupBy(*CASE).agg(F.sum("n").alias("n")).orderBy(*CASE).toArrow()  # one row per different case; forms are a few hundred
    return fit(np.column_stack([got[c].to_numpy() for c in CASE]).astype(np.int64), got["n"].to_numpy().astype(float))


def _text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{s}:{e}" for k, s, e in spans)


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (with the added ones), n_added:
    one row per input row.

    Null and empty texts hold nothing. Repeated rows and ids stay; an empty
    table gives no rows; other columns are ignored. A very long text is read
    whole by its task; its field holds its tokens with digits or at signs.
    """
    found = found_tokens(docs, doc_id, text)
    held = docs.sparkSession.sparkContext.broadcast(learn(found))  # some hundred numbers

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, b in _batches(batches):
            seen = np.where((b.label == OUTSIDE) | (b.label == UNSURE), -1, b.label)
            label = beliefs(held.value, b.form, seen, b.joins, b.entity).argmax(axis=1) if len(seen) else seen
            counts, shas, texts, more = [], [], [], []
            for raw, s, e in zip(rows.column(1).to_pylist(), b.edges, b.edges[1:]):
                base = [tuple(x) for x in np.frombuffer(raw, np.int32).reshape(-1, 3).tolist()]
                own = slice(s, e)
                new = added_spans(label[own], seen[own], b.joins[own], b.start[own], b.end[own], b.value[own], b.digits[own])
                if new and base:
                    order = sorted((x[1], x[2]) for x in base)
                    starts, ends = np.array([x[0] for x in order]), np.maximum.accumulate([x[1] for x in order])
                    before = [int(np.searchsorted(starts, x[2])) for x in new]  # base spans that begin before its end
                    new = [x for x, i in zip(new, before) if i == 0 or ends[i - 1] <= x[1]]
                counts.append(np.bincount([k for k, _, _ in base], minlength=5)[1:])
                shas.append(hashlib.sha256(_text(base).encode()).hexdigest())
                texts.append(_text(sorted(base + new)))
                more.append(len(new))
            n = np.array(counts, np.int64).reshape(-1, 4)
            columns = [rows.column(0), *(pa.array(c) for c in n.T), pa.array(shas, pa.string()), pa.array(texts, pa.string()), pa.array(more, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return found.mapInArrow(mark, RESULT)
