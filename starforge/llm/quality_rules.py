"""Quality rules with host-level verdicts.

Every text is measured once (Arrow, whole texts): words, their characters,
symbols, repeated lines, words in repeated windows. Each rule fails or passes a
document. Failures are counted per domain and rule (two small sums per domain,
combined before the shuffle, so a hot domain is no hot task), the domains' rates
give a beta prior per rule by the method of moments, and a domain's rate is
shrunk to its posterior mean: a domain of few documents stays near the prior. A
domain is rejected if, for some rule, its shrunk rate lies more than ``LIMIT``
standard deviations of the prior above the prior's mean, so what counts as bad
follows from the other domains; the verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined, slices, stage, sums

WINDOW = 8  # words of a repeated window
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

# rule: failure of a document
RULES = {
    "base": "n_words < 20 or 100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
LIMIT = 3.0


def repeated_words(ids: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window that its document holds at least twice.

    ``ids`` are word numbers of several documents in a row, ``doc`` the
    document of each. Exact: windows are numbered by doubling (a pair of
    numbered halves gets a number), without hashes.
    """
    covered = np.zeros(len(ids), bool)
    if len(ids) < window:
        return covered
    names, width = ids.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        pair = names[: len(names) - step] * (int(names.max()) + 1) + names[step:]
        names, width = np.unique(pair, return_inverse=True)[1].astype(np.int64), width + step
    inside = doc[: len(names)] == doc[window - 1 :]
    place = np.flatnonzero(inside)
    key = names[place] * (int(doc[-1]) + 1) + doc[place]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    first = place[count[inverse] > 1]
    for j in range(window):
        covered[first + j] = True
    return covered


def measures(texts: list[bytes]) -> np.ndarray:
    """Rows of ``MEASURES`` for UTF-8 texts."""
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    raw, starts = joined(texts)
    blank = np.isin(raw, np.frombuffer(BLANKS, np.uint8))
    lead = (raw & 0xC0) != 0x80
    out[:, 1] = sums(lead & ~blank, starts)
    out[:, 2] = sums(np.isin(raw, np.frombuffer(SYMBOLS, np.uint8)), starts)
    words = [t.split() for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out[:, 0] = lengths
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, int(lengths.sum()))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    out[:, 5] = sums(repeated_words(ids, np.repeat(np.arange(len(words)), lengths)), edges)
    for i, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
        out[i, 3], out[i, 4] = len(lines) - len(set(lines)), len(lines)
    return out


def with_measures(docs: DataFrame, text: str = "text", out: str = "m") -> DataFrame:
    """``docs`` with a struct of the measures of ``text`` (null: no words)."""
    kind = "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">"

    @F.arrow_udf(kind)
    def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            values = np.zeros((len(texts), len(MEASURES)), np.int64)
            for first, held in slices(texts):
                values[first : first + len(held)] = measures(held)
            yield pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(len(MEASURES))], list(MEASURES))

    return docs.withColumn(out, measure(F.col(text)))


@dataclass(frozen=True)
class Beta:
    """Prior of a rule's failure rate over domains."""

    a: float
    b: float

    def limit(self, deviations: float) -> float:
        """The prior's mean and so many of its standard deviations."""
        mean = self.a / (self.a + self.b)
        return mean + deviations * (mean * (1 - mean) / (self.a + self.b + 1)) ** 0.5


def prior(domains: int, mean: float | None, variance: float | None) -> Beta:
    """Method of moments over the domains' rates; with fewer than two domains,
    no spread, or only 0s or 1s, a prior as strong as one document per domain."""
    if not domains or mean is None:
        return Beta(1.0, 1.0)
    if domains < 2 or not variance or variance >= mean * (1 - mean):
        return Beta(mean + 1e-6, 1 - mean + 1e-6)
    strength = mean * (1 - mean) / variance - 1
    return Beta(mean * strength, (1 - mean) * strength)


def domain_verdicts(measured: DataFrame, domain: str, rules: dict = RULES, limit: float = LIMIT) -> DataFrame:
    """(domain, n_docs, per rule its shrunk rate, domain_failed).

    ``measured`` holds one row per document with the rules' columns. The
    prior's moments are one row; a null domain is a domain.
    """
    counts = stage(
        measured.groupBy(F.col(domain).alias("domain")).agg(F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.expr(f"cast({test} as bigint)")).alias(f"fail_{r}") for r, test in rules.items()]),
        "domain-counts",
    )
    rate = {r: F.col(f"fail_{r}") / F.col("n_docs") for r in rules}
    moments = counts.agg(F.count(F.lit(1)).alias("domains"), *[x for r in rules for x in (F.avg(rate[r]).alias(f"m_{r}"), F.var_samp(rate[r]).alias(f"v_{r}"))]).first()
    out, failed = counts, F.lit(False)
    for r in rules:
        p = prior(moments["domains"], moments[f"m_{r}"], moments[f"v_{r}"])
        out = out.withColumn(f"rate_{r}", (F.col(f"fail_{r}") + p.a) / (F.col("n_docs") + p.a + p.b))
        failed = failed | (F.col(f"rate_{r}") > p.limit(limit))
    return out.select("domain", "n_docs", *[f"rate_{r}" for r in rules], failed.alias("domain_failed"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", domain: str = "source", rules: dict = RULES, limit: float = LIMIT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, domain_failed, kept: one row per input row.

    Null and empty texts have no words and fail the base rule. Documents of a
    null domain form a domain. Repeated rows and ids stay. Empty tables give no
    rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(domain).alias("domain"), F.col(text).alias("text"))
    measured = stage(with_measures(rows).select("doc_id", "domain", "m.*"), "quality-measures")
    verdict = domain_verdicts(measured, "domain", rules, limit).select(F.col("domain").alias("_domain"), "domain_failed")
    base = F.expr(rules["base"])
    return measured.join(verdict, F.col("domain").eqNullSafe(F.col("_domain"))).select(
        "doc_id", *[m for m in MEASURES if m != "n_lines"], base.alias("base_failed"), "domain_failed", (~base & ~F.col("domain_failed")).alias("kept")
    )
