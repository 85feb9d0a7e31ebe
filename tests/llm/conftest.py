from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, fp string, piece string"

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n ", "fr", None),
    (6, LONG, "en", "a"),
    (7, "Ça va très bien, merci à tous les élèves de l'école\nÇa va\nÇa va\n", "fr", None),
    (7, "Ça va très bien, merci à tous les élèves de l'école\nÇa va\nÇa va\n", "fr", None),
    (None, "no id here but some words of text", "en", "b"),
    (9, "<|endoftext|> 12 ## $$ && \u00a0x  y\tz", "en", "b"),
    (9, "the same id with another text", "en", "b"),
    (-5, "x", None, "c"),
]


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    """Nulls, empty and long texts, copies, repeated rows and ids, and columns whose names clash with outputs."""
    rows = [(i, t, lang, s, len(t or ""), "s", "x", "f", "p") for i, t, lang, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)
