from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, kept string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns whose names clash with those inside the operators."""
    rng = random.Random(3)
    words = ["the", "étre", "ab", "token", "x1", "zoo", "mañana", "Über", "and", "of", "secret", "=", "日本", "a\u0301b"]
    texts = [None, "", " ", "a", "A", "the the the", "\n\n  \t", "same text here", "same text here", "same text here", "word " * 30_000, "…—", "<|endoftext|> x", "it's  we'll\n\n\nok ", "½ ² x_y ǅ", "a" * 5000]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = [(k, t, "en" if k % 3 else None, "s", 0, "f", "k") for k, t in enumerate(texts)]
    rows += [(7, "same text here", "en", "s", 0, None, None), (3, "a", None, None, None, None, None), (None, "same text here", "en", "s", 0, "f", "k"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
