from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    long_text = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
    return [
        (1, None, None, None, None),
        (None, "a row without an id", "en", None, 3),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, "a", 4),
        (4, long_text, "en", "b", len(long_text)),
        (5, "Same words here, twice.", "en", "b", 23),
        (5, "Same words here, twice.", "en", "b", 23),
        (6, "Same words here, twice.", "fr", None, 23),
        (7, "12345 !!! 678", "de", "c", 13),
        (8, "ümläüt é ñ 中文 Ω", "de", "c", 16),
    ]


@pytest.fixture
def clashing():
    """Adds columns with the names the operators use themselves."""

    def add(df):
        names = ["lang_pred", "score", "shard", "slot", "n_words", "hits", "item_ids", "_node", "_keys", "id", "h", "doc", "band", "key", "size", "taken", "target", "_start", "_key", "_left", "_right", "_dim", "_bucket", "_weight", "_before", "_inside", "_times", "_id", "_copy", "_taken", "_size", "_s", "_name", "c0", "c1"]
        return df.selectExpr("*", *(f"'{n}' as {n}" for n in names if n not in df.columns))

    return add


@pytest.fixture
def prose():
    """Seeded words of a made-up language."""

    def make(seed, n, stems="ka lo mi ne pu ra si to"):
        rng, parts = random.Random(seed), stems.split()
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make
