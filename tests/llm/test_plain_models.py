"""The queries of the two models against plain versions of what they compute, document by document."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from citylake.llm import language, quality
from citylake.llm.common import remainder, table
from citylake.llm.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())


def plain_score(net, raw):
    """One position after the other: filters, largest answer per block, chunks of two blocks, mean and maximum, one unit."""
    raw = raw.replace(b"\0", b"\1")
    blocks = max(1, math.ceil((len(raw) + quality.WIDTH - 2) / quality.BLOCK))
    data = raw.ljust(blocks * quality.BLOCK + quality.WIDTH, b"\0")
    best = []
    for block in range(blocks):
        top = np.zeros(quality.FILTERS)
        for at in range(block * quality.BLOCK, (block + 1) * quality.BLOCK, 2):
            answer = net.bias.copy()
            for k in range(quality.WIDTH):
                answer += net.filters[k, data[at + k]]
            top = np.maximum(top, answer)
        best.append(top)
    chunks = [np.maximum(a, b) for a, b in zip(best, best[1:], strict=False)] or best
    feature = np.concatenate([sum(chunks) / len(chunks), np.max(chunks, axis=0)])
    hidden = [math.tanh(sum(x * w for x, w in zip(feature, column, strict=True)) + b) for column, b in zip(net.inner.T, net.inner_bias, strict=True)]
    return 1 / (1 + math.exp(-max(-30, min(30, sum(h * w for h, w in zip(hidden, net.outer, strict=True)) + net.outer_bias))))


def test_op6_scores_are_those_of_the_plain_network(spark, texts):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    net = quality.learn(docs, labels.where(remainder("doc_id", 5) != 0))
    rows = QUERIES["op6_quality"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)
        if len(raw) < 6000:
            assert r["score"] == pytest.approx(plain_score(net, raw), abs=1e-5)


def trigrams(text):
    raw = b" " + b" ".join(text.lower().encode().translate(language.LETTERS_ONLY).split()) + b" "
    keys = (int.from_bytes(raw[i : i + 3], "little") * 2654435761 % 2**32 for i in range(len(raw) - 2))
    return Counter(key >> (32 - language.BITS) for key in keys)


def plain_mixture(model, counts, columns):
    share, total = [1 / len(columns)] * len(columns), sum(counts.values())
    for _ in range(language.ROUNDS):
        moved = [0.0] * len(columns)
        for bucket, n in counts.items():
            parts = [s * model.likelihood[bucket, c] for s, c in zip(share, columns, strict=True)]
            for i, part in enumerate(parts):
                moved[i] += n * part / sum(parts) / total
        done = max(abs(a - b) for a, b in zip(moved, share, strict=True)) < 1e-4
        share = moved
        if done:
            break
    reached = sum(n * math.log(sum(s * model.likelihood[b, c] for s, c in zip(share, columns, strict=True))) for b, n in counts.items())
    return share, reached


def plain_language(model, text):
    """Every further language is tried; the best one is taken while it pays for itself."""
    counts = trigrams(text)
    if not any(c.isalpha() for c in text) or not counts:
        return "und", 0.0
    noise, total = len(model.languages), sum(counts.values())
    alone = [sum(n * math.log(model.likelihood[b, c]) for b, n in counts.items()) for c in range(noise)]
    chosen = [max(range(noise), key=lambda c: alone[c])]
    share, reached = plain_mixture(model, counts, [*chosen, noise])
    while len(chosen) < noise:
        gains = {}
        for c in set(range(noise)) - set(chosen):
            gains[c] = sum(n * model.likelihood[b, c] / sum(s * model.likelihood[b, k] for s, k in zip(share, [*chosen, noise], strict=True)) for b, n in counts.items())
        best = max(gains, key=gains.get)
        if gains[best] <= total:
            break
        wider, higher = plain_mixture(model, counts, [*chosen, best, noise])
        if higher - reached <= language.PENALTY * math.log(1 + total):
            break
        chosen, share, reached = [*chosen, best], wider, higher
    at = max(range(len(chosen)), key=lambda i: (share[i], -chosen[i]))
    return model.languages[chosen[at]], share[at]


def test_op8_predictions_are_those_of_the_plain_mixture(spark, texts):
    docs = table(spark, SMALL, "documents")
    model = language.learn(docs.where(remainder("doc_id", 4) != 2))
    rows = QUERIES["op8_language_id"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        text = texts[r["doc_id"]] or ""
        if len(text) < 900:
            name, score = plain_language(model, text)
            assert r["lang_pred"] == name and r["score"] == pytest.approx(score, abs=1e-6)
