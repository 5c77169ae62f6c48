"""Periodic runs against every period tried, and the query against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from citylake.llm import periodic
from citylake.llm.queries import QUERIES, planted
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS


def plain(words, exponent=4, shortest=6):
    """Every period and every stretch that keeps it; a stretch that keeps a smaller period too is left to that one."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found, at = [], np.array([numbers[w] for w in words])
    for period in range(1, len(words) // exponent + 1):
        edges = np.diff(np.concatenate(([0], at[period:] == at[:-period], [0])).astype(int))
        for start, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            part = words[start : end + period]
            long = len(part) >= max(shortest, exponent * period)
            if long and not any(part[q:] == part[:-q] for q in range(1, period)):
                found.append((start, len(part), period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def left(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_words(rng, letters, most):
    words = []
    while len(words) < rng.randint(1, most):
        words += [b"%d" % rng.randint(0, letters) for _ in range(rng.randint(1, 7))] * rng.randint(1, 8)
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_match_every_period(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = periodic_words(rng, rng.randint(1, 4), 70)
        found = periodic.runs_of(words)
        assert found == plain(words)
        assert periodic.runs_in([int(w) + 1 for w in words]) == found
        assert periodic.collapsed(words, found) == left(words, found)


@pytest.mark.parametrize(("exponent", "shortest"), [(2, 2), (2, 9), (3, 1), (3, 12), (5, 6)])
def test_other_limits(exponent, shortest):
    rng = random.Random(exponent * 100 + shortest)
    for _ in range(150):
        words = periodic_words(rng, rng.randint(1, 3), 50)
        assert periodic.runs_of(words, exponent, shortest) == plain(words, exponent, shortest)


def test_common_extensions():
    rng = random.Random(3)
    for _ in range(20):
        text = [rng.randint(1, 3) for _ in range(rng.randint(2, 120))]
        pairs = [(i, j) for i in range(len(text) + 1) for j in range(len(text) + 1) if i != j]
        i, j = np.array(pairs).T
        want = [next((k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), len(text)) for a, b in pairs]
        assert periodic.Extensions(text).common(i, j).tolist() == want


def test_a_long_periodic_text():
    words = [b"w%d" % (i % 4000) for i in range(40_000)]
    assert periodic.runs_of(words) == [(0, 40_000, 4000)]
    assert periodic.runs_of([b"x"] * 30_000) == [(0, 30_000, 1)]


def test_edge_rows(spark, edge_rows, clashing):
    rows = [*edge_rows, (9, "on and on and on and on and off", "en", "s", 1), (None, "no " * 6, None, None, None)]
    found = periodic.collapse(clashing(spark.createDataFrame(rows, DOCUMENTS)))
    assert found.columns == ["doc_id", "n_words", "runs", "kept"]
    got = sorted(((r["doc_id"], r["kept"], [tuple(x) for x in r["runs"]]) for r in found.collect()), key=str)
    want = []
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        runs = plain(words)
        want.append((doc, b" ".join(left(words, runs)).decode(), runs))
    assert got == sorted(want, key=str)
    assert (9, "on and off", [(0, 8, 2)]) in got
    assert periodic.collapse(spark.createDataFrame([], DOCUMENTS)).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse(spark.createDataFrame([], DOCUMENTS), exponent=1)


def test_query_matches_plain_version(spark):
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = []
    texts = {d: (t or "").encode() for d, t in duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()}
    for doc, raw in texts.items():
        words, h = raw.split(), zlib.crc32(str(doc).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert words == planted(doc, raw)
        runs = plain(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc, len(runs), *numbers, sha(b"".join(b"%d,%d,%d\n" % r for r in runs)), sha(b" ".join(left(words, runs)))))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    rows = QUERIES["op11_periodic_runs"](spark, SMALL).select(*names).collect()
    assert len(rows) == len(texts) and sum(w[1] for w in want) > 0
    have = {r["doc_id"]: tuple(r) for r in rows}
    assert [have[w[0]] for w in want] == want
