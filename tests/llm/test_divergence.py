"""The divergence audit against plain counting in whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from citylake.llm import divergence as dv
from tests.llm.conftest import DOCUMENTS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=5):
    lower = {c: c + 32 for c in range(65, 91)}
    groups, docs, counts = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(lower))
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def share(source, term, lang=lang, kept=kept):
            total = sum(counts[lang, source][t] for t in kept)
            return 1 + 1_000_000_000 * (counts[lang, source][term] + 5) // (total + 5 * len(kept))

        sources = [s for x, s in groups if x == lang]
        shares = {s: {t: share(s, t) for t in kept} for s in [*sources, None]}
        for a in sources:
            pair = [(-sum(abs(shares[a][t] - shares[b][t]) for t in kept), b.encode(), b) for b in sources if b != a]
            term = [(shares[None][t] - shares[a][t], t.encode(), t) for t in kept if counts[lang, a][t] and shares[a][t] > shares[None][t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                out += [(lang, a, part, item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def made(seed, docs=300, sources=7, words=90):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéZß") for _ in range(rng.randint(1, 4))) for _ in range(words)]
    rows = []
    for i in range(docs):
        source = f"s{rng.randint(0, sources)}" if rng.random() < 0.7 else "hot"
        lean = int(rng.random() * 20)
        text = rng.choice([" ", "-", "1 "]).join(vocabulary[min(words - 1, int(rng.random() ** 3 * words) + lean * (source == "s1"))] for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "fr", None]), source, 1))
    rows += [(1, None, "en", "silent", 0), (2, "", "de", "a", 0), (2, "", "de", "a", 0), (3, "Wort", "de", "b", 0), (4, None, None, None, None), (5, "x", "en", "", 1)]
    return rows


def audit(df, **options):
    return sorted(tuple(r) for r in dv.audit(df, least_docs=3, top=5, **options).collect())


@pytest.mark.parametrize("seed", range(3))
def test_matches_plain_counts(spark, clashing, monkeypatch, seed):
    if seed:
        monkeypatch.setattr(dv, "STRIP", 2)
        monkeypatch.setattr(dv, "TILE", 50)
        monkeypatch.setattr(dv, "HELD", 20)
        monkeypatch.setattr(dv, "CHUNK", 1)
    rows = made(seed)
    got = audit(clashing(spark.createDataFrame(rows, DOCUMENTS)).withColumns({}))
    assert got == plain(rows)
    assert {r[2] for r in got} == {"pair", "term"}


def test_more_terms_than_a_bitset(spark):
    rows = made(8, docs=200, words=400)
    assert audit(spark.createDataFrame(rows, DOCUMENTS)) == plain(rows)


@pytest.mark.parametrize("kept", [1, 63, 64, 65, 127, 128])
def test_every_number_of_kept_terms(spark, kept):
    terms = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(kept)]
    rows = [(i, " ".join(terms[i % 2 :]), "en", f"s{i % 3}", 1) for i in range(8)]
    assert audit(spark.createDataFrame(rows, DOCUMENTS)) == plain(rows)


def test_edge_rows(spark, edge_rows):
    assert audit(spark.createDataFrame(edge_rows, DOCUMENTS)) == plain(edge_rows)
    assert audit(spark.createDataFrame([], DOCUMENTS)) == []


def test_counts_beyond_long_products(spark):
    row = spark.createDataFrame([(5 * 10**12, 10**13, 10**6)], "n long, total long, kept long")
    want = 1 + 10**9 * (5 * 10**12 + 5) // (10**13 + 5 * 10**6)
    assert row.select(dv.share("n", "total", "kept", 5, 10**9).alias("p")).first()["p"] == want
