"""Suffix-array dedup and recurring passages against plain window counts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from citylake.llm import phrases, repeats, suffixes
from citylake.llm.repeats import Rule
from tests.llm.conftest import DOCUMENTS

BYTES = Rule(window=40, gram=25, words=False, ordered=False)
WORDS = Rule(window=10, gram=6, words=True, ordered=True)
LAST = 2**63 - 1


def spans_of(flags, window):
    out = []
    for at in np.flatnonzero(flags).tolist():
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], at + window)
        else:
            out.append((at, at + window))
    return out


def plain_bytes(docs, window):
    raws = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(r[i : i + window] for _, r in raws for i in range(len(r) - window + 1))
    out = []
    for d, r in raws:
        out.append((d, *suffixes.cut_bytes(r, spans_of([seen[r[i : i + window]] > 1 for i in range(len(r) - window + 1)], window))))
    return sorted(out, key=str)


def plain_words(docs, window):
    rows = [(d, LAST if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for _, order, r in rows:
        w = r.split()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(order, first.get(key, order))
    out = []
    for d, order, r in rows:
        w = r.split()
        out.append((d, *phrases.cut_words(r, spans_of([first[tuple(w[i : i + window])] < order for i in range(len(w) - window + 1)], window))))
    return sorted(out, key=str)


def made(prose, n=60):
    rng = random.Random(11)
    shared = [prose(900 + i, rng.choice([8, 10, 12, 30, 80])) for i in range(8)]
    docs = []
    for d in range(n):
        parts = []
        for i in range(rng.randint(0, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else prose(d * 10 + i, rng.randint(0, 30)))
        docs.append((d, rng.choice([" ", "\n", "  "]).join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1] + " more"), (102, "a" * 300), (103, "ab " * 200), (104, shared[4][3:]), (105, "é" * 90)]
    docs += [(106, shared[4] + " " + shared[4]), (2, docs[2][1]), (None, shared[4]), (None, None), (107, ""), (108, None)]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in docs], DOCUMENTS)


def rows(df):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most", [2000, 1])
def test_bytes_match_the_plain_count(spark, prose, clashing, monkeypatch, most):
    monkeypatch.setattr(repeats, "VARIANTS", most)
    docs = made(prose)
    df = clashing(frame(spark, docs))
    assert rows(suffixes.SuffixFamily(spark, BYTES).add(df).clean(df)) == plain_bytes(docs, 40)


@pytest.mark.parametrize("most", [2000, 1])
def test_words_match_the_plain_count(spark, prose, clashing, monkeypatch, most):
    monkeypatch.setattr(repeats, "VARIANTS", most)
    docs = made(prose)
    assert rows(phrases.clean(clashing(frame(spark, docs)), WORDS)) == plain_words(docs, 10)


def test_many_variants_do_not_trust_the_window_hash(spark, prose, monkeypatch):
    exact = repeats.window_hashes
    monkeypatch.setattr(repeats, "VARIANTS", 1)
    monkeypatch.setattr(repeats, "window_hashes", lambda contexts, rule: [h % np.uint64(64) for h in exact(contexts, rule)])
    docs = made(prose)
    assert rows(suffixes.SuffixFamily(spark, BYTES).add(frame(spark, docs)).clean(frame(spark, docs))) == plain_bytes(docs, 40)
    assert rows(phrases.clean(frame(spark, docs), WORDS)) == plain_words(docs, 10)


def test_batches_are_merged_and_give_the_same(spark, prose):
    docs = made(prose)
    family = suffixes.SuffixFamily(spark, BYTES)
    for i in range(5):
        family = family.add(frame(spark, docs[i::5]))
    sizes = [n for n, _ in family.levels]
    assert len(sizes) < 5 and all(suffixes._order(a) > suffixes._order(b) for a, b in zip(sizes, sizes[1:], strict=False))
    assert rows(family.clean(frame(spark, docs))) == plain_bytes(docs, 40)


def test_scans_of_batches_find_the_anchors_that_recur_in_the_whole(spark, prose):
    docs = made(prose)
    keys = repeats.runs(frame(spark, docs), BYTES).groupBy("key").count().where("count > 1")
    expected = {r.key for r in keys.collect()}
    family, seen = suffixes.SuffixFamily(spark, BYTES), []
    for i in range(4):
        family = family.add(frame(spark, docs[i::4]))
        seen.append(len({r.key for r in family.matches().collect()}))
    assert {r.key for r in family.matches().collect()} == expected
    assert seen == sorted(seen) and seen[0] < seen[-1]
    assert sum(n for n, _ in family.levels) == repeats.runs(frame(spark, docs), BYTES).count()


def test_a_batch_without_texts_changes_nothing(spark, prose):
    docs = made(prose)
    family = suffixes.SuffixFamily(spark, BYTES)
    for batch in (docs[:30], [], [(500, None), (501, "")], docs[30:]):
        family = family.add(frame(spark, batch))
    assert rows(family.clean(frame(spark, docs))) == plain_bytes(docs, 40)


def test_long_texts_are_cut_into_segments(spark, prose, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 512)
    docs = [(1, prose(1, 900)), (2, prose(2, 100) + " " + prose(1, 900)[700:2900] + " " + prose(3, 50)), (3, prose(4, 400))]
    assert rows(suffixes.SuffixFamily(spark, BYTES).add(frame(spark, docs)).clean(frame(spark, docs))) == plain_bytes(docs, 40)
    assert rows(phrases.clean(frame(spark, docs), WORDS)) == plain_words(docs, 10)


def same_upper_half(heads, tails, n=200_000):
    """Texts `number head` and `number tail` whose xxhash64 agree in their upper 32 bits, as in Spark with seed 42."""
    upper = lambda text: xxhash.xxh64_intdigest(text.encode(), seed=42) >> 32
    held = {upper(f"{i} {heads}"): i for i in range(n)}
    for j in range(n):
        if (i := held.get(upper(f"{j} {tails}"))) is not None:
            return f"{i} {heads}", f"{j} {tails}"


def test_texts_without_an_id_that_share_half_a_hash(spark, prose):
    passage, other = prose(1, 60), prose(2, 30)
    pair = same_upper_half(prose(3, 30) + " " + passage, other)
    docs = [(1, passage), *((None, text) for text in pair)]
    assert rows(suffixes.SuffixFamily(spark, BYTES).add(frame(spark, docs)).clean(frame(spark, docs))) == plain_bytes(docs, 40)
    assert rows(phrases.clean(frame(spark, docs), WORDS)) == plain_words(docs, 10)


def test_copies_without_an_id_share_one_list(spark, prose):
    texts = [prose(1, 60), prose(2, 20) + " " + prose(1, 60), prose(3, 40)]
    docs = [(None, text) for text in texts for _ in range(5)] + [(1, prose(1, 40))]
    assert rows(suffixes.SuffixFamily(spark, BYTES).add(frame(spark, docs)).clean(frame(spark, docs))) == plain_bytes(docs, 40)
    assert rows(phrases.clean(frame(spark, docs), WORDS)) == plain_words(docs, 10)


def test_empty_table(spark):
    df = frame(spark, [])
    assert rows(suffixes.SuffixFamily(spark).add(df).clean(df)) == []
    assert rows(phrases.clean(df)) == []


def test_span_hashes_and_minima():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 4, 500).astype(np.uint64)
    sums = repeats.prefix_sums(symbols)
    by = {}
    for a in range(490):
        by.setdefault(tuple(symbols[a : a + 5].tolist()), set()).add(int(repeats.span_hash(sums, np.array([a]), np.array([a + 5]))[0]))
    assert all(len(x) == 1 for x in by.values()) and len(set().union(*by.values())) == len(by)
    values = rng.integers(0, 9, 101).astype(np.uint64)
    assert repeats.sliding_min(values, 7).tolist() == [min(values[i : i + 7].tolist()) for i in range(95)]
