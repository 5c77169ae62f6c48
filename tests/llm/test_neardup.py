"""Near duplicates against all pairs, and the parts of the operator."""

from __future__ import annotations

import random

import numpy as np
import pytest

from citylake.llm import components as cc, neardup as nd
from tests.llm.conftest import DOCUMENTS


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def edited(text, rng, share):
    words = text.split()
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)


def plain(docs):
    """Classes by every pair of different texts."""
    texts = {}
    for d, t in docs:
        if t is not None and d is not None:
            texts[t] = min(d, texts.get(t, d))
    ids = {d: nd.shingles(t.encode()) for t, d in texts.items()}
    root = {d: d for d in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(ids)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            x, y = ids[a].tolist(), ids[b].tolist()
            same = lcs(x, y) if x and y else 0
            if same and same / (len(x) + len(y) - same) >= 0.8:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {d: (d if t is None else top(texts[t])) for d, t in docs if d is not None}


def made(prose):
    rng, docs = random.Random(5), []
    for i in range(30):
        base = prose(i, rng.choice([3, 6, 60, 150]))
        docs.append(base)
        docs += [edited(base, rng, rng.choice([0.002, 0.01, 0.2])) for _ in range(rng.randint(0, 4))]
        docs += [base.upper().replace(" ", ",  ")] * rng.randint(0, 2)
    words = docs[2].split()
    docs += [" ".join(words[len(words) // 2 :] + words[: len(words) // 2]), docs[2] + " the end", "", "  ", "", "!!!", None, None]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_classes_match_all_pairs(spark, prose, clashing, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    docs = made(prose)
    df = clashing(spark.createDataFrame([(d, t, None, None, None) for d, t in docs], DOCUMENTS))
    rows = nd.classes(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == plain(docs)
    by = {r["doc_id"]: r["copy_of"] for r in rows}
    assert all(dict(docs)[d] == dict(docs)[c] for d, c in by.items())


def test_chain_of_edits_is_one_class(spark, prose):
    rng, texts = random.Random(8), [prose(77, 200)]
    for _ in range(40):
        texts.append(edited(texts[-1], rng, 0.012))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nd.classes(df).collect()} == plain(list(enumerate(texts)))


def test_one_document_of_each_class_stays(spark, prose, edge_rows, clashing):
    docs = [(d, t, "en", "s", 1) for d, t in made(prose)]
    df = clashing(spark.createDataFrame([*docs, *((r[0] and r[0] + 10_000, *r[1:]) for r in edge_rows)], DOCUMENTS))
    kept = nd.representatives(df)
    assert kept.columns == df.columns
    truth = plain([(d, t) for d, t, *_ in docs])
    ids = [r["doc_id"] for r in kept.where("doc_id < 10000").collect()]
    assert sorted(ids) == sorted({c for c in truth.values()})
    rest = sorted((r["doc_id"] for r in kept.where("doc_id > 10000 or doc_id is null").collect()), key=str)
    # Copies of the empty text and of the repeated one go; the null text and the row without an id stay.
    assert rest == sorted([None, 10001, 10003, 10004, 10005, 10007, 10008], key=str)


def test_edge_rows(spark, edge_rows):
    rows = nd.classes(spark.createDataFrame(edge_rows, DOCUMENTS)).collect()
    assert len(rows) == len(edge_rows)
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    assert classes == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8}
    assert nd.classes(spark.createDataFrame([], DOCUMENTS)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_similarity_is_the_ordered_one(seed):
    rng = random.Random(seed)
    a = [rng.randint(0, 40) for _ in range(rng.randint(1, 60))]
    b = [x if rng.random() < 0.93 else rng.randint(0, 40) for x in a if rng.random() < 0.97] or [1]
    same = lcs(a, b)
    exact = same / (len(a) + len(b) - same)
    found = nd.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.6)
    assert found == (pytest.approx(exact) if exact >= 0.6 else 0.0)


def test_signatures_never_rule_out_a_similar_pair(prose):
    rng = random.Random(2)
    base = prose(1, 300)
    texts = [base, *(edited(base, rng, s) for s in (0.001, 0.005, 0.01, 0.02, 0.05, 0.3))]
    kmers = [nd.shingles(t.encode()) for t in texts]
    n = np.array([len(k) for k in kmers])
    bits = np.stack([np.frombuffer(nd.signature(k), np.uint64) for k in kmers])
    room = nd.spare([n, n], [bits, bits], 0.8)
    for i, x in enumerate(kmers):
        for j, y in enumerate(kmers):
            assert room[i, j] >= 0 or nd.similarity(x, y) == 0
    assert (room < 0).any()


def test_sketch_keeps_order_and_occurrences():
    a = np.arange(1, 60, dtype=np.uint64)
    assert (nd.sketch(a) == nd.sketch(a.copy())).all()
    assert (nd.sketch(a) != nd.sketch(a[::-1].copy())).mean() > 0.5
    assert len(set(nd.labelled(np.array([5, 5, 5, 9], np.uint64)).tolist())) == 4


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (20, 20), (30, 31), (31, 30)] + [(100 + i, 101 + i) for i in range(50)]
    found = {r["a"]: r["b"] for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {2: 1, 3: 1, 8: 7, 9: 7, 31: 30, **{101 + i: 100 for i in range(50)}}
