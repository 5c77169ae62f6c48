"""Line dedup against a plain version, the cuckoo filter, and deletions that undo insertions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from citylake.llm.lines import CuckooFilter, LineIndex

SCHEMA = "doc_id long, text string"


def plain(docs):
    held = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    order = lambda doc: 2**63 - 1 if doc is None else doc
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(order(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) > 1 and order(doc) > min(held[key(x)]))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cleaned(index, docs, **how):
    return sorted((tuple(r) for r in index.clean(docs, **how).collect()), key=str)


def made(n, seed):
    rng = random.Random(seed)
    common = [f"Line that many documents hold {i}" for i in range(12)]
    docs = []
    for doc in range(n):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"own line {doc} {i} {rng.random()}" for i in range(rng.randint(0, 9))]
        lines = [rng.choice([x, x.upper(), f"  {x}\t", "short", "ÄÖÜß" * 3]) for x in lines]
        docs.append((doc, "\n".join(lines)))
    return docs


@pytest.fixture
def edge_cases():
    return [
        (5, None),
        (6, ""),
        (7, "\n\n"),
        (8, "A line of some length\nshort\nA line of some length"),
        (9, " a LINE of some length\t\nother words here"),
        (9, " a LINE of some length\t\nother words here"),
        (None, "a line of some length\nnine char"),
        (10, "äöüäöüäöü\nÄäöüäöüäöü"),
        (11, "äöüäöüäöü\näöüäöüäöüä\nÄäöüäöüäöü"),
        (12, "x" * 300_000 + "\na line of some length"),
        (13, "\x0b a line of some length \x0c"),
    ]


def test_matches_the_plain_version(spark, edge_cases):
    docs = made(120, 1) + [(d and d + 1000, t) for d, t in edge_cases]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as keys", "2 as doc")
    assert cleaned(LineIndex(spark).insert(df), df, inserted=True) == plain(docs)


def test_rows_without_an_id_have_lists_of_their_own(spark):
    docs = [(i, f"line number {i} of the table\nanother line {i} of it") for i in range(40)]
    docs += [(None, text) for _, text in docs] + [(None, docs[0][1])]
    df = spark.createDataFrame(docs, SCHEMA)
    index = LineIndex(spark).insert(df)
    assert cleaned(index, df, inserted=True) == plain(docs)
    assert max(len(r["keys"]) for r in index.drops(index.refs).collect()) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cleaned(LineIndex(spark).insert(df), df, inserted=True) == []


def test_batches_and_deletions_leave_what_one_insertion_gives(spark):
    docs = made(90, 2)
    frames = [spark.createDataFrame(docs[i::3], SCHEMA) for i in range(3)]
    index = LineIndex(spark)
    for frame in frames:
        index = index.insert(frame)
    everything = spark.createDataFrame(docs, SCHEMA)
    assert cleaned(index, everything) == plain(docs)
    without = index.delete(frames[0])
    rest = [d for i in (1, 2) for d in docs[i::3]]
    assert cleaned(without, spark.createDataFrame(rest, SCHEMA)) == plain(rest)
    again = without.insert(frames[0])
    assert cleaned(again, everything) == plain(docs)


def test_filter_adds_and_removes():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    held = CuckooFilter.sized(len(keys))
    assert held.add(keys)
    assert held.may_hold(keys).all()
    assert held.may_hold(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.002
    held.remove(keys[:15_000])
    assert held.may_hold(keys[15_000:]).all()
    assert held.may_hold(keys[:15_000]).mean() < 0.002
    assert (CuckooFilter.read(held.data()).table == held.table).all()
    held.remove(keys[15_000:])
    assert not held.table.any()
    assert not CuckooFilter.sized(100).add(keys)


def test_digest_of_a_query_row(spark):
    df = spark.createDataFrame([(1, "one line of text"), (2, "One Line Of Text\nmore")], SCHEMA)
    kept = {r["doc_id"]: r["kept"] for r in LineIndex(spark).insert(df).clean(df, inserted=True).collect()}
    assert hashlib.sha256(kept[2].encode()).hexdigest() == hashlib.sha256(b"more").hexdigest()
