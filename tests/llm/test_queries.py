"""The registered queries: SQL, plain versions and the shape of their results over the smallest tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import pytest

from citylake.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.test_mixing import mixing
from tests.llm.test_neardup import plain
from tests.llm.test_repeats import plain_bytes, plain_words


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text, source from '{SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(cursor.fetchall())


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op2(spark, documents):
    rows = QUERIES["op2_sharding"](spark, SMALL).collect()
    texts = {d: t.encode() for d, t, _ in documents}
    assert len(rows) == len(texts)
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]])) for r in rows)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    # A cut can miss the median by one document; a shard lies below five cuts at most.
    assert max(held.values()) - min(held.values()) <= 2 * max(r["size"] for r in rows)


def test_op4(spark, documents):
    want = [(d, n, gone, spans, sha(kept)) for d, n, gone, spans, kept in plain_bytes([(d, t) for d, t, _ in documents], 400)]
    got = QUERIES["op4_suffix_array"](spark, SMALL).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def shares(size):
    """Targets in exact fractions: what a source may not take is shared anew by weight until none is above three times its size."""
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(size))}
    target = {}
    while True:
        rest, open_ = sum(size.values()) - sum(target.values()), [s for s in size if s not in target]
        part = {s: Fraction(rest * weight[s], sum(weight[x] for x in open_)) for s in open_}
        over = [s for s in open_ if part[s] > 3 * size[s]]
        if not over:
            return {**target, **part}
        target.update({s: 3 * size[s] for s in over})


def test_op5(spark, documents):
    rows = QUERIES["op5_mixing"](spark, SMALL).collect()
    size = Counter()
    for _, text, source in documents:
        size[source] += len(text.encode().split())
    wanted = shares(size)
    sources = [mixing.Source(s, size[s], 1, float(wanted[s])) for s in sorted(size)]
    taken, of = Counter(), {d: s for d, _, s in documents}
    for r in rows:
        s = next(x for x in sources if x.name == of[r["doc_id"]])
        assert r["source_size"] == s.size and r["target"] == pytest.approx(s.target) and r["taken"] <= 3 * r["size"]
        taken[s.name] += r["taken"]
    assert len(rows) == len(documents)
    assert all(abs(taken[s.name] - s.target) <= 0.03 * s.target + 128 for s in sources)


def test_op7(spark, documents):
    want = [(d, n, gone, sha(kept)) for d, n, gone, kept in plain_words([(d, t) for d, t, _ in documents], 50)]
    got = QUERIES["op7_recurring_passages"](spark, SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_op9(spark, documents):
    few = [(d, t) for d, t, _ in documents]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_order_minhash"](spark, SMALL).collect()}
    assert len(got) == len(few)
    copies = {}
    for d, t in few:
        copies.setdefault(t, []).append(d)
    assert all(len({got[d] for d in own}) == 1 for own in copies.values())
    short = [(d, t) for d, t in few if len(t) < 1200]
    wanted = plain(short)
    assert all(got[d] == got[c] for d, c in wanted.items())


def test_op10(spark):
    vectors = dict(duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet'").fetchall())
    rows = QUERIES["op10_hnsw"](spark, SMALL).collect()
    by = {}
    for r in rows:
        by.setdefault(r["query_id"], {})[r["rank"]] = r
    hits = 0
    for q, found in by.items():
        truth = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)[:20]
        hits += len({r["vec_id"] for r in found.values()} & {i for _, i in truth})
        assert sorted(found) == list(range(1, 21)) and q not in {r["vec_id"] for r in found.values()}
        scores = [(-found[k]["score"], found[k]["vec_id"]) for k in sorted(found)]
        assert scores == sorted(scores)
    assert sorted(by) == sorted(i for i in vectors if i % 20 == 0) and hits >= 0.9 * 20 * len(by)
