"""Graph search against brute force."""

from __future__ import annotations

import numpy as np

from citylake.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    valid = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, x in valid.items():
        if q % every == 0:
            found = [(-float((x * y).sum()), i) for i, y in valid.items() if i != q and len(y) == len(x)]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def searched(spark, rows, every, k, **how):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 as id", "2 as dim", "'x' as v")
    out = {}
    for r in sorted(hnsw.search(df, every, k, **how).collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def vectors(n, d, seed=1, scale=True):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, d)) * (rng.uniform(0.2, 3, (n, 1)) if scale else 1)
    return [(i, x.astype(np.float32).tolist()) for i, x in enumerate(made)]


def test_recall_over_shards(spark):
    rows = vectors(3000, 24)
    truth, found = brute(rows, 20, 20), searched(spark, rows, 20, 20, shard_rows=800)
    assert set(found) == set(truth)
    hits = np.mean([len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) / 20 for q in truth])
    assert hits >= 0.95
    exact = {(q, i): s for q in truth for i, s in brute([(q, dict(rows)[q]), *rows], 20, 3000)[q]} if len(truth) < 5 else None
    assert exact is None or all(abs(exact[(q, i)] - s) < 1e-12 for q in found for i, s in found[q])


def test_many_equal_vectors_and_ties(spark):
    rows = vectors(200, 8) + [(1000 + i, [1.0] * 8) for i in range(600)]
    truth, found = brute(rows, 100, 20), searched(spark, rows, 100, 20, shard_rows=150)
    for q in truth:
        assert [i for i, _ in found[q]] == [i for i, _ in truth[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in truth[q]], rtol=0, atol=1e-12)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, [1.0, None])]
    rows += [(None, [1.0, 1.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (140, [1.0, 2.0, 3.0]), (9, [-1.0, -2.0])]
    found = searched(spark, rows, 20, 20)
    assert found == {0: [(7, 5.0), (9, -5.0)]}
    assert searched(spark, [], 20, 20) == {}
    assert searched(spark, [(20, [1.0, 1.0])], 20, 20) == {}


def test_levels_are_prefixes_and_links_are_valid():
    points = np.stack([np.array(v) for _, v in vectors(1200, 8)])
    graph, order = hnsw.built(points, float(np.linalg.norm(points, axis=1).max()), 0)
    assert sorted(order.tolist()) == list(range(1200))
    sizes = [len(x) for x in graph.levels]
    assert sizes[0] == 1200 and sizes == sorted(sizes, reverse=True)
    for size, links in zip(sizes, graph.levels, strict=True):
        assert links.max() < size
        assert all(at not in row for at, row in enumerate(links.tolist()))
        assert all(len(set(r)) == len(r) for r in ([x for x in row if x >= 0] for row in links.tolist()))
