"""Shards of equal bytes, gapless slots, and the tree itself."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from citylake.llm import sharding
from citylake.llm.common import running
from tests.llm.conftest import DOCUMENTS

DIMENSIONS = ["lang", "source", "n_chars"]


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "x" * rng.randint(0, 400)
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None]), "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}", len(text)))
    return rows


def test_bytes_are_near_equal_and_slots_gapless(spark):
    df = spark.createDataFrame(made(3000), DOCUMENTS)
    rows = sharding.shard(df, DIMENSIONS, shards=7).collect()
    assert len(rows) == 3000
    size = {}
    for r in rows:
        size.setdefault(r["shard"], []).append((r["slot"], len(r["text"]) + 8))
    assert sorted(size) == list(range(7))
    totals = [sum(s for _, s in x) for x in size.values()]
    assert max(totals) - min(totals) <= 0.02 * sum(totals) / 7 + 2 * 408
    assert all(sorted(slot for slot, _ in x) == list(range(len(x))) for x in size.values())


def test_target_bytes_set_the_number_of_leaves(spark):
    df = spark.createDataFrame(made(500), DOCUMENTS)
    total = df.agg(F.sum(sharding.size_of())).first()[0]
    tree = sharding.plan(df, DIMENSIONS, target_bytes=total // 10 + 1)
    assert tree.shards == 10
    assert sum(len(level) for level in tree.levels) == 9


def test_first_cut_is_at_the_weighted_median_of_the_widest_dimension(spark):
    rows = [(i, "x" * (1000 if i < 10 else 0), "en", "s", i) for i in range(100)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    tree = sharding.plan(df, DIMENSIONS, shards=2)
    (cut,) = tree.levels[0]
    assert cut.dimension == 2
    left = [r["doc_id"] for r in sharding.assign(df, tree, DIMENSIONS).where("_node = 0").collect()]
    weights = [1008] * 10 + [8] * 90
    best = min(range(101), key=lambda k: abs(sum(weights[:k]) - sum(weights) / 2))
    assert sorted(left) == list(range(best))


def test_sources_that_begin_alike_are_told_apart(spark):
    sources = [f"crawl-20{y}" for y in range(10, 18)]
    rows = [(i, f"{i:05d}" * 4, None, sources[i * 7 % 8], 20) for i in range(800)]
    out = sharding.shard(spark.createDataFrame(rows, DOCUMENTS), ["lang", "source"], shards=8)
    where = {}
    for r in out.collect():
        where.setdefault(r["source"], set()).add(r["shard"])
    assert [where[s] for s in sources] == [{i} for i in range(8)]


def test_ranks_are_gapless_and_in_order(spark):
    values = ["b", "a", "é", "Z", "a", None, "aa", ""]
    df = spark.createDataFrame([(i, "t", v, v, i) for i, v in enumerate(values)], DOCUMENTS)
    got = {(r["dimension"], r["value"]): r["rank"] for r in sharding.text_ranks(df, DIMENSIONS).collect()}
    order = ["", "Z", "a", "aa", "b", "é"]
    assert got == {(d, v): i + 1 for d in (0, 1) for i, v in enumerate(order)}


def test_copies_alone_can_be_parted(spark):
    df = spark.createDataFrame([(i, "the same", "en", "s", 8) for i in range(400)], DOCUMENTS)
    counts = [r["count"] for r in sharding.shard(df, DIMENSIONS, shards=4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 12


def test_edge_rows(spark, edge_rows, clashing):
    df = clashing(spark.createDataFrame(edge_rows, DOCUMENTS))
    out = sharding.shard(df, DIMENSIONS, shards=3)
    own = [c for c in df.columns if c not in ("shard", "slot")]
    assert out.columns == [*own, "shard", "slot"]
    same = lambda frame: sorted(map(repr, frame.select(*own).collect()))
    assert same(out) == same(df)
    assert sharding.shard(spark.createDataFrame([], DOCUMENTS), DIMENSIONS, shards=3).collect() == []


def test_running_sums(spark):
    df = spark.range(2000).selectExpr("id", "id % 2 as g", "id % 7 as w")
    rows = running(df, "g", ["id"], F.col("w"), per=50).collect()
    for g in (0, 1):
        own = sorted((r["_before"], r["w"]) for r in rows if r["g"] == g)
        total = 0
        for before, w in sorted(own, key=lambda x: (x[0], x[0] + x[1])):
            assert before == total
            total += w
