"""Targets, draws, permutations, and the words a mix takes."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from citylake.llm import mixing
from citylake.llm.mixing import Source
from tests.llm.conftest import DOCUMENTS


def docs_of(prose):
    rows = []
    for i in range(200):
        source = ["hot", "hot", "hot", "tiny", "z", None][i % 6] if i else "single"
        rows.append((i, prose(i, 2 if source == "tiny" else 40 + i % 50), "en", source, 1))
    return rows


def test_targets_stop_at_three_times_a_source():
    sources = [Source("a", 1000, 1), Source("b", 10, 2), Source("c", 100, 3), Source(None, 0, 1)]
    mixing.set_targets(sources)
    assert [s.target for s in sources] == [1110 - 30 - 300, 30.0, 300.0, 0.0]
    plain = [Source("a", 60, 1), Source("b", 60, 2), Source("c", 60, 3)]
    mixing.set_targets(plain)
    assert [s.target for s in plain] == pytest.approx([30, 60, 90])


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000, 65537])
def test_permutation(size):
    out = mixing.permuted(np.arange(size), size, 12345)
    assert sorted(out.tolist()) == list(range(size))
    if size >= 1000:
        assert abs(np.corrcoef(out, np.arange(size))[0, 1]) < 0.1
        assert (out != mixing.permuted(np.arange(size), size, 6)).mean() > 0.9


def test_draws_meet_the_quotas_and_follow_them():
    quotas = [5000, 100, 0, 2500]
    draws = mixing.multinomial_draws(quotas, 10, 3)
    total = Counter()
    for _, s, first, count in draws:
        assert first == total[s]
        total[s] += count
    assert [total[s] for s in range(4)] == quotas
    per = [sum(c for shard, *_, c in draws if shard == i) for i in range(10)]
    assert max(per) - min(per) <= 10
    first = [c for shard, s, _, c in draws if s == 0 and shard < 9]
    assert np.std(first) > 0 and abs(np.mean(first) - 500) < 40


def test_words_taken_come_near_the_targets(spark, prose, clashing):
    rows = docs_of(prose)
    df = clashing(spark.createDataFrame(rows, DOCUMENTS))
    mix = mixing.plan(df, block=8)
    taken = mixing.taken(mix).collect()
    assert sorted(r["doc_id"] for r in taken) == [r[0] for r in rows]
    sizes = {r[0]: len(r[1].split()) for r in rows}
    by = Counter()
    for r in taken:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] <= 3 * r["size"]
        by[r["source"]] += r["taken"]
    for s in mix.sources:
        assert abs(by[s.name] - s.target) <= 0.02 * s.target + 8
    assert [s.name for s in mix.sources] == ["hot", "single", "tiny", "z", None]
    assert [s.weight for s in mix.sources] == [1, 2, 3, 1, 2]
    again = mixing.taken(mixing.plan(df.repartition(7), block=8)).collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))


def test_sources_below_a_block_meet_their_targets_together(spark):
    rows = [(i, "word " * 100, "en", f"s{i:03}", 500) for i in range(300)]
    mix = mixing.plan(spark.createDataFrame(rows, DOCUMENTS))
    by = Counter()
    for s in mix.sources:
        assert abs(s.drawn * 100 - s.target) < 100
        by[s.weight] += s.drawn * 100
    assert all(abs(by[w] - 5000 * w) < 1500 for w in (1, 2, 3))


def test_slots_and_blocks_agree(spark, prose):
    df = spark.createDataFrame(docs_of(prose), DOCUMENTS)
    mix = mixing.plan(df, block=16, shards=5)
    rows = mixing.slots(mix).collect()
    places = Counter((r["shard"], r["position"]) for r in rows)
    assert max(places.values()) == 1
    for shard in range(5):
        own = sorted(p for s, p in places if s == shard)
        assert own == list(range(len(own)))
    uses = Counter((r["_s"], r["_block"]) for r in rows)
    for i, s in enumerate(mix.sources):
        counts = [uses[(i, b)] for b in range(s.blocks)]
        assert sum(counts) == s.drawn and max(counts) - min(counts) <= 1 and max(counts) <= 3
    lengths = Counter()
    for r in mixing.mixed(mix).collect():
        lengths[(r["shard"], r["position"])] += r["n_words"]
    assert set(lengths) == set(places) and max(lengths.values()) == 16
    assert sum(lengths.values()) == sum(r["taken"] for r in mixing.taken(mix).collect())


def test_edge_rows(spark, edge_rows, clashing):
    df = clashing(spark.createDataFrame(edge_rows, DOCUMENTS))
    out = {(r["doc_id"], r["source"]): (r["size"], r["taken"]) for r in mixing.taken(mixing.plan(df)).collect()}
    assert out[(1, None)] == (0, 0) and out[(2, "a")] == (0, 0) and out[(3, "a")] == (0, 0)
    assert out[(4, "b")][0] == 60_000
    assert mixing.taken(mixing.plan(df)).count() == len(edge_rows)
    assert mixing.taken(mixing.plan(spark.createDataFrame([], DOCUMENTS))).collect() == []
