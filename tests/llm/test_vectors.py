"""Embedding near-duplicates against all pairs."""

from __future__ import annotations

import math
import random

import pytest

from citylake.llm import vectors as vs

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.95):
    """(id, links, component, kept) of every row by every pair."""

    def takes_part(e):
        return e is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)

    def linked(x, y):
        wide = max(len(x), len(y))
        x, y = ([v / max(map(abs, z)) for v in z] + [0.0] * (wide - len(z)) for z in (x, y))
        return sum(a * b for a, b in zip(x, y, strict=True)) >= least * math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))

    n = len(rows)
    near = [[j for j in range(n) if j != i and takes_part(rows[i][1]) and takes_part(rows[j][1]) and linked(rows[i][1], rows[j][1])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        least_id = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least_id, rows[i][0] is not None and rows[i][0] == least_id))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in vs.near_duplicates(df, **options).collect()), key=str)


def made(rng, width, groups=12, noise=0.12):
    """Groups of likely links, chains that turn a little at each step, and single vectors."""
    rows = []
    for _ in range(groups):
        centre = [rng.gauss(0, 1) for _ in range(width)]
        for _ in range(rng.randint(1, 8)):
            rows.append([c + rng.gauss(0, noise * rng.random() * 2) for c in centre])
    step = [rng.gauss(0, 1) for _ in range(width)]
    rows += [[c + 0.25 * k * s for c, s in zip(rows[0], step, strict=True)] for k in range(12)]
    return [(i, [float(x) for x in v], i % 3) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("width", "block", "tile"), [(3, 16, 3), (24, 12, 3), (70, 1000, 2)])
def test_matches_all_pairs(spark, monkeypatch, width, block, tile):
    monkeypatch.setattr(vs, "LEAST_BLOCK", block)
    monkeypatch.setattr(vs, "TILE", tile)
    rows = made(random.Random(width), width)
    df = spark.createDataFrame(rows, SCHEMA).cache()
    rows = [tuple(r) for r in df.collect()]
    want = plain(rows)
    assert found(df) == want and any(r[1] for r in want)
    assert found(df, least=0.8) == plain(rows, 0.8)


def test_bad_vectors_copies_and_missing_ids(spark):
    rng = random.Random(4)
    base = [rng.gauss(0, 1) for _ in range(6)]
    rows = [
        (5, base, 1), (3, base, 2), (3, base, 2), (9, [2 * x for x in base], None), (None, base, 1), (2, [-x for x in base], 1),
        (11, None, 0), (12, [], 0), (13, [0.0] * 6, 0), (14, [0.0] * 6, 0), (15, [1.0, None, 2.0], 0), (16, [float("nan")] * 6, 0),
        (17, [float("inf")] + base[1:], 0), (18, [1.0, 0.0], 0), (19, [1.0], 0), (None, [0.0, 0.0, 7.0], 0), (None, None, 0), (20, [1e-30, 0.0], 0), (21, [3e38, -3e38], 0),
        *((100 + i, [0.0, 1.0, 1.0], 0) for i in range(40)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["node", "e", "n_links", "root", "copies", "first", "lead", "block"]
    clash = df.selectExpr("*", *(f"'{n}' as {n}" for n in names))
    got = found(clash)
    assert got == plain([tuple(r) for r in df.collect()])
    assert (100, 39, 100, True) in got and (101, 39, 100, False) in got and (None, 0, None, False) in got
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(df.where("vec_id between 11 and 17")) == [(i, 0, i, True) for i in range(11, 18)]


def test_one_direction_and_one_large_group_do_not_fill_a_block(spark, monkeypatch):
    monkeypatch.setattr(vs, "LEAST_BLOCK", 16)
    rng = random.Random(9)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, [x * (i + 1) for x in base], 0) for i in range(150)]
    rows += [(1000 + i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(100)]
    rows += [(2000 + i, [x + 1e-3 * rng.gauss(0, 1) for x in reversed(base)], 0) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).cache()
    assert found(df) == plain([tuple(r) for r in df.collect()])
    sizes = []
    split = vs.blocks_of
    monkeypatch.setattr(vs, "blocks_of", lambda *a: sizes.append(split(*a).groupBy("block").count().agg({"count": "max"}).first()[0]) or split(*a))
    found(df)
    assert sizes[0] <= 110


def test_pairs_at_the_threshold_are_linked():
    assert vs.steps(64) == [16, 32, 64] and vs.steps(5) == [5] and vs.steps(20) == [16, 20]
    with pytest.raises(ValueError):
        vs.near_duplicates(None, least=0)
