"""Benchmark hits against a plain search over word windows."""

from __future__ import annotations

import random
import re

from citylake.llm import decontamination as dc
from tests.llm.conftest import DOCUMENTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(tuple(w[i : i + 13]), str(item)) for i in range(max(1, len(w) - 12) if w else 0)]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window, item in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "n_words", dc.n_hit().alias("n_hit"), "item_ids").collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in rows), key=str)


def made(prose):
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.choice([1, 5, 13, 14, 40]))) for i in range(12)] + [(12, prose(100, 5).upper()), (13, ""), (14, None)]
    docs = []
    for d in range(40):
        parts = [prose(d, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(items[:12])[1].replace(" ", rng.choice([" ", ", ", "\n- "])), prose(d + 500, 10)]
        docs.append((d, " ".join(parts)))
    return docs, items


def test_matches_the_plain_search(spark, prose, edge_rows, clashing):
    docs, items = made(prose)
    docs += [(r[0], r[1]) for r in edge_rows if r[0] != 4]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as pattern", "2 as item")
    df = clashing(spark.createDataFrame([(d, t, None, None, None) for d, t in docs], DOCUMENTS))
    assert found(dc.find(df, benchmark)) == plain(docs, items)
    # Several automata, one after the other, give the same.
    assert found(dc.find(df, benchmark, pattern_bytes=400)) == plain(docs, items)


def test_filter_keeps_columns_and_clean_rows(spark, prose, clashing):
    docs, items = made(prose)
    df = clashing(spark.createDataFrame([(d, t, "en", "s", 1) for d, t in docs], DOCUMENTS))
    kept = dc.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    clean = [d for d, n, hit, _ in plain(docs, items) if not (hit and 20 * hit >= n)]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(clean)
    assert {r["n_words"] for r in kept.collect()} == {"n_words"}


def test_spans_point_into_the_original(spark, prose):
    item = prose(9, 13)
    text = f"Ünd é — {prose(1, 5)}: ({item.upper()})! {prose(2, 5)}"
    row = dc.hit_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == [item.upper()]
    assert row["item_ids"] == ["7"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert found(dc.find(docs, items)) == []
    assert found(dc.find(spark.createDataFrame([(1, "some text", None, None, None)], DOCUMENTS), items)) == [(1, 2, 0, ())]
