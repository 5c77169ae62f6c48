"""The convolutional score: gradients, separation on new texts, edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from citylake.llm import quality
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS


@pytest.fixture(scope="module")
def network():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(160):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(5, 150))]
        good = i % 4 > 0
        texts.append((" ".join(words) if good else "!! ".join(w.upper() for w in words)).encode())
        labels.append(int(good))
    return quality.train(texts, labels), texts, labels


def test_learns_to_tell_texts_apart(network):
    net, texts, labels = network
    assert ((net.score(texts) >= 0.3).astype(int) == np.array(labels)).mean() > 0.98
    assert net.score([b"abc def gah feed " * 30])[0] > 0.5 > 0.3 > net.score([b"ABC!! DEF!! GAH!! FEED!! " * 30])[0]


def test_score_does_not_depend_on_the_company(network):
    net, texts, _ = network
    some = [texts[0], b"", b"\0\0", b"x" * 200_000, texts[3]]
    together = net.score(some)
    assert together == pytest.approx([net.score([t])[0] for t in some])
    assert ((together >= 0) & (together <= 1)).all()


def test_every_part_of_a_long_text_counts(network):
    net, *_ = network
    clean = b"abc def gah feed " * 4000
    for at in (0, 30_000, len(clean) - 600):
        spoilt = clean[:at] + b"GAH!! DEF!! " * 50 + clean[at + 600 :]
        assert net.score([spoilt])[0] != net.score([clean])[0]


def test_chunks_overlap_by_half(network):
    net, *_ = network
    best, _ = net.blocks(quality.padded(bytes(random.Random(4).randbytes(3000))))
    answers, firsts, _ = net.chunks(best, np.array([len(best)]))
    assert firsts.tolist() == [0]
    assert answers == pytest.approx(np.maximum(best[:-1], best[1:]))


def test_edge_rows(spark, network, edge_rows, clashing):
    df = clashing(spark.createDataFrame(edge_rows, DOCUMENTS))
    rows = quality.score(df, network[0]).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[1] == by[2]
    empty = spark.createDataFrame([], DOCUMENTS)
    untaught = quality.learn(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert quality.score(empty, untaught).collect() == []
    assert all(0 <= r["score"] <= 1 for r in quality.score(df, untaught).collect())


def test_one_label_only():
    assert quality.train([b"abc", b"def"], [1, 1]).score([b"xyz"])[0] > 0.99


def test_held_out_accuracy(spark):
    from citylake.llm.queries import QUERIES

    truth = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = QUERIES["op6_quality"](spark, SMALL).where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.8
