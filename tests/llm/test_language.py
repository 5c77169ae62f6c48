"""Language mixtures: held-out accuracy, mixed texts, edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from citylake.llm import language
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS

STEMS = {"aa": "ka lo mi ne pu ra si to", "bb": "sch ung der ein ver tz heit", "cc": "eau oui è é ment tre que"}


@pytest.fixture(scope="module")
def model(spark):
    import random

    rows = []
    for name, stems in STEMS.items():
        for i in range(60):
            rng, parts = random.Random(f"{name}{i}"), stems.split()
            rows.append((len(rows), " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(80)), name))
    return language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_finds_the_language_of_new_texts(model, prose):
    for name, stems in STEMS.items():
        found = [model.predict(prose(seed, 30, stems)) for seed in range(20)]
        assert {lang for lang, _ in found} == {name}
        assert min(score for _, score in found) > 0.8


def test_mixture_gives_the_larger_part(model, prose):
    mixed = prose(1, 140, STEMS["aa"]) + " " + prose(2, 60, STEMS["cc"])
    lang, score = model.predict(mixed)
    assert lang == "aa" and 0.5 < score < 0.9


def test_proportions_never_lower_the_likelihood(model, prose):
    buckets, counts = language.grams(prose(3, 50, STEMS["bb"]) + " " + prose(4, 50, STEMS["aa"]))
    p = model.likelihood[buckets]
    share, reached = model.mixture(p, counts)
    assert abs(share.sum() - 1) < 1e-9
    for at in range(p.shape[1]):
        assert reached >= counts @ np.log(p[:, at]) - 1e-6


def test_edge_rows(spark, model, edge_rows, clashing):
    df = clashing(spark.createDataFrame(edge_rows, DOCUMENTS))
    rows = language.identify(df, model).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in STEMS and 0 <= r["score"] <= 1
    empty = spark.createDataFrame([], DOCUMENTS)
    assert language.identify(empty, model).collect() == []
    untaught = language.learn(empty)
    assert {r["lang_pred"] for r in language.identify(df, untaught).collect()} == {"und"}


def test_long_texts_are_read_whole(model, prose):
    text = prose(5, 100, STEMS["aa"]) + " " + prose(6, 300_000, STEMS["bb"])
    assert len(text) > language.PIECE
    assert model.predict(text)[0] == "bb"


def test_held_out_accuracy(spark):
    from citylake.llm.queries import QUERIES

    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, SMALL).where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
