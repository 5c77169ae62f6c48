"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from citylake.llm import mixing
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS
from tests.llm.test_decontamination import plain as hits
from tests.llm.test_neardup import plain as classes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before and after every stage, for documents short enough for the plain versions."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 900")
    odd = [(9001, None, None, None, None), (9002, "", "en", "a", 0), (9003, "12 34 !?", "en", "a", 8), (9004, "This one is fine.", None, None, None)]
    odd.append((9005, spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"], "en", "b", 1))
    docs = docs.unionByName(spark.createDataFrame(odd, DOCUMENTS))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"], str(r))) for df in out]


def test_stages_keep_the_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(sorted(rows[0]) == sorted(COLUMNS) for rows in steps[:-1])
    assert sorted(steps[-1][0]) == sorted([*COLUMNS, "shard", "slot"])


def test_language_drops_what_has_no_letters_and_nothing_clean(steps):
    gone = {r["doc_id"] for r in steps[0]} - {r["doc_id"] for r in steps[1]}
    assert gone == {9001, 9002, 9003}


def test_one_document_of_each_class_stays(steps):
    wanted = classes([(r["doc_id"], r["text"]) for r in steps[1]])
    assert [r["doc_id"] for r in steps[2]] == sorted(set(wanted.values()))


def test_contaminated_documents_go(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = hits([(r["doc_id"], r["text"]) for r in steps[2]], items)
    clean = sorted(d for d, n, hit, _ in found if not (hit and 20 * hit >= n))
    assert [r["doc_id"] for r in steps[3]] == clean and len(clean) < len(steps[2])


def test_mix_follows_the_targets(steps):
    size, times = Counter(), Counter(r["doc_id"] for r in steps[4])
    for r in steps[3]:
        size[r["source"]] += len(r["text"].split())
    names = sorted(s for s in size if s is not None) + [None] * (None in size)
    sources = [mixing.Source(s, size[s], 1 + i % 3) for i, s in enumerate(names)]
    mixing.set_targets(sources)
    assert set(times) <= {r["doc_id"] for r in steps[3]} and max(times.values()) <= 3
    words = sum(times[r["doc_id"]] * len(r["text"].split()) for r in steps[3])
    assert abs(words - sum(size.values())) < 0.15 * words
    light, heavy = ({s.name for s in sources if s.weight == w} for w in (1, 3))
    got = lambda some: sum(times[r["doc_id"]] * len(r["text"].split()) for r in steps[3] if r["source"] in some)
    assert got(heavy) > 1.5 * got(light)


def test_all_documents_get_a_shard(steps):
    assert [tuple(r[c] for c in COLUMNS) for r in steps[5]] == [tuple(r[c] for c in COLUMNS) for r in sorted(steps[4], key=lambda r: (r["doc_id"], str(r)))]
    slots = {}
    for r in steps[5]:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES], ids=[name for name, _ in corpus_pipeline.STAGES])
def test_own_columns_of_any_name_stay(spark, clashing, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) between 200 and 900")
    df = clashing(docs)
    kept = stage(spark, df, SMALL)
    own = [c for c in df.columns if c not in ("shard", "slot")] if stage is corpus_pipeline.shard_documents else df.columns
    assert kept.select(*own).exceptAll(df.select(*own).unionAll(df.select(*own)).unionAll(df.select(*own))).isEmpty()
    assert not kept.isEmpty()
    assert stage is corpus_pipeline.shard_documents or kept.columns == df.columns


def test_run_and_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert corpus_pipeline.ORACLE_SQL is None
