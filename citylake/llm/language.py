"""Language identification as a mixture: EM over n-gram likelihoods, the language set chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from citylake.llm.common import by_batch, prepare

UNKNOWN = "und"
BITS = 15
BUCKETS = 1 << BITS
SMOOTHING = 0.2
# Documents a language model learns from, about this many per language; one language with fewer gives all it has.
TRAIN_DOCUMENTS = 4000
# A further language must raise the log-likelihood by this times the log of the number of n-grams.
PENALTY = 4.0
ROUNDS = 25
PIECE = 1 << 20

LETTER = regex.compile(r"\p{L}")
# Every ASCII character that is no letter becomes a space.
LETTERS_ONLY = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))

PREDICTED = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of a text in lower case, letters only, and how often each occurs.

    Long texts are taken in pieces of 2^20 characters, each framed by spaces, so that memory stays bounded.
    """
    total = None
    for at in range(0, len(text), PIECE):
        raw = b" " + b" ".join(text[at : at + PIECE].lower().encode().translate(LETTERS_ONLY).split()) + b" "
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        if len(b) < 3:
            continue
        key = (b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))) * np.uint32(2654435761)
        counts = np.bincount(key >> np.uint32(32 - BITS), minlength=BUCKETS)
        total = counts if total is None else total + counts
    if total is None:
        return np.zeros(0, np.int64), np.zeros(0)
    buckets = np.flatnonzero(total)
    return buckets, total[buckets].astype(float)


@dataclass
class Model:
    """Languages in code-point order and the probability of every n-gram bucket in each; the last column is uniform noise."""

    languages: list[str]
    likelihood: np.ndarray

    def mixture(self, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the columns of p by expectation-maximisation, and the log-likelihood they reach."""
        share = np.full(p.shape[1], 1 / p.shape[1])
        total = counts.sum()
        for _ in range(ROUNDS):
            moved = share * ((counts / (p @ share)) @ p) / total
            done = np.abs(moved - share).max() < 1e-4
            share = moved
            if done:
                break
        return share, float(counts @ np.log(p @ share))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        buckets, counts = grams(text)
        if not len(buckets):
            return UNKNOWN, 0.0
        p, noise = self.likelihood[buckets], len(self.languages)
        chosen = [int((counts @ np.log(p[:, :noise])).argmax())]
        share, reached = self.mixture(p[:, [*chosen, noise]], counts)
        price = PENALTY * np.log(1 + counts.sum())
        while len(chosen) < noise:
            # The likelihood is concave in the proportions: a language whose slope is not above the total cannot raise it.
            slope = (counts / (p[:, [*chosen, noise]] @ share)) @ p[:, :noise]
            slope[chosen] = 0
            best = int(slope.argmax())
            if slope[best] <= counts.sum():
                break
            wider, higher = self.mixture(p[:, [*chosen, best, noise]], counts)
            if higher - reached <= price:
                break
            chosen, share, reached = [*chosen, best], wider, higher
        at = max(range(len(chosen)), key=lambda i: (share[i], -chosen[i]))
        return self.languages[chosen[at]], float(min(1.0, max(0.0, share[at])))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", documents: int = TRAIN_DOCUMENTS) -> Model:
    """N-gram models of the languages of a table, from about `documents` rows of each, chosen by a hash of the key.

    Rows with a null text, language or key are left out. Counts are summed on Spark; the driver gets at most
    2^15 counts per language.
    """
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where("lang is not null and key is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 1)))
    steps = 1 << 20
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(steps, -(-documents * steps // n)))))
    sample = rows.where(F.pmod(F.xxhash64("key"), F.lit(steps)) < share[F.col("lang")]).where("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for words, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                buckets, counts = grams(words)
                total = totals.setdefault(name, np.zeros(BUCKETS))
                total[buckets] += counts
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], ["lang", "bucket", "n"])

    summed = sample.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = summed.toPandas()
    languages = sorted(sizes)
    likelihood = np.full((BUCKETS, len(languages) + 1), SMOOTHING)
    for at, name in enumerate(languages):
        own = counted[counted["lang"] == name]
        likelihood[own["bucket"].to_numpy(), at] += own["n"].to_numpy()
    return Model(languages, likelihood / likelihood.sum(axis=0))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with `lang_pred` and `score`, replacing columns of these names.

    The language is the one with the largest proportion, ties to the first by code point; the score is its proportion,
    next to the other languages of the set and to noise that no language explains. A text that is null or has no
    letter is `und` with score 0, as is every text where no language was learned. No row moves.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    # Plain values: a broadcast object of a class of this package would need the package on the executors.
    names, held = docs.columns, docs.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [Model(*held.value).predict(x) for x in batch.column(names.index(text)).to_pylist()]
        predicted = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *predicted], names=[*names, "lang_pred", "score"])

    return by_batch(docs, run, StructType([*docs.schema.fields, *PREDICTED]))
