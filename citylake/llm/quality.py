"""Quality score of a text by a small byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from citylake.llm.common import prepare, utf8

# Labelled documents the network learns from, about this many, and the longest text among them in bytes.
TRAIN_DOCUMENTS = 4000
TRAIN_BYTES = 1 << 16

FILTERS = 32
WIDTH = 6  # bytes a filter sees; it moves by two
HIDDEN = 16
BLOCK = 512  # bytes; a chunk is two neighbouring blocks, so chunks overlap by half
SLAB = 64  # blocks held at once
EPOCHS, LEAST_STEPS, GROUP, RATE = 12, 900, 32, 0.01
PADDING = -8.0  # weight of the padding byte: no filter fires on it


def padded(raw: bytes) -> bytes:
    """A text filled up to whole blocks, with at least the width of a filter behind it."""
    return raw.replace(b"\0", b"\1").ljust(-(-(len(raw) + WIDTH - 2) // BLOCK) * BLOCK, b"\0")


@dataclass
class Network:
    """Filters over bytes, the largest answer of each filter per chunk, and one probability from their mean and maximum."""

    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray
    pairs: list[np.ndarray] = field(default_factory=list)

    def compose(self) -> None:
        """Weights of byte pairs, so that one look-up serves two bytes."""
        self.filters[:, 0, :] = PADDING
        first, second = self.filters[0::2], self.filters[1::2]
        # Little-endian pairs: the first byte of the text is the low one.
        self.pairs = [(b[:, None, :] + a[None, :, :]).reshape(65536, FILTERS).astype(np.float32) for a, b in zip(first, second, strict=True)]
        self.pairs[0] += self.bias.astype(np.float32)

    def blocks(self, data: bytes, where: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of every filter in every block and, if asked for, the position where it stands."""
        pair = np.frombuffer(data + b"\0" * (WIDTH - 2), "<u2")
        per, total = BLOCK // 2, len(data) // BLOCK
        best, at = np.empty((total, FILTERS), np.float32), np.empty((total if where else 0, FILTERS), np.int64)
        for start in range(0, total, SLAB):
            stop = min(total, start + SLAB)
            answer = np.take(self.pairs[0], pair[start * per : stop * per], axis=0)
            for k in range(1, WIDTH // 2):
                answer += np.take(self.pairs[k], pair[start * per + k : stop * per + k], axis=0)
            answer = answer.reshape(stop - start, per, FILTERS)
            if where:
                place = answer.argmax(axis=1)
                best[start:stop] = np.take_along_axis(answer, place[:, None, :], axis=1)[:, 0, :]
                at[start:stop] = place + np.arange(start, stop)[:, None] * per
            else:
                answer.max(axis=1, out=best[start:stop])
        return np.maximum(best, 0), at

    def chunks(self, best: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Answers per chunk, the first chunk of each text and the block each answer came from."""
        ends = np.cumsum(counts)
        starts = ends - counts
        many = np.maximum(1, counts - 1)
        firsts = np.cumsum(many) - many
        left = np.repeat(starts - firsts, many) + np.arange(many.sum())
        right = np.minimum(left + 1, np.repeat(ends - 1, many))
        later = best[right] > best[left]
        return np.where(later, best[right], best[left]), firsts, np.where(later, right[:, None], left[:, None])

    def features(self, answers: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        many = np.diff(np.append(firsts, len(answers)))[:, None]
        return np.concatenate([np.add.reduceat(answers, firsts) / many, np.maximum.reduceat(answers, firsts)], axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text; an empty text is one block of padding."""
        data = [padded(t) for t in texts]
        best, _ = self.blocks(b"".join(data))
        answers, firsts, _ = self.chunks(best, np.array([len(d) // BLOCK for d in data]))
        hidden = np.tanh(self.features(answers.astype(float), firsts) @ self.inner + self.inner_bias)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.outer + self.outer_bias, -30, 30)))


def new_network(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.4, (WIDTH, 256, FILTERS)),
        np.zeros(FILTERS),
        rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 0.2, HIDDEN),
        np.zeros(()),
    )


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Fits the network by Adam on the log loss; the gradient of a maximum goes to the position that reached it."""
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    names = ("filters", "bias", "inner", "inner_bias", "outer", "outer_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    data, truth = [padded(t) for t in texts], np.array(labels, float)
    per_epoch = -(-len(data) // GROUP)
    steps = max(EPOCHS * per_epoch, LEAST_STEPS) if data else 0
    order: list[np.ndarray] = []
    for step in range(1, steps + 1):
        order = order or list(np.array_split(rng.permutation(len(data)), per_epoch))
        picked = order.pop()
        net.compose()
        joined = b"".join(data[i] for i in picked)
        best, at = net.blocks(joined, where=True)
        answers, firsts, source = net.chunks(best, np.array([len(data[i]) // BLOCK for i in picked]))
        answers = answers.astype(float)
        feature = net.features(answers, firsts)
        hidden = np.tanh(feature @ net.inner + net.inner_bias)
        guess = 1 / (1 + np.exp(-np.clip(hidden @ net.outer + net.outer_bias, -30, 30)))
        slope = (guess - truth[picked]) / len(picked)
        back = np.outer(slope, net.outer) * (1 - hidden**2)
        to_feature = back @ net.inner.T
        many = np.diff(np.append(firsts, len(answers)))
        to_answer = np.repeat(to_feature[:, :FILTERS] / many[:, None], many, axis=0)
        largest = np.repeat(feature[:, FILTERS:], many, axis=0)
        to_answer += np.where(answers == largest, np.repeat(to_feature[:, FILTERS:], many, axis=0), 0)
        to_answer[answers <= 0] = 0
        place = 2 * np.take_along_axis(at, source, axis=0)
        column = np.broadcast_to(np.arange(FILTERS), place.shape)
        raw = np.frombuffer(joined + b"\0" * WIDTH, np.uint8)
        to_filters = np.stack(
            [np.bincount((raw[place + k].astype(np.int64) * FILTERS + column).ravel(), to_answer.ravel(), 256 * FILTERS).reshape(256, FILTERS) for k in range(WIDTH)]
        )
        gradient = {
            "filters": to_filters,
            "bias": to_answer.sum(axis=0),
            "inner": feature.T @ back,
            "inner_bias": back.sum(axis=0),
            "outer": hidden.T @ slope,
            "outer_bias": slope.sum(),
        }
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for n in names:
            first[n] = 0.9 * first[n] + 0.1 * gradient[n]
            second[n] = 0.99 * second[n] + 0.01 * gradient[n] ** 2
            moved = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
            setattr(net, n, getattr(net, n) - moved)
    if data and truth.min() == truth.max():
        net.outer, net.outer_bias = np.zeros(HIDDEN), np.array(30.0 if truth[0] else -30.0)
    net.compose()
    return net


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", documents: int = TRAIN_DOCUMENTS, longest: int = TRAIN_BYTES) -> Network:
    """The network, from about `documents` labelled rows chosen by a hash of the key, none longer than `longest` bytes.

    The sample is the only thing that reaches the driver: at most about documents x longest bytes. Rows with a null
    key, label or text are left out; of several labels of a key the smallest counts. Without rows the network is the
    initial one.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).na.drop().groupBy("key").agg(F.min("label").alias("label"))
    steps = 1 << 20
    share = min(steps, -(-documents * steps // max(1, known.count())))
    sample = known.where(F.pmod(F.xxhash64("key"), F.lit(steps)) < share)
    texts = docs.select(F.col(key).alias("key"), "text").where(F.octet_length("text") <= longest)
    rows = texts.join(F.broadcast(sample), "key").toArrow()
    order = np.argsort(rows.column("key").to_numpy(), kind="stable")
    raw, truth = utf8(rows.column("text").combine_chunks()), rows.column("label").to_pylist()
    return train([raw[i] for i in order], [truth[i] for i in order])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """The documents with a column `score`, replacing one of this name; every text counts whole, a null one as empty.

    No row moves.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("score")
    names, schema = docs.columns, StructType([*docs.schema.fields, StructField("score", DoubleType())])
    # Plain arrays: a broadcast object of a class of this package would need the package on the executors.
    weights = [getattr(network, n) for n in ("filters", "bias", "inner", "inner_bias", "outer", "outer_bias")]
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(*held.value)
        network.compose()
        for batch in batches:
            if batch.num_rows:
                scores = network.score([raw or b"" for raw in utf8(batch.column(names.index("text")))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, "score"])

    return docs.mapInArrow(run, schema)
