"""Suffix-array dedup: a logarithmic family of sampled suffix arrays, scanned together for long equal byte strings."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StructField

from citylake.llm.common import prepare, written
from citylake.llm.repeats import Rule, recurring, resolved, runs

LENGTH = 400
RULE = Rule(window=LENGTH, gram=200, words=False, ordered=False)


def in_suffix_array(contexts: list[tuple[int, int, int, bytes]], rule: Rule) -> list[np.ndarray]:
    """Which suffixes share their first `rule.window` bytes with another: neighbours in the sorted array of all suffixes."""
    suffixes = [sliding_window_view(np.frombuffer(raw, np.uint8), rule.window) for *_, raw in contexts]
    counts = [len(s) for s in suffixes]
    joined = np.concatenate(suffixes).view(f"S{rule.window}")[:, 0]
    order = np.argsort(joined, kind="stable")
    equal = joined[order[1:]] == joined[order[:-1]]
    flags = np.zeros(len(joined), bool)
    flags[order[1:]] |= equal
    flags[order[:-1]] |= equal
    return np.split(flags, np.cumsum(counts)[:-1])


def cut_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, int, bytes]:
    """Bytes, bytes removed, removed runs and what is left."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at:start])
        at = end
    return len(raw), sum(end - start for start, end in spans), len(spans), b"".join([*kept, raw[at:]])


CUT = [
    (StructField("n_bytes", LongType()), pa.int64()),
    (StructField("n_removed", LongType()), pa.int64()),
    (StructField("n_spans", LongType()), pa.int64()),
    (StructField("kept", BinaryType()), pa.binary()),
]


@dataclass
class SuffixFamily:
    """Sparse suffix arrays of the batches so far, each level a table of sampled suffixes with its number of rows.

    A level holds the suffixes at the anchors of its texts (see `repeats`), in the order of the hash of their first bytes,
    and `met` the anchors found to recur, one table per batch. A new batch gets an array of its own, is scanned against
    all levels and becomes a level; while the last two are of the same order of size they are merged, so that there are
    no more levels than the logarithm of the rows, and a row is written that often.
    """

    spark: SparkSession
    rule: Rule = RULE
    levels: list[tuple[int, DataFrame]] = field(default_factory=list)
    met: list[DataFrame] = field(default_factory=list)

    def add(self, docs: DataFrame, text: str = "text", key: str = "doc_id") -> SuffixFamily:
        """The family with the texts of a further batch, once it is scanned against itself and all levels."""
        prepare(self.spark)
        array = written(runs(docs, self.rule, text, key), "suffixes")
        met = recurring(array, self.scan() if self.levels else None)
        size, levels, merged = array.count(), list(self.levels), array
        while levels and _order(levels[-1][0]) <= _order(size):
            other, held = levels.pop()
            merged, size = held.unionByName(merged), size + other
        if merged is not array:
            merged = written(merged.sortWithinPartitions("key", "ctx"), "suffixes")
        return SuffixFamily(self.spark, self.rule, [*levels, (size, merged)], [*self.met, met])

    def scan(self) -> DataFrame:
        """All levels, to be met by the hash of their first bytes."""
        return reduce(DataFrame.unionByName, [held for _, held in self.levels])

    def matches(self) -> DataFrame:
        """The anchors that the scans found to recur, each once."""
        return self.met[0] if len(self.met) == 1 else written(reduce(DataFrame.unionByName, self.met).distinct(), "anchors")

    def clean(self, docs: DataFrame, text: str = "text", key: str = "doc_id", finish=cut_bytes, fields=CUT) -> DataFrame:
        """Per row: doc_id and, by default, n_bytes, n_removed, n_spans and `kept`, the bytes that are left.

        The rows are documents of the family. Every byte goes that is covered by a string of 400 bytes which starts
        anywhere else in the family, the same text included; strings are judged on the input. Matches never cross
        documents, a null text is empty, repeated rows are documents of their own, an empty table gives no rows.
        """
        return resolved(docs, self.scan(), self.matches(), self.rule, in_suffix_array, finish, fields, text, key)


def _order(rows: int) -> int:
    return int(math.log2(rows + 1))
