"""Reversible line deduplication: exact reference counts per line key, screened by sharded cuckoo filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from citylake.llm.common import prepare, utf8, written

# Repeated keys a filter is made for; the number of filters follows from it.
KEYS = 8192
SALTS = 4
SPACE = b" \t\n\x0b\x0c\r"
LEAST_CHARACTERS = 10
LAST = 2**63 - 1  # stands for a document without an id: after all others

SLOTS = 4
LOAD = 0.8
KICKS = 400


class CuckooFilter:
    """A set of 64-bit hashes as 16-bit fingerprints, four to a bucket, that can be added and taken out again.

    `may_hold` has no false negatives; of hashes never added it accepts about one in eight thousand.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, items: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, items) / SLOTS / LOAD))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def data(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = hashes.astype(np.uint64)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        jump = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return buckets ^ (jump & np.uint64(len(self.table) - 1)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> bool:
        """Adds the hashes; False if the filter is too full for them, and then it is to be built anew, larger."""
        rng = np.random.default_rng(len(hashes))
        prints, buckets = self._places(hashes)
        for _ in range(KICKS):
            for _ in range(2):
                free = (self.table[buckets] == 0).any(axis=1)
                # One newcomer per bucket and turn.
                _, first = np.unique(np.where(free, buckets, -1 - np.arange(len(buckets))), return_index=True)
                go = first[free[first]]
                self.table[buckets[go], (self.table[buckets[go]] == 0).argmax(axis=1)] = prints[go]
                left = np.ones(len(prints), bool)
                left[go] = False
                prints, buckets = prints[left], buckets[left]
                if not len(prints):
                    return True
                buckets = self._other(prints, buckets)
            # Both buckets full, or another newcomer went first: push out one fingerprint of every full bucket.
            _, first = np.unique(buckets, return_index=True)
            go = first[(self.table[buckets[first]] != 0).all(axis=1)]
            slot = rng.integers(0, SLOTS, len(go))
            pushed = self.table[buckets[go], slot].copy()
            self.table[buckets[go], slot] = prints[go]
            prints[go] = pushed
            buckets[go] = self._other(pushed, buckets[go])
        return False

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        prints, buckets = self._places(hashes)
        found = (self.table[buckets] == prints[:, None]).any(axis=1)
        return found | (self.table[self._other(prints, buckets)] == prints[:, None]).any(axis=1)

    def remove(self, hashes: np.ndarray) -> None:
        """Takes out hashes that were added before, one fingerprint for each."""
        prints, buckets = self._places(hashes)
        for _ in range(2):
            todo = np.arange(len(prints))
            while len(todo):
                here = self.table[buckets[todo]] == prints[todo, None]
                todo, here = todo[here.any(axis=1)], here[here.any(axis=1)]
                if not len(todo):
                    break
                _, first = np.unique(buckets[todo], return_index=True)
                self.table[buckets[todo[first]], here[first].argmax(axis=1)] = 0
                left = np.ones(len(todo), bool)
                left[first] = False
                done = np.zeros(len(prints), bool)
                done[todo[first]] = True
                prints, buckets, todo = prints[~done], buckets[~done], (np.cumsum(~done) - 1)[todo[left]]
            if not len(prints):
                return
            buckets = self._other(prints, buckets)


def line_key(line: bytes) -> bytes | None:
    """128-bit key of a line without outer white space and in ASCII lower case; None below ten code points."""
    line = line.strip(SPACE)
    if len(line) < LEAST_CHARACTERS or (len(line) < 4 * LEAST_CHARACTERS and len(line.decode()) < LEAST_CHARACTERS):
        return None
    return xxhash.xxh3_128_digest(line.lower())


def references(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per document row and distinct line key: key, doc and `h`, a hash of the row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, hashes = [], [], []
            for doc, h, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                own = {k for line in (raw or b"").split(b"\n") if (k := line_key(line))}
                keys += own
                docs += [doc] * len(own)
                hashes += [h] * len(own)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(hashes, pa.int64())], ["key", "doc", "h"])

    return identified(docs, text, key).select("doc", "h", "text").mapInArrow(run, "key binary, doc long, h long")


def identified(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id and text with `doc`, the id or a stand-in, and `h`, a hash of the text that parts the rows of one id."""
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    return docs.select(F.col(key).cast("long").alias("doc_id"), doc.alias("doc"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))


def hashes_of(keys) -> np.ndarray:
    """The 64 bits of each key that the filters use."""
    return np.frombuffer(b"".join(keys), "<u8")[1::2]


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


REPEATED = "first < last"
FILTER = "shard int, filter binary, full boolean"


def totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"), F.max("doc").alias("last")]


def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The filter of a shard, as large as it needs to be."""
    hashes, items = hashes_of(rows["key"]), max(64, len(rows))
    while not (made := CuckooFilter.sized(items)).add(hashes):
        items *= 2
    return pd.DataFrame({"shard": [key[0]], "filter": [made.data()], "full": [False]})


@dataclass
class LineIndex:
    """References (key, doc, h), exact counts (key, refs, first, last) and, per shard of the keys, a cuckoo filter of those
    found in two documents or more. All three are tables in the shared folder; every change writes new ones. The number
    of shards is set when the filters are first built and again when the repeated keys have outgrown them fourfold.
    """

    spark: SparkSession
    refs: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None
    shards: int = 0

    def insert(self, docs: DataFrame, text: str = "text", key: str = "doc_id") -> LineIndex:
        """The index with the lines of further documents. Counts are combined before rows move, so hot lines do no harm."""
        prepare(self.spark)
        new = written(references(docs, text, key), "line-refs")
        fresh = new.groupBy("key").agg(*totals())
        if self.counts is None:
            return LineIndex(self.spark, new, written(fresh, "line-counts"))._rebuilt()
        both = self.counts.withColumn("was", F.expr(REPEATED)).unionByName(fresh.withColumn("was", F.lit(False)))
        summed = [F.sum("refs").alias("refs"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("was").alias("was")]
        merged = written(both.groupBy("key").agg(*summed), "line-counts")
        index = LineIndex(self.spark, self.refs.unionByName(new), merged.drop("was"), self.filters, self.shards)
        if merged.where(REPEATED).count() > 4 * KEYS * self.shards:
            return index._rebuilt()
        return index._extended(merged.where(f"{REPEATED} and not was").select("key"))

    def delete(self, docs: DataFrame, key: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids, as if they had never been inserted."""
        gone = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc")).distinct()
        left = written(self.refs.join(gone, "doc", "left_anti").select("key", "doc", "h"), "line-refs")
        touched = self.refs.join(gone, "doc", "left_semi").select("key").distinct()
        recount = left.join(touched, "key", "left_semi").groupBy("key").agg(*totals())
        counts = written(self.counts.join(touched, "key", "left_anti").unionByName(recount), "line-counts")
        before = self.counts.where(REPEATED).join(touched, "key", "left_semi").select("key")
        single = before.join(counts.where(REPEATED).select("key"), "key", "left_anti")
        return LineIndex(self.spark, left, counts, self.filters, self.shards)._reduced(single)

    def _rebuilt(self) -> LineIndex:
        """All filters anew, from the exact counts."""
        repeated = self.counts.where(REPEATED).select("key")
        shards = 1 + repeated.count() // KEYS
        made = repeated.groupBy(shard_of(shards).alias("shard")).applyInPandas(build, FILTER)
        return replace(self, filters=written(made, "line-filters"), shards=shards)

    def _extended(self, added: DataFrame) -> LineIndex:
        """Filters with further keys; one that gets too full is built anew from the exact counts of its shard."""

        def extend(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(old):
                return build(key, rows)
            held = CuckooFilter.read(old["filter"].iloc[0])
            full = len(rows) > 0 and not held.add(hashes_of(rows["key"]))
            return pd.DataFrame({"shard": [key[0]], "filter": [held.data()], "full": [full]})

        grouped = self.filters.groupBy("shard").cogroup(added.withColumn("shard", shard_of(self.shards)).groupBy("shard"))
        made = written(grouped.applyInPandas(extend, FILTER), "line-filters")
        if made.where("full").isEmpty():
            return replace(self, filters=made)
        repeated = self.counts.where(REPEATED).select("key", shard_of(self.shards).alias("shard"))
        again = repeated.join(made.where("full").select("shard"), "shard", "left_semi").groupBy("shard").applyInPandas(build, FILTER)
        return replace(self, filters=written(made.where("not full").unionByName(again), "line-filters"))

    def _reduced(self, gone: DataFrame) -> LineIndex:
        """Filters without keys they hold."""

        def reduce(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(old):
                return pd.DataFrame({"shard": [], "filter": [], "full": []})
            held = CuckooFilter.read(old["filter"].iloc[0])
            if len(rows):
                held.remove(hashes_of(rows["key"]))
            return pd.DataFrame({"shard": [key[0]], "filter": [held.data()], "full": [False]})

        grouped = self.filters.groupBy("shard").cogroup(gone.withColumn("shard", shard_of(self.shards)).groupBy("shard"))
        return replace(self, filters=written(grouped.applyInPandas(reduce, FILTER), "line-filters"))

    def screened(self, refs: DataFrame) -> DataFrame:
        """References whose key a filter may hold. References meet the filter of their shard in salted parts, filter
        first, and are streamed past it, so that a task holds one filter and no group of references."""
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        heads = self.filters.select("shard", salts.alias("salt"), F.lit(0).alias("kind"), F.col("filter").alias("key"), *(F.lit(0).cast("long").alias(c) for c in ("doc", "h")))
        tails = refs.select(shard_of(self.shards).alias("shard"), F.pmod(F.xxhash64("doc", "h"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("kind"), "key", "doc", "h")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, None
            for batch in batches:
                shard, kind = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                edges = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 0))))
                for start, stop in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                    part = batch.slice(start, stop - start)
                    if kind[start] == 0:
                        at, held = shard[start], CuckooFilter.read(part.column(3)[0].as_py())
                    elif at == shard[start]:
                        mask = held.may_hold(hashes_of(part.column(3).to_pylist()))
                        yield pa.RecordBatch.from_arrays(part.columns[3:], names=["key", "doc", "h"]).filter(pa.array(mask))

        met = heads.unionByName(tails).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        return met.mapInArrow(run, "key binary, doc long, h long")

    def drops(self, refs: DataFrame) -> DataFrame:
        """Per document and text the keys whose lines go: repeated keys that a smaller document holds too. Columns doc, h,
        keys. Rows without an id are one document, yet a list has no more keys than the text it is for."""
        repeated = self.counts.where(REPEATED).select("key", "first")
        lost = self.screened(refs).join(repeated, "key").where(F.col("doc") > F.col("first"))
        return lost.groupBy("doc", "h").agg(F.collect_set("key").alias("keys"))

    def clean(self, docs: DataFrame, text: str = "text", key: str = "doc_id", inserted: bool = False) -> DataFrame:
        """Per row of the table: doc_id, n_lines, n_dropped and kept, the text without the lines that go.

        A key of ten code points or more that two documents hold keeps its lines only in the document with the smallest
        id. A null or empty text is one empty line. Repeated rows of an id are one document; rows without an id together
        are one that stands last. With `inserted` the documents are those of the index, whose references are at hand.
        An empty table gives no rows.
        """
        refs = self.refs if inserted else references(docs, text, key)
        joined = identified(docs, text, key).join(self.drops(refs), ["doc", "h"], "left").select("doc_id", "text", "keys")
        fields = [StructField("doc_id", LongType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept", StringType())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total, lost, kept = [], [], []
                for raw, keys in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                    lines, gone = (raw or b"").split(b"\n"), set(keys or ())
                    stay = [line for line in lines if line_key(line) not in gone] if gone else lines
                    total.append(len(lines))
                    lost.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                columns = [batch.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

        return joined.mapInArrow(run, StructType(fields))
