"""Windows of a sequence that occur elsewhere, found without a row per window.

Windows are cut into runs of neighbours that share an anchor: the smallest hash of a short gram in the window, the leftmost
if several are equal. Equal windows have equal anchors, so only runs whose anchor occurs twice are looked at again; runs
that are equal as a whole settle all their windows at once; of the others one copy each is compared window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from citylake.llm.common import checkpointed, prepare, utf8, written

LAST = 2**63 - 1  # stands for a document without an id: after all others
SEGMENT = 1 << 18
# Variants of the surroundings of one anchor that one task compares; more are compared as rows.
VARIANTS = 2000
CHUNK = 1 << 17

BASE = 0x9E3779B97F4A7C15
POWERS = 2 * SEGMENT
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))


@dataclass(frozen=True)
class Rule:
    """Length of a window and of a gram, in bytes or in words, and what counts as elsewhere.

    With `ordered` a window counts only if it also occurs in a document with a smaller id, else if it occurs twice.
    """

    window: int
    gram: int
    words: bool
    ordered: bool

    def parts(self, raw: bytes) -> list[bytes]:
        return raw.split()

    def symbols(self, raw: bytes) -> np.ndarray:
        if self.words:
            parts = self.parts(raw)
            return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
        return np.frombuffer(raw, np.uint8).astype(np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once per worker."""
    if not _powers or len(_powers[0]) < n:
        made = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(max(n, POWERS), base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        _powers[:] = made
    return _powers


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums from which `span_hash` takes the polynomial hash of any span."""
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(mix(symbols + np.uint64(1)) * powers(len(symbols) + 1)[1][: len(symbols)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[0][start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks in both directions."""
    blocks = np.concatenate((values, np.full(-len(values) % width, np.uint64(2**64 - 1)))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    total = len(values) - width + 1
    return np.minimum(back[:total], ahead[width - 1 : width - 1 + total])


def runs_of(symbols: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, hash of all the run covers, first window and number of windows of every run of a text.

    Long texts are taken in segments of windows; a segment's end only cuts a run in two.
    """
    found = []
    for at in range(0, len(symbols) - rule.window + 1, SEGMENT):
        part = symbols[at : at + SEGMENT + rule.window - 1]
        sums = prefix_sums(part)
        grams = np.arange(len(part) - rule.gram + 1)
        grams = span_hash(sums, grams, grams + rule.gram)
        least = sliding_min(grams, rule.window - rule.gram + 1)
        fresh = np.concatenate(([True], (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])))
        lo = np.flatnonzero(fresh)
        n = np.diff(np.append(lo, len(least)))
        found.append((least[lo], span_hash(sums, lo, lo + n - 1 + rule.window) ^ n.astype(np.uint64), lo + at, n))
    if not found:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def identified(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id and text with `doc`, the id or a stand-in, and `h`, a hash of the text: rows equal in both are copies.

    Rows without an id share the stand-in, so that `h` alone tells their texts apart: it has all 64 bits.
    """
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    return docs.select(F.col(key).cast("long").alias("doc_id"), doc.alias("doc"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))


def runs(docs: DataFrame, rule: Rule, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All runs of a table, each task's in the order of their anchors: key, ctx, doc, h, lo, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs_of(rule.symbols(raw or b""), rule) for raw in utf8(batch.column(2))]
            counts = [len(x[0]) for x in found]
            columns = [np.repeat(batch.column(0).to_numpy(), counts), np.repeat(batch.column(1).to_numpy(), counts)]
            anchors, contexts, lo, n = (np.concatenate([x[i] for x in found]) for i in range(4))
            made = [anchors.view(np.int64), contexts.view(np.int64), *columns, lo.astype(np.int32), n.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["key", "ctx", "doc", "h", "lo", "n"])

    made = identified(docs, text, key).select("doc", "h", "text").mapInArrow(run, "key long, ctx long, doc long, h long, lo int, n int")
    return made.sortWithinPartitions("key", "ctx")


Compare = Callable[[list[tuple[int, int, int, bytes]], Rule], list[np.ndarray]]


def ranges_of(flags: np.ndarray) -> list[dict]:
    """Half-open runs of true values."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]


def window_hashes(contexts: list[tuple[int, int, int, bytes]], rule: Rule) -> list[np.ndarray]:
    out = []
    for *_, raw in contexts:
        sums = prefix_sums(rule.symbols(raw))
        at = np.arange(len(sums) - rule.window)
        out.append(span_hash(sums, at, at + rule.window))
    return out


def window_digests(raw: bytes, rule: Rule) -> list[bytes]:
    """128-bit hash of what each window of a context holds; words stand one space apart."""
    if not rule.words:
        return [xxhash.xxh3_128_digest(raw[at : at + rule.window]) for at in range(len(raw) - rule.window + 1)]
    ends = np.cumsum([len(part) + 1 for part in rule.parts(raw)]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(ends) - rule.window + 1
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts[:total].tolist(), ends[rule.window - 1 :].tolist(), strict=True)]


def compared(contexts: DataFrame, rule: Rule, compare: Compare) -> DataFrame:
    """Which windows of each context occur elsewhere: key, ctx, ranges of windows.

    Contexts (key, ctx, doc, raw, variants) of one anchor meet in one task while they are few. Those of an anchor with
    more than VARIANTS are compared as rows, one per window with a 128-bit hash of it, summed up before they move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []

        def settled() -> pa.RecordBatch:
            flags = compare(held, rule)
            rows = [(c[0], c[1], ranges_of(f)) for c, f in zip(held, flags, strict=True) if f.any()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), SPAN))]
            return pa.RecordBatch.from_arrays(columns, names=["key", "ctx", "ranges"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if len(held) * rule.window > CHUNK and row[0] != held[-1][0]:
                    yield settled()
                    held = []
                held.append(row)
        if held:
            yield settled()

    few = contexts.where(F.col("variants") <= VARIANTS).select("key", "ctx", "doc", "raw")
    small = few.repartition("key").sortWithinPartitions("key").mapInArrow(run, StructType([StructField("key", LongType()), StructField("ctx", LongType()), StructField("ranges", SPANS)]))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            hashes = [window_digests(r[3], rule) for r in rows]
            counts = [len(x) for x in hashes]
            columns = [np.repeat(np.array([r[i] for r in rows], np.int64), counts) for i in range(3)]
            at = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
            yield pa.RecordBatch.from_arrays([*map(pa.array, (*columns, at)), pa.array([w for x in hashes for w in x], pa.binary())], names=["key", "ctx", "doc", "at", "w"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for at in batch.column(2).to_pylist():
                flags = np.zeros(max(at) + 1, bool)
                flags[at] = True
                made.append(ranges_of(flags))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, SPAN)], names=["key", "ctx", "ranges"])

    many = contexts.where(F.col("variants") > VARIANTS).select("key", "ctx", "doc", "raw")
    rows = many.mapInArrow(explode, "key long, ctx long, doc long, at int, w binary")
    seen = rows.groupBy("w").agg(F.count(F.lit(1)).alias("times"), F.min("doc").alias("first")).where("times > 1")
    again = rows.join(seen, "w").where(F.col("first") < F.col("doc") if rule.ordered else F.lit(True))
    large = again.groupBy("key", "ctx").agg(F.collect_list("at").alias("at")).mapInArrow(join, small.schema)
    return small.unionByName(large)


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


Finish = Callable[[bytes, list[tuple[int, int]]], tuple]


def recurring(found: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """The anchors that occur twice in the runs, or in them and in earlier ones: key.

    Both sides are counted in their tasks before they meet, so an anchor is one row however often it occurs; the result
    is written, so that a join with it is between plain exchanges, whose hot keys Spark can split.
    """
    own = found.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    if earlier is None:
        return written(own.where("times > 1").select("key"), "anchors")
    before = earlier.groupBy("key").agg(F.lit(True).alias("before"))
    return written(own.join(before, "key", "left").where("times > 1 or before").select("key"), "anchors")


def resolved(docs: DataFrame, found: DataFrame, anchors: DataFrame, rule: Rule, compare: Compare, finish: Finish, fields: list[tuple[StructField, pa.DataType]], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of the table doc_id and what `finish` makes of its text and its covered spans, in symbols.

    `found` are the runs of (at least) these documents, `anchors` those of their anchors that recur, each once. Texts
    move once; only those with a run that has to be compared window by window are kept for a second, smaller join.
    """
    spark = prepare(docs.sparkSession)
    candidates = checkpointed(found.join(anchors, "key"))
    where = F.struct("doc", "h", "lo", "n")
    kinds = candidates.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("copies"), F.min(where).alias("model"))
    totals = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("variants"), F.min("model.doc").alias("first"))
    kinds = checkpointed(kinds.join(totals, "key"))
    if rule.ordered:
        whole, open_ = F.col("doc") > F.col("model.doc"), (F.col("doc") == F.col("model.doc")) & (F.col("first") < F.col("doc"))
    else:
        whole, open_ = F.col("copies") > 1, (F.col("copies") == 1) & (F.col("variants") > 1)
    marked = candidates.join(kinds, ["key", "ctx"]).select(
        "doc", "h", "key", "ctx", "lo", "n", "variants", whole.alias("whole"), open_.alias("open"), ((F.col("variants") > 1) & (F.col("model") == where)).alias("model")
    )
    marked = checkpointed(marked.where("whole or open or model"))
    one = F.struct("lo", (F.col("lo") + F.col("n")).alias("hi"))
    asked = F.struct("key", "ctx", "lo", "n", "variants")
    # Copies share one list, however many there are.
    listed = marked.groupBy("doc", "h").agg(
        F.collect_set(F.when(F.col("whole"), one)).alias("whole"), F.collect_set(F.when(F.col("model"), asked)).alias("asked"), F.max("open").alias("open")
    )
    rows = identified(docs, text, key)
    schema = StructType([StructField("doc_id", LongType()), *(f for f, _ in fields)])
    names = schema.fieldNames()

    def outcome(ids: pa.Array, done: list[tuple | None]) -> list[pa.Array]:
        return [ids, *(pa.array([d and d[i] for d in done], kind) for i, (_, kind) in enumerate(fields))]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws, wholes, askeds, opens = batch.column(0), utf8(batch.column(3)), batch.column(4).to_pylist(), batch.column(5), batch.column(6).to_pylist()
            spans = [[(s["lo"], s["hi"] - 1 + rule.window) for s in whole or ()] for whole in wholes]
            done = [None if o else finish(raw or b"", joined_spans(s)) for raw, s, o in zip(raws, spans, opens, strict=True)]
            needed = pa.array([bool(o) for o in opens])
            kept = [raw if o or len(a or ()) else None for raw, o, a in zip(raws, opens, askeds.to_pylist(), strict=True)]
            held = [pa.array([[{"start": a, "end": b} for a, b in s] if o else None for s, o in zip(spans, opens, strict=True)], SPAN)]
            yield pa.RecordBatch.from_arrays([*outcome(ids, done), batch.column(1), batch.column(2), needed, pa.array(kept, pa.binary()), *held, askeds], names=[*names, "doc", "h", "open", "raw", "spans", "asked"])

    joined = rows.join(listed, ["doc", "h"], "left").select("doc_id", "doc", "h", "text", "whole", "asked", "open")
    extra = StructType([StructField("doc", LongType()), StructField("h", LongType()), joined.schema["open"], StructField("raw", joined.sparkSession.range(0).select(F.lit(b"").alias("b")).schema["b"].dataType), StructField("spans", SPANS), joined.schema["asked"]])
    state = written(joined.mapInArrow(first, StructType([*schema.fields, *extra.fields])), "repeats")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, raw, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = rule.parts(raw) if rule.words else raw
                for x in asked:
                    part = parts[x["lo"] : x["lo"] + x["n"] - 1 + rule.window]
                    out.append((x["key"], x["ctx"], doc, b" ".join(part) if rule.words else part, x["variants"]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["key", "ctx", "doc", "raw", "variants"])

    some = state.where("raw is not null and size(asked) > 0").select("doc", "raw", "asked").mapInArrow(contexts, "key long, ctx long, doc long, raw binary, variants long")
    # A document that stands in the table more than once gives its contexts once.
    ranges = compared(some.dropDuplicates(["key", "ctx"]), rule, compare)
    cut = marked.where("open").join(ranges, ["key", "ctx"]).select("doc", "h", "lo", F.explode("ranges").alias("r"))
    late = cut.groupBy("doc", "h").agg(F.collect_set(F.struct((F.col("lo") + F.col("r.start")).alias("start"), (F.col("lo") + F.col("r.end")).alias("end"))).alias("late"))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for raw, spans, late in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                more = [(x["start"], x["end"] - 1 + rule.window) for x in late or ()]
                done.append(finish(raw, joined_spans([*((x["start"], x["end"]) for x in spans), *more])))
            yield pa.RecordBatch.from_arrays(outcome(batch.column(0), done), names=names)

    pending = state.where("open").select("doc_id", "doc", "h", "raw", "spans").join(late, ["doc", "h"], "left")
    settled = state.where("open is null or not open").select(*names)
    return settled.unionByName(pending.select("doc_id", "raw", "spans", "late").mapInArrow(last, schema))
