"""Benchmark decontamination with one Aho-Corasick automaton over normalised test texts."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from citylake.llm.common import char_offsets, checkpointed, prepare, utf8

WINDOW = 13
# Largest automaton input per pass, in bytes of patterns; a larger benchmark takes several passes over the documents.
PATTERN_BYTES = 64 << 20

# Upper case to lower case, every other ASCII character that is no digit or letter to a space.
NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)

SPAN = StructType([StructField("start", LongType(), False), StructField("end", LongType(), False)])
SPANS = pa.list_(pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]))
EXTRA = ("n_words", "hits", "item_ids")
FOUND = [StructField("n_words", LongType()), StructField("hits", ArrayType(SPAN)), StructField("item_ids", ArrayType(StringType()))]


def patterns_of(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Distinct windows of the test texts with their items; an item shorter than a window is one window.

    Null or empty texts, and rows without an item id, have none.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[bytes, str]] = set()
            for raw, item in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = raw.translate(NORMAL).split()
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    out.add((b" ".join(words[at : at + window]), item))
            pairs = sorted(out)
            yield pa.record_batch([pa.array([p for p, _ in pairs], pa.binary()), pa.array([i for _, i in pairs], pa.string())], ["pattern", "item"])

    rows = benchmark.select(F.col(text).alias("t"), F.col(item_id).cast("string").alias("i")).na.drop()
    return rows.mapInArrow(windows, "pattern binary, item string").groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def scanner(patterns: list[tuple[bytes, list[str]]]):
    """Function from the UTF-8 bytes of a text to (words, hit word runs, items), scanning the text once."""
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns:
        framed = f" {pattern.decode('latin-1')} "
        automaton.add_word(framed, (len(framed), pattern.count(b" ") + 1, items))
    automaton.make_automaton()

    def scan(raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        words = raw.translate(NORMAL).split()
        framed = f" {b' '.join(words).decode('latin-1')} "
        found = list(automaton.iter(framed)) if patterns and words else []
        if not found:
            return len(words), [], set()
        spaces = np.flatnonzero(np.frombuffer(framed.encode("latin-1"), np.uint8) == 0x20)
        firsts = np.searchsorted(spaces, [end - length + 1 for end, (length, _, _) in found]).tolist()
        items = {item for _, (_, _, of) in found for item in of}
        return len(words), merge((first, first + count) for first, (_, (_, count, _)) in zip(firsts, found, strict=True)), items

    return scan


def merge(runs) -> list[tuple[int, int]]:
    """Half-open runs, joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans in the original text of runs of normalised words."""
    if not runs:
        return []
    word = np.frombuffer(raw.translate(NORMAL), np.uint8) != 0x20
    edges = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    at = char_offsets(raw, np.array([(starts[a], ends[b - 1]) for a, b in runs]).ravel())
    return list(zip(at[::2], at[1::2], strict=True))


def groups_of(patterns: DataFrame, limit: int) -> list[DataFrame]:
    """The patterns in parts whose bytes stay below a limit; one part where all of them do."""
    total = patterns.agg(F.sum(F.length("pattern") + 1)).first()[0] or 0
    parts = -(-total // limit) or 1
    return [patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part) for part in range(parts)] if parts > 1 else [patterns]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """The documents with the normalised words, the hit word runs and the items that occur in each.

    One automaton holds all windows of the benchmark; its input is measured first. Beyond `pattern_bytes` the windows
    are dealt to several automata, and the documents pass one after the other, written in between, so that no worker
    holds more than one. Adds columns `n_words` long, `hits` array of (start, end) in words, `item_ids` array,
    replacing columns of these names.

    A null text has no words. An empty benchmark finds nothing. Repeated rows each get their result. No row moves.
    """
    spark = prepare(docs.sparkSession)
    patterns = checkpointed(patterns_of(benchmark, window=window))
    docs = docs.drop(*EXTRA)
    names, schema = docs.columns, StructType([*docs.schema.fields, *FOUND])
    parts = groups_of(patterns, pattern_bytes)
    for number, part in enumerate(parts):
        held = spark.sparkContext.broadcast([(bytes(r["pattern"]), list(r["items"])) for r in part.collect()])

        def run(batches: Iterator[pa.RecordBatch], held=held, first=number == 0) -> Iterator[pa.RecordBatch]:
            scan = None
            for batch in batches:
                scan = scan or scanner(held.value)
                found = [scan(raw or b"") for raw in utf8(batch.column(names.index("text")))]
                if not first:
                    earlier = zip(batch.column("hits").to_pylist(), batch.column("item_ids").to_pylist(), strict=True)
                    found = [
                        (n, merge([*runs, *((x["start"], x["end"]) for x in old)]), items | set(had))
                        for (n, runs, items), (old, had) in zip(found, earlier, strict=True)
                    ]
                columns = [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in runs] for _, runs, _ in found], SPANS),
                    pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], names=[*names, *EXTRA])

        docs = docs.mapInArrow(run, schema)
        if number + 1 < len(parts):
            docs = checkpointed(docs)
    return docs


def is_contaminated() -> Column:
    """At least one hit word, and at least one in twenty words hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, run: total + run["end"] - run["start"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the contaminated ones, with the columns they had; a null or empty text stays."""
    names = docs.columns
    own = {c: f"{c}__own" if c.lower() in EXTRA else c for c in names}
    kept = find(docs.select(*(F.col(f"`{c}`").alias(own[c]) for c in names)), benchmark, window).where(~is_contaminated())
    return kept.select(*(F.col(f"`{own[c]}`").alias(c) for c in names))


def hit_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the hit passages as code-point spans of the original text: doc_id, item_ids, spans."""
    found = find(docs.select("doc_id", "text"), benchmark, window)
    schema = StructType([*(f for f in found.schema.fields if f.name in ("doc_id", "item_ids")), StructField("spans", ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [[(x["start"], x["end"]) for x in runs] for runs in batch.column("hits").to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in original_spans(raw or b"", runs)] for raw, runs in zip(utf8(batch.column("text")), hits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_ids"), pa.array(spans, SPANS)], names=["doc_id", "item_ids", "spans"])

    return found.mapInArrow(run, schema)

