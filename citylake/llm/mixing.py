"""Mixing sources to target weights: packed token blocks, multinomial draws per output shard, permuted block indices."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from citylake.llm.common import checkpointed, prepare, running, small

BLOCK = 128  # tokens
OUTPUT_SHARDS = 64
MOST_REPEATS = 3
CHUNK = 1 << 16
SEED = 20


@dataclass
class Source:
    """One source of the mix: its tokens, weight and target, its blocks, and how many blocks the mix draws."""

    name: str | None
    size: int
    weight: int
    target: float = 0.0
    blocks: int = 0
    drawn: int = 0


@dataclass
class Mix:
    """Sources in order, the measured rows, and per output shard and source the first draw and the number of draws."""

    sources: list[Source]
    rows: DataFrame
    draws: list[tuple[int, int, int, int]]
    seed: int
    block: int


def words(text: str = "text") -> Column:
    """Runs of characters that are no ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("bigint")


def set_targets(sources: list[Source], most: int = MOST_REPEATS) -> None:
    """Shares of all tokens by weight; a source stops at `most` times its size and the rest is shared again."""
    left, open_ = float(sum(s.size for s in sources)), list(sources)
    while open_:
        weights = sum(s.weight for s in open_)
        for s in open_:
            s.target = left * s.weight / weights
        full = [s for s in open_ if s.target > most * s.size]
        if not full:
            break
        for s in full:
            s.target = float(most * s.size)
        left -= sum(s.target for s in full)
        open_ = [s for s in open_ if s not in full]


def multinomial_draws(quotas: list[int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """Counts of each source in each output shard: multinomial over what is left of the quotas, so that they end met.

    A source never gives more than its quota: draws beyond it go again to the others. Rows (shard, source, first, count).
    """
    rng = np.random.default_rng(seed)
    left, given, rows = np.array(quotas, np.int64), np.zeros(len(quotas), np.int64), []
    each = -(-int(left.sum()) // shards) if len(quotas) else 0
    for shard in range(shards):
        wanted, counts = min(each, int(left.sum())), np.zeros_like(left)
        while wanted:
            room = left - counts
            counts += np.minimum(rng.multinomial(wanted, room / room.sum()), room)
            wanted = min(each, int(left.sum())) - int(counts.sum())
        rows += [(shard, s, int(given[s]), int(counts[s])) for s in np.flatnonzero(counts).tolist()]
        left, given = left - counts, given + counts
    return rows


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size): a Feistel network of four rounds that walks until it is inside."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            mixed = (right + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def plan(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", block: int = BLOCK, shards: int = OUTPUT_SHARDS, seed: int = SEED) -> Mix:
    """Measures the sources and draws the mix.

    Sources stand by code point, null last, and weigh 1, 2, 3, repeating. The driver holds one row per source and one
    per source and output shard. The words of a source, its documents one after the other, fill blocks of `block` words;
    the last may be shorter. A source draws as many blocks as give its target on average: the part of a block that is
    over is rounded by a hash of the source, so that a target is met to within one block and many small sources meet
    theirs together.
    """
    prepare(docs.sparkSession)
    slim = checkpointed(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size")))
    sizes = {r["source"]: r["size"] for r in slim.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    names = sorted(n for n in sizes if n is not None) + [None] * (None in sizes)
    sources = [Source(n, sizes[n], 1 + i % 3) for i, n in enumerate(names)]
    set_targets(sources)
    for s in sources:
        s.blocks = -(-s.size // block)
        part = xxhash.xxh3_64_intdigest(repr(s.name).encode(), seed=seed) / 2**64
        s.drawn = min(MOST_REPEATS * s.blocks, math.floor(s.target * s.blocks / s.size + part)) if s.size else 0
    numbers = small(docs.sparkSession, "_name string, _s int, source_size long, target double", [(s.name, i, s.size, s.target) for i, s in enumerate(sources)])
    rows = slim.join(numbers, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    rows = running(rows, "_s", ["doc_id", "size"], F.col("size"))
    return Mix(sources, rows, multinomial_draws([s.drawn for s in sources], shards, seed), seed, block)


def slots(mix: Mix) -> DataFrame:
    """Every slot of the mix: output shard, position in it, source number and the block drawn for it.

    Draw j of a source takes block permutation(j mod blocks), so no block comes again before all others have come.
    """
    spark = mix.rows.sparkSession
    firsts: dict[int, int] = {}
    table = []
    for shard, s, first, count in mix.draws:
        table.append((shard, s, first, count, mix.sources[s].blocks, firsts.get(shard, 0)))
        firsts[shard] = firsts.get(shard, 0) + count
    rows = small(spark, "shard int, s int, first long, n long, blocks long, place long", table)
    filled = small(spark, "shard int, total long", sorted(firsts.items()))
    chunks = rows.join(filled, "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {CHUNK}"))))
    seed = mix.seed

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.arange(r["chunk"] * CHUNK, min(r["n"], (r["chunk"] + 1) * CHUNK))
                drawn = permuted((r["first"] + at) % r["blocks"], r["blocks"], seed * 1000003 + r["s"])
                position = permuted(r["place"] + at, r["total"], seed * 1000033 + r["shard"])
                full = lambda value: pa.array(np.full(len(at), value, np.int32))
                yield pa.record_batch([full(r["shard"]), pa.array(position), full(r["s"]), pa.array(drawn)], ["shard", "position", "_s", "_block"])

    spread = chunks.repartition(OUTPUT_SHARDS, "shard", "s", "chunk")
    return spread.mapInArrow(draw, "shard int, position long, _s int, _block long")


def pieces(mix: Mix) -> DataFrame:
    """The parts of the documents that lie in each block: `_from` word, `_words` words."""
    rows, block = mix.rows.where("size > 0"), mix.block
    cut = rows.withColumn("_block", F.explode(F.expr(f"sequence(_before div {block}, (_before + size - 1) div {block})")))
    start = F.greatest(F.col("_before"), F.col("_block") * block)
    end = F.least(F.col("_before") + F.col("size"), (F.col("_block") + 1) * block)
    return cut.withColumns({"_from": start - F.col("_before"), "_words": end - start})


def mixed(mix: Mix) -> DataFrame:
    """The mix itself: output shard and position of each slot with the document parts that fill its block."""
    return slots(mix).join(pieces(mix).hint("merge"), ["_s", "_block"]).select(
        "shard", "position", "source", F.col("_block").alias("block"), "doc_id", F.col("_from").alias("from_word"), F.col("_words").alias("n_words")
    )


def taken(mix: Mix) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target of its source and `taken`, the words the mix takes of it.

    Blocks meet the documents by index: uses of each block joined with the document parts in it. A block is used at
    most three times, so no document gives more than three times its words. Documents without words, null texts among
    them, take no part and come out with 0; repeated rows are documents of their own; an empty table gives no rows.
    """
    uses = slots(mix).groupBy("_s", "_block").agg(F.count(F.lit(1)).alias("_uses"))
    # The planner knows the few rows the slots are made from, not how many they become, and would broadcast them.
    joined = pieces(mix).join(uses.hint("merge"), ["_s", "_block"], "left")
    given = joined.groupBy("_s", "_before", "doc_id", "source", "size", "source_size", "target").agg(
        F.sum(F.col("_words") * F.coalesce(F.col("_uses"), F.lit(0))).alias("taken")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return given.select(*columns).unionByName(mix.rows.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")).select(*columns))
