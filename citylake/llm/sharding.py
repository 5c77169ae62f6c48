"""Shards of nearly equal bytes by a k-d tree over metadata, split at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from citylake.llm.common import checkpointed, plain_names, prepare, running, small, written
from citylake.operators.ordered import SLICE, cut_long_groups, running_sum

BINS = 32768  # of all histograms of a round together
COORDINATE_BITS = 30
# A cut may miss its weight by this share of one shard.
TOLERANCE = 0.002


@dataclass(frozen=True)
class Cut:
    """A node of the tree: rows whose key in a dimension is below `key` go left."""

    node: int
    dimension: int
    key: int
    left: int
    right: int


@dataclass(frozen=True)
class Tree:
    """Cuts by level; a node is the number of its first shard, so that leaves are shards. Ranges scale the dimensions, and
    `ranks` (dimension, value, rank) are the places of the values of text dimensions."""

    levels: list[list[Cut]]
    ranges: list[tuple[float, float]]
    shards: int
    ranks: DataFrame


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of a text plus eight; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def number_of(column: str) -> Column:
    """A metadata value that is no text as a number; nulls and NaN are null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def texts_among(docs: DataFrame, dimensions: list[str]) -> list[int]:
    kinds = dict(docs.dtypes)
    return [i for i, d in enumerate(dimensions) if kinds[d] == "string"]


def text_ranks(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    """The distinct values of the text dimensions with their rank by code point, from 1: dimension, value, rank.

    Values are made distinct before they move and numbered in slices, so there may be as many as there are rows.
    """
    found = F.array(*(F.struct(F.lit(i).alias("dimension"), F.col(f"`{dimensions[i]}`").alias("value")) for i in texts_among(docs, dimensions)))
    if not texts_among(docs, dimensions):
        return small(docs.sparkSession, "dimension int, value string, rank long", [])
    values = docs.select(F.explode(found).alias("v")).select("v.*").where("value is not null").distinct()
    numbered = running_sum(cut_long_groups(values, "dimension", "value"), "dimension", "value", F.lit(1), "rank", SLICE)
    return written(numbered.select("dimension", "value", "rank"), "ranks")


def with_coordinates(docs: DataFrame, dimensions: list[str], ranks: DataFrame) -> DataFrame:
    """The rows with `_at<i>`, their number in each dimension. Spark broadcasts the ranks of a dimension while they are small."""
    texts = texts_among(docs, dimensions)
    for i, d in enumerate(dimensions):
        if i in texts:
            places = ranks.where(F.col("dimension") == i).select(F.col("value").alias(f"_value{i}"), F.col("rank").cast("double").alias(f"_at{i}"))
            docs = docs.join(places, F.col(f"`{d}`") == F.col(f"_value{i}"), "left").drop(f"_value{i}")
        else:
            docs = docs.withColumn(f"_at{i}", number_of(d))
    return docs


def key_of(value: Column, low: float, high: float, tie: Column) -> Column:
    """Order of the rows in a dimension: the scaled value, then the tie; null stands first."""
    scale = ((1 << COORDINATE_BITS) - 2) / (high - low) if high > low else 0.0
    place = F.coalesce(F.floor((value - low) * scale) + 1, F.lit(0)).cast("bigint")
    return F.shiftleft(place, 32) + tie


def tie_of(text: str, key: str) -> Column:
    """Rows of equal metadata stand by text, copies of a text by a hash of their key."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 20)) * 4096 + F.pmod(F.xxhash64(key), F.lit(4096))


def with_keys(docs: DataFrame, dimensions: list[str], ranges: list[tuple[float, float]], ranks: DataFrame, text: str, key: str) -> DataFrame:
    tie = tie_of(text, key)
    keys = [key_of(F.col(f"_at{i}"), low, high, tie) for i, (low, high) in enumerate(ranges)]
    keyed = with_coordinates(docs, dimensions, ranks).withColumn("_keys", F.array(*keys)).withColumn("_node", F.lit(0))
    return keyed.drop(*(f"_at{i}" for i in range(len(dimensions))))


def descend(rows: DataFrame, cuts: list[Cut]) -> DataFrame:
    """One level down; the cuts of a level are at most as many as the shards."""
    if not cuts:
        return rows
    table = small(rows.sparkSession, "_node int, _dim int, _key long, _left int, _right int", [(c.node, c.dimension + 1, c.key, c.left, c.right) for c in cuts])
    moved = rows.join(F.broadcast(table), "_node", "left")
    side = F.when(F.element_at("_keys", F.col("_dim")) < F.col("_key"), F.col("_left")).otherwise(F.col("_right"))
    return moved.withColumn("_node", F.coalesce(side, F.col("_node"))).drop("_dim", "_key", "_left", "_right")


def weighted_cuts(rows: DataFrame, wanted: dict[int, tuple[int, float, int, int]], slack: float) -> dict[int, int]:
    """For nodes -> (dimension, weight to the left, lowest key, highest key) the key that parts the weights so.

    A round of histograms reads the slim table once and gives the driver at most BINS rows; the span of the bin that holds
    the cut becomes the next histogram, until one key is left or its weight does not matter.
    """
    spark, found = rows.sparkSession, {}
    state = {n: (d, low, high, 0.0) for n, (d, _, low, high) in wanted.items()}
    while state:
        count = max(64, BINS // len(state))
        spans = small(spark, "_node int, _dim int, _low long, _width long, _high long", [(n, d + 1, low, -(-(high - low + 1) // count), high) for n, (d, low, high, _) in state.items()])
        key = F.element_at("_keys", F.col("_dim"))
        inside = rows.join(F.broadcast(spans), "_node").withColumn("_key", key).where("_key between _low and _high")
        binned = inside.groupBy("_node", F.expr("(_key - _low) div _width").alias("bin")).agg(F.sum("_size").alias("w"), F.min("_key").alias("low"), F.max("_key").alias("high"))
        by_node: dict[int, list] = {}
        for r in binned.collect():
            by_node.setdefault(r["_node"], []).append((r["bin"], r["w"], r["low"], r["high"]))
        following = {}
        for n, (d, _, _, below) in state.items():
            bins, goal = sorted(by_node[n]), wanted[n][1]
            for at, (_, w, low, high) in enumerate(bins):
                if below + w >= goal or at == len(bins) - 1:
                    if low == high or w <= slack:
                        found[n] = low if goal - below < below + w - goal else high + 1
                    else:
                        following[n] = (d, low, high, below)
                    break
                below += w
        state = following
    return found


def plan(docs: DataFrame, dimensions: list[str], shards: int | None = None, target_bytes: int | None = None, text: str = "text", key: str = "doc_id") -> Tree:
    """The k-d tree for a number of shards, or for as many as leave at most `target_bytes` in each.

    A node of n shards is cut in its widest dimension (ranges scaled to the whole table, ties to the first) where the
    left side gets n // 2 shares of n. An empty table has one cut-free tree. Only slim rows are read again.
    """
    prepare(docs.sparkSession)
    texts = texts_among(docs, dimensions)
    ranks = text_ranks(docs, dimensions)
    last = {r["dimension"]: r["rank"] for r in ranks.groupBy("dimension").agg(F.max("rank").alias("rank")).collect()}
    ends = ((i, d, n, f) for i, d in enumerate(dimensions) if i not in texts for n, f in (("low", F.min), ("high", F.max)))
    spans = docs.agg(F.sum(size_of(text)).alias("bytes"), *(f(number_of(d)).alias(f"{n}{i}") for i, d, n, f in ends)).first()
    ranges = [(1.0, float(last.get(i, 1))) if i in texts else (spans[f"low{i}"] or 0.0, spans[f"high{i}"] or 0.0) for i in range(len(dimensions))]
    total = spans["bytes"] or 0
    shards = shards or max(1, -(-total // target_bytes))
    rows = checkpointed(with_keys(docs, dimensions, ranges, ranks, text, key).select("_node", "_keys", size_of(text).alias("_size")))
    levels: list[list[Cut]] = []
    nodes = {0: shards} if total else {}
    while nodes := {n: k for n, k in nodes.items() if k > 1}:
        ends = [f(F.element_at("_keys", F.lit(i + 1))).alias(f"{n}{i}") for i in range(len(dimensions)) for n, f in (("low", F.min), ("high", F.max))]
        wanted = {}
        for r in rows.groupBy("_node").agg(F.sum("_size").alias("w"), *ends).collect():
            if k := nodes.get(r["_node"]):
                widest = max(range(len(dimensions)), key=lambda i: ((r[f"high{i}"] >> 32) - (r[f"low{i}"] >> 32), -i))
                wanted[r["_node"]] = (widest, r["w"] * (k // 2) / k, r[f"low{widest}"], r[f"high{widest}"])
        keys = weighted_cuts(rows, wanted, TOLERANCE * total / shards)
        cuts = [Cut(n, wanted[n][0], keys[n], n, n + nodes[n] // 2) for n in sorted(wanted)]
        rows = descend(rows, cuts)
        levels.append(cuts)
        nodes = {m: size for c in cuts for m, size in ((c.left, nodes[c.node] // 2), (c.right, nodes[c.node] - nodes[c.node] // 2))}
    return Tree(levels, ranges, shards, ranks)


def assign(docs: DataFrame, tree: Tree, dimensions: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows with the shard of the tree's leaf, in a column `_node`; nothing is shuffled while the ranks are small."""
    rows = with_keys(docs, dimensions, tree.ranges, tree.ranks, text, key)
    for cuts in tree.levels:
        rows = descend(rows, cuts)
    return rows.drop("_keys")


def shard(docs: DataFrame, dimensions: list[str], shards: int | None = None, target_bytes: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows with `shard` int and `slot` long, replacing columns of these names.

    Shards hold nearly equal bytes (UTF-8 text plus eight); slots are gapless from 0. Text metadata counts by the rank of
    its value among the distinct ones, everything else by its number. Null metadata stands before all
    other values, null texts weigh eight bytes, repeated rows are rows of their own. Rows of equal metadata are parted
    by text, so copies with equal metadata stay together unless a cut falls among them. All other columns keep their
    names and values, whatever they are called. An empty table stays empty.
    """
    docs = docs.drop("shard", "slot")
    plain, names = plain_names(docs)
    own, text, key = [names[d] for d in dimensions], names[text], names[key]
    tree = plan(plain, own, shards, target_bytes, text, key)
    rows = running(assign(plain, tree, own, text, key), "_node", [key, text])
    return rows.select(*names.values(), "_node", "_before").toDF(*docs.columns, "shard", "slot")
