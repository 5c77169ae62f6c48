"""Embedding near-dedup: tiles of vectors in PCA order, compared by leading dimensions first, with an exact bound on the rest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from citylake.llm.common import prepare, small, written
from citylake.llm.components import components

LEAST = 0.95
SLACK = 1e-9  # far above what rounding can add to a product of unit vectors
LEAD = 8  # dimensions of a box around a block
FIRST = 16  # dimensions of the first products; each further step doubles them
TILE = 512
# Rows are dealt to this many blocks, to more where a block would pass its bytes, to fewer where it would be tiny.
PARTS, LEAST_BLOCK, BLOCK_BYTES = 8, 512, 32 << 20
PAIRS = 1 << 16

FINITE = "coalesce(forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(e, x -> x <> 0), false)"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones followed by zeros, each scaled by a power of two to components below 1."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    if len(rows):
        rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Axes of the unit vectors in columns, those of the largest second moment first; moments are summed over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = unit(matrix(batch.column(0), width))
            total += rows.T @ rows
        i, j = np.triu_indices(width)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    moments = np.zeros((width, width))
    for i, j, v in vectors.select("e").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        moments[i, j] = moments[j, i] = v
    return np.ascontiguousarray(np.linalg.eigh(moments)[1][:, ::-1])


def steps(width: int) -> list[int]:
    """Numbers of dimensions after which the bound is looked at."""
    found = [min(FIRST, width)]
    while found[-1] < width:
        found.append(min(2 * found[-1], width))
    return found


class Side:
    """One block of vectors: as given, rotated, norms of what is left after each step, in order of the first axis."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, rows: np.ndarray, axes: np.ndarray) -> None:
        turned = unit(rows) @ axes
        order = np.argsort(turned[:, 0], kind="stable")
        self.nodes, self.copies, self.rows, self.turned = nodes[order], copies[order], rows[order], turned[order]
        squares = self.turned**2
        self.rest = {k: np.sqrt(squares[:, k:].sum(axis=1)) for k in steps(turned.shape[1])}
        starts = range(0, len(nodes), TILE)
        self.tiles = [slice(at, min(at + TILE, len(nodes))) for at in starts]
        lead = self.turned[:, :LEAD]
        self.low = np.array([lead[t].min(axis=0) for t in self.tiles])
        self.high = np.array([lead[t].max(axis=0) for t in self.tiles])

    def cosines(self, i: np.ndarray, other: Side, j: np.ndarray) -> np.ndarray:
        x, y = self.rows[i], other.rows[j]
        return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def linked(a: Side, s: slice, b: Side, t: slice, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of a, row of b) of two tiles whose cosine reaches `least`.

    Products of the leading dimensions are summed up step by step; what the rest can add is bounded by the product of
    the norms of the rest. A tile is left as soon as no pair can reach the threshold, and few pairs go on by themselves.
    """
    width, done = a.turned.shape[1], 0
    total = np.zeros((s.stop - s.start, t.stop - t.start))
    for k in steps(width):
        total += a.turned[s, done:k] @ b.turned[t, done:k].T
        done = k
        i, j = np.nonzero(total + a.rest[k][s, None] * b.rest[k][None, t] >= least - SLACK)
        if a is b and s == t:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        if len(i) < total.size // 16:
            break
    for at in range(0, len(i), PAIRS):
        x, y = i[at : at + PAIRS], j[at : at + PAIRS]
        found, x, y = total[x, y], x + s.start, y + t.start
        upto = done
        for k in steps(width):
            if k > upto:
                found = found + np.einsum("ij,ij->i", a.turned[x, upto:k], b.turned[y, upto:k])
                fits = found + a.rest[k][x] * b.rest[k][y] >= least - SLACK
                found, x, y, upto = found[fits], x[fits], y[fits], k
        sure = found >= least + SLACK
        close = np.flatnonzero(~sure)
        sure[close] = a.cosines(x[close], b, y[close]) >= least
        yield x[sure], y[sure]


def hooked(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining the trees of every pair; a root is the smallest place of its tree."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def compared(a: Side, b: Side, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the nodes of two blocks that are linked across them: node, number of vectors it is linked with, root."""
    same = a is b
    nodes = a.nodes if same else np.concatenate((a.nodes, b.nodes))
    shift = 0 if same else len(a.nodes)
    count, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for n, s in enumerate(a.tiles):
        gap = np.maximum(0, np.maximum(a.low[n] - b.high, b.low - a.high[n]))
        near = (gap**2).sum(axis=1) <= 2 - 2 * least + SLACK
        for m in np.flatnonzero(near).tolist():
            if same and m < n:
                continue
            for i, j in linked(a, s, b, b.tiles[m], least):
                count += np.bincount(i, b.copies[j], len(nodes)).astype(np.int64)
                count += np.bincount(j + shift, a.copies[i], len(nodes)).astype(np.int64)
                held.append((i, j + shift))
                waiting += len(i)
                if waiting > 1 << 20:
                    root = hooked(root, *map(np.concatenate, zip(*held, strict=True)))
                    held, waiting = [], 0
    if held:
        root = hooked(root, *map(np.concatenate, zip(*held, strict=True)))
    some = np.flatnonzero(count)
    return nodes[some], count[some], nodes[root[some]]


def blocks_of(placed: DataFrame, rows: int, width: int) -> DataFrame:
    """The rows with their block: slices by the first axis, cut by the second; a block that is still too large is dealt
    by a hash, so that vectors of one direction do not fill one task."""
    many = max(1, min(PARTS, rows // LEAST_BLOCK), math.ceil(rows * width * 8 / BLOCK_BYTES))
    slices = max(1, round(math.sqrt(many)))
    cuts = math.ceil(many / slices)
    most = max(LEAST_BLOCK, 2 * math.ceil(rows / many))

    def bounds(parts: int):
        return F.array(*(F.lit(k / parts) for k in range(1, parts))) if parts > 1 else None

    def place(value: str, limits):
        return F.size(F.filter(limits, lambda limit: limit < F.col(value)))

    x, y = F.get("lead", F.lit(0)), F.coalesce(F.get("lead", F.lit(1)), F.lit(0.0))
    placed = placed.withColumns({"x": x, "y": y, "slice": F.lit(0), "cut": F.lit(0)})
    if slices > 1:
        limits = placed.agg(F.percentile_approx("x", bounds(slices), 10_000).alias("limits")).first()["limits"]
        placed = placed.withColumn("slice", place("x", F.array(*map(F.lit, limits))))
    if cuts > 1:
        limits = placed.groupBy("slice").agg(F.percentile_approx("y", bounds(cuts), 10_000).alias("limits"))
        placed = placed.join(limits, "slice").withColumn("cut", place("y", F.col("limits")))
    sizes = placed.groupBy("slice", "cut").agg(F.expr(f"1 + (count(*) - 1) div {most}").alias("deals"))
    dealt = placed.join(sizes, ["slice", "cut"]).withColumn("deal", F.expr("pmod(xxhash64(node), deals)"))
    number = F.expr("(cast(slice as bigint) << 42) + (cast(cut as bigint) << 21) + deal")
    return dealt.select("node", "copies", "e", "lead", number.alias("block"))


def block_pairs(blocks: DataFrame, axes: int, least: float) -> DataFrame:
    """Which blocks have to meet: block, and the pair (low, high) it belongs to.

    Boxes around the blocks meet through cells of the first axis; a pair is taken in the first cell both reach, and only
    if the boxes are no further apart than two unit vectors of this cosine.
    """
    reach = math.sqrt(2 - 2 * least + SLACK)
    edges = [f(F.get("lead", F.lit(k))).alias(f"{name}{k}") for k in range(axes) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = blocks.groupBy("block").agg(*edges).withColumns({"from": F.floor(F.col("lo0") / reach), "to": F.floor(F.col("hi0") / reach) + 1})
    boxes = written(boxes, "vector-boxes")
    cells = boxes.withColumn("cell", F.explode(F.sequence("from", "to")))
    others = cells.select("cell", F.col("block").alias("high"), F.col("from").alias("begin"), *(F.col(f"{s}{k}").alias(f"{s}{k}_") for k in range(axes) for s in ("lo", "hi")))
    met = cells.join(others, "cell").where("block <= high and cell = greatest(from, begin)")
    gaps = [F.greatest(F.col(f"lo{k}") - F.col(f"hi{k}_"), F.col(f"lo{k}_") - F.col(f"hi{k}"), F.lit(0.0)) for k in range(axes)]
    near = met.where(sum((g * g for g in gaps), F.lit(0.0)) <= 2 - 2 * least + SLACK).select(F.col("block").alias("low"), "high")
    return near.select(F.col("low").alias("block"), "low", "high").unionByName(near.where("low < high").select(F.col("high").alias("block"), "low", "high"))


def links(unique: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """For distinct vectors (node, copies, e): (node, n) of vectors linked with others, and edges (a, b) that join them."""
    spark = unique.sparkSession
    rows, width = unique.agg(F.count(F.lit(1)), F.max(F.size("e"))).first()
    if not rows:
        return small(spark, "node long, n long", []), small(spark, "a long, b long", [])
    axes = spark.sparkContext.broadcast(principal_axes(unique, width))
    lead = min(LEAD, width)

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = unit(matrix(batch.column(2), width)) @ axes.value[:, :lead]
            values = pa.FixedSizeListArray.from_arrays(pa.array(turned.ravel()), lead).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=["node", "copies", "e", "lead"])

    element = unique.schema["e"].dataType.simpleString()
    placed = unique.select("node", "copies", "e").mapInArrow(leading, f"node long, copies long, e {element}, lead array<double>")
    blocks = written(blocks_of(written(placed, "vector-axes"), rows, width), "vector-blocks")
    dealt = blocks.drop("lead").join(block_pairs(blocks, lead, least), "block")

    def meet(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        block = table.column("block").to_numpy()
        sides = []
        for own in [low] if low == high else [low, high]:
            part = table.filter(pa.array(block == own)).combine_chunks()
            vectors = part.column("e").combine_chunks()
            sides.append(Side(part.column("node").to_numpy(), part.column("copies").to_numpy(), matrix(vectors, width), axes.value))
        nodes, count, root = compared(sides[0], sides[-1], least)
        return pa.table({"node": nodes, "n": count, "root": root})

    found = written(dealt.groupBy("low", "high").applyInArrow(meet, "node long, n long, root long"), "vector-links")
    return found.groupBy("node").agg(F.sum("n").alias("n")), found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(vectors: DataFrame, least: float = LEAST, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per row of the table: vec_id, n_links, component_id and kept.

    Two rows are linked if the cosine of their vectors, in double precision, is `least` or more; `n_links` counts the rows
    a row is linked with, `component_id` is the smallest id that links reach, `kept` tells whether that is its own. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing; of two vectors of different
    lengths the shorter is followed by zeros. Rows with the same vector are linked and stand as one with a count; repeated
    ids are rows of their own; rows without an id count as others, their `kept` is false and their component is null
    where no id is in reach. Other columns are not read; an empty table gives no rows.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies above 0 and up to 1")
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("e"))
    counted = rows.where(FINITE).groupBy("e").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    unique = written(counted.withColumn("node", F.monotonically_increasing_id()), "vector-unique")
    count, edges = links(unique, least)
    joined = unique.join(components(edges).withColumnsRenamed({"a": "node", "b": "root"}), "node", "left").join(count, "node", "left")
    joined = joined.select("e", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = written(joined, "vector-joined")
    least_id = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    settled = joined.join(least_id, "root").select("e", "n_links", "component_id", F.lit(True).alias("takes_part"))
    out = rows.join(settled, "e", "left")
    component = F.when(F.col("takes_part"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
