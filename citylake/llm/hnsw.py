"""Nearest neighbours by inner product: one hierarchical navigable small-world graph per shard, results merged."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from citylake.llm.common import checkpointed, prepare, written

SHARD_ROWS = 16384
LINKS = 16  # of a node on the upper levels; twice as many on the lowest
BUILD_BEAM = 64
SEARCH_BEAM = 128
STEP = 4  # nodes of a beam that are opened at once
BATCH = 512

GRAPH = "dim int, shard int, vectors binary, ids binary, starts binary, levels array<binary>"


@dataclass
class Graph:
    """Vectors of one length each, and per level, from the lowest, an array of neighbours (-1: none).

    Nodes stand in the order of their highest level, so a level holds the first rows of the one below.
    """

    vectors: np.ndarray
    levels: list[np.ndarray]

    def search(self, queries: np.ndarray, beam: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and products of the best found on a level for each query, best first; -1 where there are fewer."""
        start = np.zeros((len(queries), 1), np.int64)
        for upper in range(len(self.levels) - 1, level, -1):
            start = self.beam(queries, start, 4, upper)[0][:, :1]
        # While a level is being built it may not hold the start yet.
        start = np.where(start < len(self.levels[level]), start, 0)
        return self.beam(queries, start, beam, level)

    def beam(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries in step, each with its own set of visited nodes."""
        links, rows = self.levels[level], np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(links) + 1), bool)  # the last column stands for "none"
        seen[:, -1] = True
        nodes = np.full((len(queries), beam), -1)
        score = np.full((len(queries), beam), -np.inf, np.float32)
        nodes[:, :1] = start
        score[:, :1] = self.products(queries, start)
        seen[rows, start] = True
        opened = nodes < 0
        live = np.arange(len(queries))
        while len(live):
            waiting = np.where(opened[live], -np.inf, score[live])
            pick = np.argpartition(-waiting, min(STEP, beam) - 1, axis=1)[:, :STEP]
            fresh = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            going = fresh.any(axis=1)
            live, pick, fresh = live[going], pick[going], fresh[going]
            if not len(live):
                break
            at = live[:, None]
            around = np.where(fresh[:, :, None], links[nodes[at, pick]], -1).reshape(len(live), -1)
            opened[at, pick] = True
            # A node that two opened nodes share counts once.
            around = np.sort(around, axis=1)
            around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
            around[seen[at, around]] = -1
            seen[at, around] = True
            reached = np.where(around >= 0, self.products(queries[live], around), -np.inf)
            all_nodes = np.concatenate([nodes[live], around], axis=1)
            all_score = np.concatenate([score[live], reached], axis=1)
            all_opened = np.concatenate([opened[live], around < 0], axis=1)
            best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            nodes[live], score[live], opened[live] = (np.take_along_axis(x, best, axis=1) for x in (all_nodes, all_score, all_opened))
        order = np.argsort(-score, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(score, order, axis=1)

    def products(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.einsum("qd,qnd->qn", queries, self.vectors[np.maximum(nodes, 0)], optimize=False)


def diverse(vectors: np.ndarray, centres: np.ndarray, nodes: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Of candidates sorted by nearness those that are nearer to the centre than to any chosen one; then the nearest rest."""
    around = vectors[np.maximum(nodes, 0)]
    between = np.matmul(around, around.transpose(0, 2, 1))
    chosen = np.zeros(nodes.shape, bool)
    for c in range(nodes.shape[1]):
        covered = (np.where(chosen, between[:, c, :], -np.inf) > score[:, c, None]).any(axis=1)
        chosen[:, c] = (nodes[:, c] >= 0) & ~covered & (chosen.sum(axis=1) < most)
    order = np.argsort(np.where(chosen, 0, np.where(nodes >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
    picked = np.take_along_axis(nodes, order, axis=1)
    return np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)


def linked(graph: Graph, level: int, size: int, most: int) -> None:
    """Inserts the first `size` nodes into a level, batch by batch: neighbours from a search of the level so far and from
    the batch itself, links both ways, lists that are too long cut to diverse neighbours again."""
    vectors = graph.vectors
    links = np.full((size, most), -1, np.int64)
    graph.levels[level] = links
    done = 0
    while done < size:
        batch = np.arange(done, min(size, done + max(64, min(BATCH, done))))
        queries = vectors[batch]
        own = queries @ queries.T
        np.fill_diagonal(own, -np.inf)
        near = np.argsort(-own, axis=1, kind="stable")[:, : BUILD_BEAM // 2]
        nodes, score = batch[near], np.take_along_axis(own, near, axis=1)
        nodes = np.where(np.isfinite(score), nodes, -1)
        if done:
            graph.levels[level] = links[:done]
            found, reached = graph.search(queries, BUILD_BEAM, level)
            graph.levels[level] = links
            nodes, score = np.concatenate([nodes, found], axis=1), np.concatenate([score, reached], axis=1)
            order = np.argsort(-score, axis=1, kind="stable")[:, :BUILD_BEAM]
            nodes, score = np.take_along_axis(nodes, order, axis=1), np.take_along_axis(score, order, axis=1)
        links[batch] = diverse(vectors, queries, nodes, score, most)
        targets, sources = links[batch].ravel(), np.repeat(batch, most)
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.lexsort((-np.einsum("nd,nd->n", vectors[sources], vectors[targets]), targets))
        sources, targets = sources[order], targets[order]
        touched, first, count = np.unique(targets, return_index=True, return_counts=True)
        # The nearest newcomers of each node, at most as many as it can have links.
        width = min(most, int(count.max())) if len(count) else 0
        column = np.arange(width)
        if width:
            newcomers = np.where(column < count[:, None], sources[np.minimum(first[:, None] + column, len(sources) - 1)], -1)
            for at in range(0, len(touched), 2 * BATCH):
                some = touched[at : at + 2 * BATCH]
                pool = np.sort(np.concatenate([links[some], newcomers[at : at + 2 * BATCH]], axis=1), axis=1)[:, ::-1]
                pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
                near = np.where(pool >= 0, graph.products(vectors[some], pool), -np.inf)
                order = np.argsort(-near, axis=1, kind="stable")
                pool, near = np.take_along_axis(pool, order, axis=1), np.take_along_axis(near, order, axis=1)
                links[some] = diverse(vectors, vectors[some], pool, near, most)
        done = int(batch[-1]) + 1


def connected(links: np.ndarray) -> np.ndarray:
    """The links with further columns, so that every node can be reached from the first: a node that no search would
    find becomes a guest of a neighbour that can be reached."""
    seen, guests = np.zeros(len(links), bool), {}
    front = np.array([0])
    while True:
        while len(front):
            seen[front] = True
            front = np.unique(links[front])
            front = front[(front >= 0) & ~seen[front]]
        lost = np.flatnonzero(~seen)
        if not len(lost):
            break
        fit = (links[lost] >= 0) & seen[links[lost]]
        held = fit.any(axis=1)
        front, hosts = (lost[held], links[lost[held], fit[held].argmax(axis=1)]) if held.any() else (lost[:1], np.array([0]))
        for host, guest in zip(hosts.tolist(), front.tolist(), strict=True):
            guests.setdefault(host, []).append(guest)
    more = np.full((len(links), max(map(len, guests.values()), default=0)), -1)
    for host, own in guests.items():
        more[host, : len(own)] = own
    return np.concatenate([links, more], axis=1)


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that gives all the same length, so that the nearest is the largest product."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("nd,nd->n", scaled, scaled)))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


def built(vectors: np.ndarray, longest: float, seed: int) -> tuple[Graph, np.ndarray]:
    """The graph of distinct vectors and the order in which they became nodes."""
    rng = np.random.default_rng(seed)
    height = np.floor(-np.log(rng.random(len(vectors))) / np.log(LINKS)).astype(int)
    order = np.argsort(-height, kind="stable")
    sizes = [int((height >= level).sum()) for level in range(height.max() + 1)]
    graph = Graph(lifted(vectors[order], longest), [np.zeros((0, 0), np.int64)] * len(sizes))
    for level in reversed(range(len(sizes))):
        linked(graph, level, sizes[level], LINKS if level else 2 * LINKS)
    graph.levels[0] = connected(graph.levels[0])
    return graph, order


def valid(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows that take part: id, vector in double precision, its dimension."""
    value = F.col(vector).cast("array<double>")
    rows = table.select(F.col(key).cast("long").alias("id"), value.alias("v")).where("id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).withColumn("dim", F.size("v"))


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """One graph per dimension and shard, as flat arrays in a written table, and the number of shards per dimension.

    A shard holds about `shard_rows` rows, dealt by a hash of the id. Equal vectors of a shard are one node.
    """
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("longest")).collect()
    shards = {r["dim"]: -(-r["n"] // shard_rows) for r in sizes}
    longest = {r["dim"]: float(r["longest"]) for r in sizes}

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        vectors, of = np.unique(np.stack(part["v"].to_numpy()), axis=0, return_inverse=True)
        graph, order = built(vectors, longest[int(key[0])], int(key[1]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        node, ids = place[of.ravel()], part["id"].to_numpy()
        by = np.lexsort((ids, node))
        starts = np.searchsorted(node[by], np.arange(len(order) + 1))
        row = {"dim": key[0], "shard": key[1], "vectors": vectors[order].tobytes(), "ids": ids[by].tobytes(), "starts": starts.astype(np.int64).tobytes()}
        return pd.DataFrame([{**row, "levels": [x.astype(np.int32).tobytes() for x in graph.levels]}])

    if not shards:
        return rows.sparkSession.createDataFrame([], GRAPH), shards
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), _by_dim(shards)).cast("int"))
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, GRAPH), "hnsw"), shards


def _by_dim(values: dict[int, int]):
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col("dim")]


def read(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph, vectors, ids and where the ids of each node begin, from a row of the index."""
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, int(row["dim"]))
    shapes = [(len(vectors), -1)] + [(-1, LINKS)] * (len(row["levels"]) - 1)
    links = [np.frombuffer(x, np.int32).reshape(shape).astype(np.int64) for x, shape in zip(row["levels"], shapes, strict=True)]
    length = np.sqrt(np.einsum("nd,nd->n", vectors, vectors).max())
    return Graph(lifted(vectors, float(length)), links), vectors, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)


def found_in(held: tuple[Graph, np.ndarray, np.ndarray, np.ndarray], asking: np.ndarray, wanted: np.ndarray, k: int, beam: int) -> pa.RecordBatch:
    """The k nearest rows of one shard for each of the queries (id, vector)."""
    graph, vectors, ids, starts = held
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(asking), BATCH):
        some = wanted[at : at + BATCH]
        level = np.concatenate([some, np.zeros((len(some), 1))], axis=1).astype(np.float32)
        nodes, _ = graph.search(level, min(max(beam, k + 1), max(1, len(vectors))))
        for query, own, row in zip(some, asking[at : at + BATCH], nodes, strict=True):
            row = row[row >= 0]
            score = (vectors[row] * query).sum(axis=1)
            members = [ids[starts[n] : min(starts[n + 1], starts[n] + k + 1)] for n in row]
            counts = [len(m) for m in members]
            found, score = np.concatenate(members), np.repeat(score, counts)
            score, found = score[found != own], found[found != own]
            best = np.lexsort((found, -score))[:k]
            out.append((np.full(len(best), own), found[best], score[best]))
    return pa.record_batch([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], ["query_id", "vec_id", "score"])


def nearest(queries: DataFrame, graphs: DataFrame, shards: dict[int, int], k: int = 20, beam: int = SEARCH_BEAM) -> DataFrame:
    """For each query (id, v, dim) the k nearest rows of the index but those of its own id: query_id, rank, vec_id, score.

    Every query meets every shard of its dimension. A task takes up the graph of a shard once and lets the queries
    stream past it in batches, so that the index moves once however many queries there are. The score is the inner
    product in double precision; equal scores stand by id.
    """
    if not shards:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = queries.select("id", "v", "dim", F.explode(F.sequence(F.lit(0), _by_dim(shards) - 1)).alias("shard"), F.lit(1).alias("kind"))
    together = graphs.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                dim, shard, kind = keys[:, lo].tolist()
                part = batch.slice(lo, hi - lo)
                if kind == 0:
                    held, place = read(part.to_pylist()[0]), (dim, shard)
                elif place == (dim, shard):
                    wanted = part.column("v").flatten().to_numpy().reshape(-1, dim)
                    yield found_in(held, part.column("id").to_numpy(), wanted, k, beam)

    dealt = together.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    # A shard gives at most k rows to a query.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(table: DataFrame, every: int, k: int = 20, vector: str = "embedding", key: str = "vec_id", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by `every`, among all rows of the table.

    Rows without an id and vectors that are null, empty, zero or hold null or non-finite components take no part; only
    vectors of one dimension meet. A row repeated as it is counts once. An empty table gives no rows.
    """
    prepare(table.sparkSession)
    rows = checkpointed(valid(table, vector, key).distinct())
    graphs, shards = index(rows, shard_rows)
    return nearest(rows.where(F.col("id") % every == 0), graphs, shards, k)
