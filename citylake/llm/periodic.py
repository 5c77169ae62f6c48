"""Periodic runs: suffix trees of a text and its reversal, Lyndon roots extended both ways by common extensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from citylake.llm.common import prepare, utf8

EXPONENT = 4  # a run holds its period this often
SHORTEST = 6  # words of a run

BLOCK = 16
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers from 1, closed by a 0, as flat lists.

    Node 0 is the root; the edge into a node holds the symbols from `start` to `stop`; `child` finds a node by its parent
    and the first symbol of the edge.
    """

    def __init__(self, symbols: list[int]) -> None:
        self.symbols = [*symbols, 0]
        self.sigma = max(self.symbols) + 1
        self.start, self.stop, self.child = [0], [0], {}
        self._build()

    def _build(self) -> None:
        text, sigma, start, stop, child = self.symbols, self.sigma, self.start, self.stop, self.child
        link, total = [0], len(text)
        node = edge = length = waiting = 0
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = at
                key = node * sigma + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(at)
                    stop.append(total)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[below]
                    span = stop[below] - first
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(start)
                    start += (first, at)
                    stop += (first + length, total)
                    link += (0, 0)
                    child[key] = split
                    child[split * sigma + text[first + length]] = below
                    child[split * sigma + symbol] = split + 1
                    start[below] = first + length
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1

    def tour(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Euler tour, children by symbol: the depth of every visit in symbols, the visit of each suffix, the suffixes in order."""
        keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        order = np.argsort(keys)
        kids = np.fromiter(self.child.values(), np.int64, len(self.child))[order].tolist()
        begin = np.searchsorted(keys[order], np.arange(len(self.start) + 1) * self.sigma).tolist()
        span = (np.array(self.stop) - np.array(self.start)).tolist()
        total, upto = len(self.symbols), list(begin)
        visits, first, suffixes = [], [0] * total, []
        path, depths = [0], [0]
        while path:
            node, depth = path[-1], depths[-1]
            visits.append(depth)
            k = upto[node]
            if k == begin[node + 1]:
                path.pop()
                depths.pop()
                continue
            upto[node] = k + 1
            below = kids[k]
            deeper = depth + span[below]
            if begin[below] == begin[below + 1]:
                first[total - deeper] = len(visits)
                suffixes.append(total - deeper)
                visits.append(deeper)
            else:
                path.append(below)
                depths.append(deeper)
        return np.array(visits, np.int32), np.array(first), np.array(suffixes)


class Extensions:
    """Longest common extensions of pairs of suffixes: the least depth between two visits of the tour, in constant time.

    The depth of the lowest common ancestor comes from minima inside blocks of visits and a table of minima over 2^k
    blocks, so the table is no larger than the tour.
    """

    def __init__(self, symbols: list[int]) -> None:
        depths, self.first, self.suffixes = SuffixTree(symbols).tour()
        blocks = np.concatenate((depths, np.full(-len(depths) % BLOCK, 2**31 - 1, np.int32))).reshape(-1, BLOCK)
        self.flat = blocks.ravel()
        self.ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        self.back = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [blocks.min(axis=1)]
        while 2 ** len(self.table) <= len(blocks):
            half, last = 2 ** (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at i and at j (another place) share from their starts."""
        a, b = self.first[i], self.first[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        x, y = lo // BLOCK, hi // BLOCK
        found = np.minimum(self.back[lo], self.ahead[hi])
        same = x == y
        if same.any():
            start, least = lo[same], self.flat[lo[same]]
            for step in range(1, BLOCK):
                least = np.minimum(least, self.flat[np.minimum(start + step, hi[same])])
            found[same] = least
        between = y - x - 1
        for level in range(len(self.table)):
            some = (between >> level) == 1
            if some.any():
                row = self.table[level]
                found[some] = np.minimum(found[some], np.minimum(row[x[some] + 1], row[y[some] - 2**level]))
        return found.astype(np.int64)


def next_beyond(ranks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every place the next one of smaller and the next one of larger rank; -1 if there is none."""
    smaller, larger = [-1] * len(ranks), [-1] * len(ranks)
    falling: list[int] = []
    rising: list[int] = []
    for at, rank in enumerate(ranks):
        while falling and ranks[falling[-1]] > rank:
            smaller[falling.pop()] = at
        while rising and ranks[rising[-1]] < rank:
            larger[rising.pop()] = at
        falling.append(at)
        rising.append(at)
    return np.array(smaller), np.array(larger)


def runs_in(symbols: list[int], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers from 1, by start and period.

    The longest Lyndon word at a place ends before the next smaller suffix, and in the reversed order of symbols before
    the next larger one. Every run has one of these words as its root; extending a root to both sides gives the run.
    """
    n = len(symbols)
    right = Extensions(symbols)
    left = Extensions(symbols[::-1])
    ranks = np.empty(n + 1, np.int64)
    ranks[right.suffixes] = np.arange(n + 1)
    roots = []
    for beyond in next_beyond(ranks.tolist()):
        at = np.flatnonzero(beyond[:n] >= 0)
        roots.append(np.stack([at, beyond[at] - at]))
    at, period = np.concatenate(roots, axis=1)
    fits = exponent * period <= n
    at, period = at[fits], period[fits]
    if not len(at):
        return []
    before = left.common(n - at, n - at - period)
    length = period + right.common(at, at + period) + before
    long = length >= np.maximum(shortest, exponent * period)
    found = np.stack([(at - before)[long], length[long], period[long]], axis=1)
    return sorted({(s, n, p) for s, n, p in found.tolist()}, key=lambda run: (run[0], run[2]))


def recurring_parts(symbols: np.ndarray, exponent: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Stretches outside of which no run can lie: all their grams recur inside the stretch itself.

    A run is so much longer than twice its period that every gram of this width in it stands in it once more, one
    period further or earlier. So a stretch is cut where a gram is alone, until nothing is left to cut.
    """
    width = min(max(shortest, exponent * q) - 2 * q + 1 for q in range(1, shortest + 1))
    pending = [(0, len(symbols))]
    while pending:
        lo, hi = pending.pop()
        if hi - lo < max(shortest, width):
            continue
        grams = np.zeros(hi - lo - width + 1, np.uint64)
        for k in range(width):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + symbols[lo + k : lo + k + len(grams)]
            grams ^= grams >> np.uint64(29)
        order = np.argsort(grams)
        equal = grams[order[1:]] == grams[order[:-1]]
        again = np.zeros(len(grams), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        if again.all():
            yield lo, hi
            continue
        edges = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
        pending += zip((np.flatnonzero(edges == 1) + lo).tolist(), (np.flatnonzero(edges == -1) + lo + width - 1).tolist(), strict=True)


def runs_of(words: list[bytes], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start and period."""
    numbers: dict[bytes, int] = {}
    symbols = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.uint64, len(words))
    found = []
    for lo, hi in recurring_parts(symbols, exponent, shortest):
        _, part = np.unique(symbols[lo:hi], return_inverse=True)
        found += [(start + lo, length, period) for start, length, period in runs_in((part + 1).tolist(), exponent, shortest)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [word for word, gone in zip(words, (np.cumsum(edges[:-1]) > 0).tolist(), strict=True) if not gone]


def words_of(key: int | None, raw: bytes) -> list[bytes]:
    return raw.split()


def collapse(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    exponent: int = EXPONENT,
    shortest: int = SHORTEST,
    words: Callable[[int | None, bytes], list[bytes]] = words_of,
) -> DataFrame:
    """Per row of the table doc_id, n_words, the runs and `kept`, the words left after collapsing them.

    Words are what ASCII white space parts, or what `words` makes of a row's id and UTF-8 text. A run is a stretch with a
    smallest period q that no neighbouring word extends, of `exponent` times q and of `shortest` words at least; all its
    words but the first q go. A null or empty text has no words and no runs; rows without an id are taken as they are,
    repeated rows give repeated results, an empty table gives no rows. Columns other than the two are not read. A row is
    worked on in the task that read it and nothing is shuffled; memory grows with the longest recurring stretch of one
    text, by about 400 bytes a word.
    """
    if exponent < 2 or shortest < 1:
        raise ValueError("a run holds its period twice at least")
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, kept = [], [], []
            for doc, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                parts = words(doc, raw or b"")
                found = runs_of(parts, exponent, shortest)
                counts.append(len(parts))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                kept.append(b" ".join(collapsed(parts, found)).decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, RUN), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "kept"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, kept string")


def strongest(runs: str) -> Column:
    """The run that holds its period most often, compared exactly; the earliest, then the shortest period of equal ones."""
    nothing = F.lit(None).cast(RUNS.removeprefix("array<").removesuffix(">"))
    stronger = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.reduce(runs, nothing, lambda best, run: F.when(stronger(best, run), run).otherwise(best))
