"""Near duplicates by Order MinHash: sketches that keep text order, candidates confirmed by banded alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from citylake.llm.common import prepare, utf8, written
from citylake.llm.components import components
from citylake.llm.decontamination import NORMAL

K = 5  # words in a shingle
LEAST = 0.8
BANDS = 20
ROWS = 2  # sketch entries in a band
KEPT = 2  # k-mers in a sketch entry
# Members of a bucket, and words of them, that are compared at once.
BLOCK, BLOCK_WORDS = 512, 4 << 20
SALT = 64  # pairs of one text that are aligned in a row
BITS = 2048  # of a signature

M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 16
SIGNATURE = pa.struct([("n", pa.int32()), ("bits", pa.binary())])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def shingles(raw: bytes) -> np.ndarray:
    """Hashes of the runs of five normalised words, in text order; a text of fewer words is one shingle, of none none."""
    words = raw.translate(NORMAL).split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - K + 1) if words else 0
    total = np.full(n, M3)
    for k in range(min(K, len(words))):
        total = mix(total ^ hashes[k : k + n]) + np.uint64(k)
    return total


def labelled(kmers: np.ndarray) -> np.ndarray:
    """The k-mers with their occurrence number: the second equal k-mer of a text is another element than the first."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    if len(starts) == len(kmers):
        return mix(kmers)
    number = np.empty(len(kmers), np.uint64)
    number[order] = (np.arange(len(kmers)) - np.repeat(starts, np.diff(np.append(starts, len(kmers))))).astype(np.uint64)
    return mix(kmers + number * M3)


SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * M3) | np.uint64(1)


def sketch(kmers: np.ndarray) -> np.ndarray:
    """Order MinHash: per hash function the smallest labelled k-mers, hashed in the order they stand in the text.

    A band joins several such entries. Long texts are searched in pieces.
    """
    elements = labelled(kmers)
    kept = min(KEPT, len(elements))
    values, places = [], []
    for at in range(0, len(elements), PIECE):
        part = SEEDS[:, None] * elements[None, at : at + PIECE]
        part ^= part >> np.uint64(32)
        for _ in range(min(kept, part.shape[1])):
            place = part.argmin(axis=1)
            values.append(np.take_along_axis(part, place[:, None], axis=1)[:, 0])
            places.append(place + at)
            np.put_along_axis(part, place[:, None], np.uint64(2**64 - 1), axis=1)
    order = np.argsort(np.stack(values, axis=1), axis=1, kind="stable")[:, :kept]
    in_text = np.sort(np.take_along_axis(np.stack(places, axis=1), order, axis=1), axis=1)
    entry = np.full(len(SEEDS), M1)
    for k in range(kept):
        entry = mix(entry ^ elements[in_text[:, k]]) + np.uint64(k + 1)
    band = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        band = mix(band * M3 ^ entry[r::ROWS])
    return band.view(np.int64)


def signature(kmers: np.ndarray) -> bytes:
    """A bit for every labelled k-mer, at a place its hash gives."""
    bits = np.zeros(BITS, np.uint8)
    bits[(labelled(kmers) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def spare(n: list[np.ndarray], bits: list[np.ndarray], least: float) -> np.ndarray:
    """For two lists of texts, by k-mer counts and signatures, how far each pair is from being too unlike.

    Two signatures differ in at most as many bits as the texts differ in k-mers: below 0 no pair reaches the similarity.
    """
    differing = np.bitwise_count(bits[0][:, None, :] ^ bits[1][None, :, :]).sum(axis=2, dtype=np.int64)
    return (n[0][:, None] + n[1][None, :]) * (1 - least) / (1 + least) + 1e-6 - differing


def similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Shingles matched in order over all shingles of both texts, exact where it reaches `least`, else 0.

    Equal ends are cut off. The rest is aligned by the longest common subsequence, bit-parallel, with matches only in
    the band that an alignment of this similarity cannot leave. A count of common shingles settles most other pairs.
    """
    total = len(a) + len(b)
    if not total:
        return 0.0
    needed = least / (1 + least) * total
    if min(len(a), len(b)) < needed - 1e-9:
        return 0.0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    matched = head + tail
    if len(a) and len(b):
        values, counts_a = np.unique(a, return_counts=True)
        others, counts_b = np.unique(b, return_counts=True)
        _, x, y = np.intersect1d(values, others, assume_unique=True, return_indices=True)
        if matched + np.minimum(counts_a[x], counts_b[y]).sum() < needed - 1e-9:
            return 0.0
        matched += banded_lcs(a.tolist(), b.tolist(), int(total - 2 * needed) + 1)
    return matched / (total - matched) if matched >= needed - 1e-9 else 0.0


def banded_lcs(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence whose matches stand at most `band` apart."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    window = (1 << (2 * band + 1)) - 1
    state = full
    for j, x in enumerate(b):
        if found := where.get(x):
            hit = state & found & (window << (j - band) if j >= band else window >> (band - j))
            if hit:
                state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def sketches(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Per row its id, a hash of the text, the band keys (none for a text without words) and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands, signs = [], []
            for raw in utf8(batch.column(1)):
                kmers = shingles(raw or b"")
                bands.append(sketch(kmers) if len(kmers) else np.zeros(0, np.int64))
                signs.append({"n": len(kmers), "bits": signature(kmers)})
            columns = [batch.column(0), batch.column(2), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, SIGNATURE)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "bands", "sign"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("h"))
    return rows.mapInArrow(run, "id long, h binary, bands array<long>, sign struct<n: int, bits: binary>")


def confirmed(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that the alignment accepts; texts are given as id and shingles, 32 bits each.

    The pairs of one `a` are dealt to parts of about SALT, each with its own copy of that text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = ([np.frombuffer(x, np.uint32) for x in batch.column(i).to_pylist()] for i in (2, 3))
            mask = [similarity(x, y, least) >= least for x, y in zip(*sides, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(mask, pa.bool_()))

    parts = pairs.groupBy("a").agg(F.expr(f"1 + count(*) div {SALT}").alias("parts"))
    left = texts.select(F.col("id").alias("a"), F.col("kmers").alias("x")).join(parts, "a")
    left = left.select("a", "x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = texts.select(F.col("id").alias("b"), F.col("kmers").alias("y"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    return dealt.join(right, "b").join(left, ["a", "part"]).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def shingled(rows: DataFrame) -> DataFrame:
    """id and shingles of the texts t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(shingles(raw or b"") >> np.uint64(32)).astype(np.uint32).tobytes() for raw in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["id", "kmers"])

    return rows.select("id", "t").mapInArrow(run, "id long, kmers binary")


# How a member takes part in a group: on the left, on the right, on the right with one like it on the left elsewhere, or both.
LEFT, RIGHT, AGAIN, BOTH = range(4)
MEMBER = ["band", "left", "right", "side", "id", "root", "n", "bits", "bands"]
GROUP = "band long, left long, right long, side int, id long, root long, n int, bits binary, bands array<long>"


def open_pairs(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of a group that may be similar but are in different components, the likest first.

    Of the bands two texts share only the first one takes their pair.
    """
    side, ids, roots, n = (group.column(c).to_numpy() for c in ("side", "id", "root", "n"))
    bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    band = group.column("band")[0].as_py()
    lefts, rights = np.flatnonzero((side == LEFT) | (side == BOTH)), np.flatnonzero(side != LEFT)
    ordered = side[rights] != RIGHT
    found, spared = [], []
    for at in range(0, len(lefts), 64):
        some = lefts[at : at + 64]
        room = spare([n[some], n[rights]], [bits[some], bits[rights]], least)
        fits = (room >= 0) & (roots[some, None] != roots[None, rights]) & (~ordered[None, :] | (ids[some, None] < ids[None, rights]))
        i, j = np.nonzero(fits)
        spared.append(room[i, j])
        found.append(np.stack([some[i], rights[j]]))
    i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    spared = np.concatenate(spared) if spared else np.zeros(0)
    first = ~((bands[i] == bands[j]) & (bands[i] < band)).any(axis=1)
    i, j, spared = i[first], j[first], spared[first]
    order = np.lexsort((ids[j], ids[i], -spared))
    return i[order], j[order]


def by_group(rows: DataFrame, function: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """Every group (band, left, right) through a function, one after the other in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settled(upto: int | None) -> Iterator[pa.RecordBatch]:
            together = pa.Table.from_batches(held)
            keys = np.stack([together.column(c).to_numpy() for c in MEMBER[:3]])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), together.num_rows]
            held[:] = [] if upto is None else together.slice(cuts[-2]).to_batches()
            for lo, hi in zip(cuts[:upto], cuts[1:], strict=False):
                if hi > lo and (made := function(together.slice(lo, hi - lo))) is not None:
                    yield from made.combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from settled(-2)
        if held:
            yield from settled(None)

    dealt = rows.repartition("band", "left", "right").sortWithinPartitions("band", "left", "right", "id", "side")
    return dealt.mapInArrow(run, schema)


def met(rows: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join components inside the groups of `rows`, no more per group than it has members.

    Only members with a pair that the signatures leave open get their text; the task that holds them aligns the pairs,
    the likest first, and leaves out those whose ends it has joined by then.
    """

    def wanted(group: pa.Table) -> pa.Table | None:
        pairs = open_pairs(group, least)
        return group.take(pa.array(np.unique(np.concatenate(pairs)))) if len(pairs[0]) else None

    def joined(group: pa.Table) -> pa.Table | None:
        ids, roots = group.column("id").to_pylist(), group.column("root").to_pylist()
        kmers = [np.frombuffer(x, np.uint32) for x in group.column("kmers").to_pylist()]
        up: dict[int, int] = {}

        def top(node: int) -> int:
            while node in up:
                up[node] = node = up[node] if up[node] not in up else up[up[node]]
            return node

        links = []
        for i, j in zip(*(side.tolist() for side in open_pairs(group, least)), strict=True):
            a, b = top(roots[i]), top(roots[j])
            if a != b and similarity(kmers[i], kmers[j], least) >= least:
                up[max(a, b)] = min(a, b)
                links.append((ids[i], ids[j]))
        return pa.table([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["a", "b"]) if links else None

    open_ = by_group(rows.select(MEMBER), wanted, GROUP)
    return by_group(open_.join(texts, "id").select(*MEMBER, "kmers"), joined, "a long, b long")


def links(members: DataFrame, signs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Components (a, b) of the texts whose sketches share a band and whose similarity is at least `least`.

    First every member of a bucket is compared with the first. Then, only in buckets that still hold several components,
    the members of each block of a bucket meet; last, in buckets of several blocks, the members outside the largest
    component meet all members. So no pair that could join two components is left out, and what one component holds is
    not compared again.
    """
    first = members.groupBy("band").agg(F.min("id").alias("a"))
    pairs = members.join(first, "band").where("id > a").select("a", F.col("id").alias("b")).distinct()
    found = components(written(confirmed(written(pairs, "neardup-pairs"), texts, least), "neardup-links"))
    for inside in (True, False):
        named = members if inside else members.where("last > 0")
        named = named.join(found.withColumnsRenamed({"a": "id", "b": "root"}), "id", "left").withColumn("root", F.coalesce("root", "id"))
        sizes = named.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
        mixed = sizes.groupBy("band").agg(F.max_by("root", F.struct("size", "root")).alias("main"), (F.sum("size") - F.max("size")).alias("others"))
        mixed = written(mixed.where("others > 0").withColumn("parts", F.expr(f"1 + others div {BLOCK}")), "neardup-open")
        if mixed.isEmpty():
            continue
        open_ = written(named.join(mixed, "band"), "neardup-mixed")
        if inside:
            rows = open_.withColumns({"left": F.col("block"), "right": F.col("block"), "side": F.lit(BOTH)})
        else:
            other = F.col("root") != F.col("main")
            right = open_.withColumns({"left": F.explode(F.expr("sequence(0L, parts - 1)")), "right": F.col("block"), "side": F.when(other, AGAIN).otherwise(RIGHT)})
            part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))
            left = open_.where(other).withColumns({"left": part, "right": F.explode(F.expr("sequence(0L, last)")), "side": F.lit(LEFT)})
            rows = left.unionByName(right)
        more = written(met(rows.join(signs, "id"), texts, least), "neardup-links")
        if not more.isEmpty():
            found = components(found.unionByName(more))
    return found


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = LEAST) -> DataFrame:
    """One row per row of the table: doc_id, copy_of and class_id.

    `copy_of` is the smallest id with the same text, `class_id` the smallest id of all texts that links of similarity
    `least` or more connect with it. Links are looked for between texts that share a band of their sketches; five
    normalised words make a shingle. Texts without words are in a class only with equal texts, null texts with none. Rows
    without an id get the class of the rows with their text, or null. Rows of one id with different texts share a class;
    the text with the smallest MD5 stands for them. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = written(sketches(docs, text, key), "neardup-sketches")
    unique = rows.where("h is not null").groupBy("h").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
    unique = written(unique, "neardup-unique")
    standing = F.min_by(F.struct("h", "bands", "sign"), "h").alias("text")
    standing = written(unique.where("id is not null").groupBy("id").agg(standing).select("id", "text.*"), "neardup-standing")
    banded = standing.select("id", "sign.n", F.explode("bands").alias("band")).distinct()
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("words")).where("size > 1")
    last = F.expr(f"greatest(size div {BLOCK}, words div {BLOCK_WORDS})")
    members = banded.join(shared, "band").withColumn("last", last).withColumn("block", F.pmod(F.xxhash64("id"), F.col("last") + 1))
    members = written(members.select("band", "id", "block", "last"), "neardup-members")
    wanted = standing.join(members.select("id").distinct(), "id").select("id", "h")
    digest = F.unhex(F.md5(F.col(text).cast("binary"))).alias("h")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), digest).join(wanted, ["id", "h"]).dropDuplicates(["id"])
    signs = standing.select("id", "sign.n", "sign.bits", "bands")
    found = links(members, signs, written(shingled(texts), "neardup-shingles"), least)
    named = unique.select("h", F.col("id").alias("copy_of")).join(found.withColumnsRenamed({"a": "copy_of", "b": "class_id"}), "copy_of", "left")
    named = named.withColumn("class_id", F.coalesce("class_id", "copy_of"))
    out = rows.select("id", "h").join(named, "h", "left")
    return out.select(F.col("id").alias("doc_id"), F.coalesce("copy_of", "id").alias("copy_of"), F.coalesce("class_id", "id").alias("class_id"))


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = LEAST) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns; rows that repeat an id stay once.

    Of rows with one id the one whose text has the smallest MD5 stays, a null text last; of equal texts the one whose
    columns have the smallest hash. Rows without an id stay: nothing says which of them are the same document. All
    columns keep their names, whatever they are; an empty table gives no rows.
    """
    found = classes(docs, text, key, least)
    kept = found.where("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.struct(F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("~")), F.xxhash64(*hashed)).alias("place")
    rows = docs.select(F.struct(*columns).alias("row"), F.col(key).cast("long").alias("id"), place)
    once = rows.where("id is not null").join(kept, "id", "left_semi").groupBy("id").agg(F.min_by("row", "place").alias("row"))
    return once.select("row.*").unionByName(docs.where(F.col(key).isNull()))
