"""Source divergence audit: term shares of groups compared through bitmaps of the terms at each count level."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.llm.common import prepare, running, utf8, written

LEAST_DOCS = 30
TOP = 50
SMOOTH = 5
SCALE = 1_000_000_000

WORD = 64  # terms in a bitset
CHUNK = 8  # bitsets of a group compared in one call
STRIP = 128  # groups of a language compared in one call
HELD = 1 << 18  # counted terms a task holds before it passes them on
TILE = 1 << 21

# Letters of ASCII in lower case and all bytes of other characters stand for themselves, the rest parts terms.
TERMS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n and docs: occurrences and documents of every term in every group.

    Every group also has a row for the empty term, so that groups without terms are known. Counts are summed up in the
    task that reads the texts and once more before they move.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (own_lang, own_source), (times, documents) in held.items():
                terms = [b"", *times]
                columns = [[own_lang] * len(terms), [own_source] * len(terms), terms, [0, *times.values()], [0, *(documents[t] for t in times)]]
                kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
                made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
                made = made.set_column(2, "term", made.column(2).cast(pa.string()))
                yield from (made.slice(at, 1 << 14) for at in range(0, len(terms), 1 << 14))
            held.clear()

        for batch in batches:
            for own_lang, own_source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                found = Counter(raw.translate(TERMS).split())
                times, documents = held[own_lang, own_source]
                times.update(found)
                documents.update(found.keys())
            if sum(len(times) for times, _ in held.values()) > HELD:
                yield from passed_on()
        yield from passed_on()

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)))
    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, kept: str, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (n + smooth) / (total + smooth * kept)) in whole numbers of any size."""
    above = f"cast({scale} as decimal(12,0)) * cast({n} + {smooth} as decimal(20,0))"
    return F.expr(f"1 + ({above}) div (cast({total} as decimal(20,0)) + cast({smooth} * {kept} as decimal(20,0)))")


def bitmaps(present: DataFrame) -> DataFrame:
    """lang, word, source, n and bits: the terms a group has n times, as a set of 64 per row.

    `present` has lang, source, n and the number of the term, from 0 without gaps in each language.
    """
    bit = F.expr(f"shiftleft(1L, cast(number % {WORD} as int))")
    return present.groupBy("lang", F.expr(f"number div {WORD}").alias("word"), "source", "n").agg(F.bit_or(bit).alias("bits"))


def with_absent(source: np.ndarray, bits: np.ndarray, p: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows of one set of terms, by group, with the level of count 0 cut down to what the other levels leave."""
    order = np.lexsort((level, source))
    source, bits, p, level = source[order], bits[order].copy(), p[order], level[order]
    starts = np.flatnonzero(level == 0)
    others = np.where(level == 0, np.uint64(0), bits)
    bits[starts] &= ~np.bitwise_or.reduceat(others, starts)
    return source, bits, p, starts


def distances(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]) -> np.ndarray:
    """For every group of the left and of the right the sum of |p - q| over the terms of one set, in int64."""
    _, bits, p, starts = left
    _, others, q, ends = right
    rows = max(1, TILE // len(others))
    made = []
    for at in range(0, len(bits), rows):
        cells = np.bitwise_count(bits[at : at + rows, None] & others[None, :]).astype(np.int64)
        cells *= np.abs(p[at : at + rows, None] - q[None, :])
        made.append(np.add.reduceat(cells, ends, axis=1))
    return np.add.reduceat(np.concatenate(made), starts, axis=0)


def pair_sums(table: pa.Table) -> pa.Table:
    """Of a chunk of terms the summed differences of all pairs of groups, one from either strip; none if one is empty."""
    lang, low, high = (table.column(name)[0].as_py() for name in ("lang", "low", "high"))
    names, group = np.unique(table.column("source").to_pandas().to_numpy(object), return_inverse=True)
    column = {name: table.column(name).to_numpy() for name in ("word", "strip", "n", "bits", "p")}
    found, ids = 0, []
    if set(column["strip"].tolist()) != {low, high}:
        return table.select(["lang", "source", "source", "p"]).rename_columns(["lang", "a", "b", "value"]).slice(0, 0)
    for word in np.unique(column["word"]):
        sides = []
        for strip in (low, high):
            own = (column["word"] == word) & (column["strip"] == strip)
            sides.append(with_absent(group[own], column["bits"][own].view(np.uint64), column["p"][own], column["n"][own]))
        ids = [side[0][side[3]] for side in sides]
        found = found + distances(*sides)
    a, b = (x.ravel() for x in np.meshgrid(*ids, indexing="ij"))
    values = found.ravel()
    if low == high:
        a, b, values = a[a != b], b[a != b], values[a != b]
    else:
        a, b, values = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((values, values))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(names[a], pa.string()), "b": pa.array(names[b], pa.string()), "value": pa.array(values, pa.int64())})


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    smooth: int = SMOOTH,
    scale: int = SCALE,
) -> DataFrame:
    """How far the sources of each language are apart, and by which terms: lang, source, part, item, value, rank.

    A language keeps the terms that `least_docs` of its rows have. A group (lang, source) gives each kept term the
    smoothed share of its occurrences, in whole units of 1 / `scale`. Part `pair`: for every other source of the language
    the summed difference of shares over all kept terms, 0 without kept terms. Part `term`: the `top` kept terms of the
    group whose share lies furthest above that in the whole language. Ranks go by value descending, then item.

    Terms are runs of letters and characters beyond ASCII, A-Z in lower case. Nulls in the three columns count as empty,
    an empty text has no terms but its group is there; repeated rows count as often as they stand; other columns are
    not read; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    counts = written(term_counts(docs, lang, source, text), "divergence-counts")
    seen = counts.where("term <> ''")
    kept = seen.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = written(kept.select("lang", "term", "lang_n"), "divergence-kept")
    terms = running(kept, "lang", ["term"]).withColumnRenamed("_before", "number")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    present = written(seen.join(terms, ["lang", "term"]).select("lang", "source", "term", "number", "n", "lang_n"), "divergence-present")

    sums = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    strips = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).select("lang", F.expr(f"1 + sources div {STRIP}").alias("strips"))
    groups = written(groups.fillna(0).join(strips, "lang").withColumn("strip", F.expr("pmod(xxhash64(source), strips)")), "divergence-groups")

    filled = F.expr(f"if(kept - word * {WORD} >= {WORD}, -1L, ~shiftleft(-1L, cast(kept - word * {WORD} as int)))")
    words = langs.select("lang", "kept", F.explode(F.expr(f"sequence(0L, (kept - 1) div {WORD})")).alias("word"))
    absent = words.withColumn("bits", filled).join(groups.select("lang", "source"), "lang").select("lang", "word", "source", F.lit(0).cast("bigint").alias("n"), "bits")
    levels = bitmaps(present).unionByName(absent).join(groups, ["lang", "source"])
    met = F.explode(F.expr("sequence(0L, strips - 1)"))
    levels = levels.select("lang", "source", "word", "n", "bits", "strip", share("n", "total", "kept", smooth, scale).alias("p"), met.alias("other"))
    chunked = levels.withColumns({"chunk": F.expr(f"word div {CHUNK}"), "low": F.least("strip", "other"), "high": F.greatest("strip", "other")})
    apart = chunked.drop("other").groupBy("lang", "chunk", "low", "high").applyInArrow(pair_sums, "lang string, a string, b string, value long")
    apart = apart.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    bare = groups.where("kept = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = apart.unionByName(zero).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(within)})

    owned = present.join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"])
    above = share("n", "total", "kept", smooth, scale) - share("lang_n", "lang_total", "kept", smooth, scale)
    marked = owned.select("lang", "source", F.col("term").alias("item"), above.alias("value")).where("value > 0")
    typical = marked.withColumns({"part": F.lit("term"), "rank": F.row_number().over(within)}).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(typical.select(columns))
