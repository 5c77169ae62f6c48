"""One query per operator over its whole table, each with SQL giving the same rows where SQL can express it."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField

from citylake.llm import decontamination, divergence, hnsw, language, lines, mixing, neardup, periodic, phrases, quality, sharding, suffixes, vectors
from citylake.llm.common import remainder, running, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARD_DIMENSIONS = ["lang", "source", "n_chars"]
# Batches, by a hash of the id, in which op4 gets the documents.
BATCHES = 3


def query(sql: str | None = None):
    """Registers fn(spark, folder) -> DataFrame under its own name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


@query(
    r"""
    with d as (
        select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
        from documents),
    b as (
        select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from benchmark where text is not null and item_id is not null),
    wins as (
        select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
        from b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as t(i) where len(w) > 0),
    sizes as (select distinct n from wins),
    grams as (
        select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
        from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n),
    found as (select doc_id, i, n, item_id from grams join wins using (n, g)),
    hit as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
    items as (
        select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
        from (select distinct doc_id, item_id::varchar as id from found) group by doc_id)
    select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
        sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join hit using (doc_id) left join items using (doc_id)
    """
)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs.where(remainder("doc_id", 4) != 2))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query()
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    network = quality.learn(docs, labels.where(remainder("doc_id", 5) != 0))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return quality.score(docs.select("doc_id", "text"), network).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


@query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tree = sharding.plan(docs, SHARD_DIMENSIONS, shards=24)
    slim = sharding.assign(docs, tree, SHARD_DIMENSIONS).select(
        "doc_id",
        sharding.size_of().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("_node").alias("shard"),
    )
    return running(slim, "shard", ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("_before").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.taken(mixing.plan(docs)).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents").select("doc_id", "text"))


@query(
    """
    with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
    lines as (
        select doc_id, i, parts[i] as line,
            translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from d, unnest(range(1, len(parts) + 1)) as t(i)),
    repeated as (
        select key, min(doc_id) as first from lines where length(key) >= 10
        group by key having count(distinct doc_id) >= 2),
    marked as (select l.*, r.first is not null and l.doc_id > r.first as gone from lines l left join repeated r using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from marked group by doc_id
    """
)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = lines.LineIndex(spark).insert(docs).clean(docs, inserted=True)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def digest(cut):
    """A finishing step that returns the SHA-256 of what is left instead of it."""

    def finish(raw: bytes, spans: list[tuple[int, int]]) -> tuple:
        *numbers, kept = cut(raw, spans)
        return (*numbers, hashlib.sha256(kept if isinstance(kept, bytes) else kept.encode()).hexdigest())

    return finish


def digest_fields(fields: list) -> list:
    return [*fields[:-1], (StructField("kept_sha256", StringType()), pa.string())]


@query()
def op4_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    family = suffixes.SuffixFamily(spark)
    for batch in range(BATCHES):
        family = family.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)) == batch))
    return family.clean(docs, finish=digest(suffixes.cut_bytes), fields=digest_fields(suffixes.CUT))


@query()
def op7_recurring_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return phrases.clean(docs, finish=digest(phrases.cut_words), fields=digest_fields(phrases.CUT))


@query()
def op10_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.search(table(spark, folder, "embeddings"), every=20)


def planted(doc: int | None, raw: bytes) -> list[bytes]:
    """The words of a text; in one document of ten the words from some place on are the first of them over and over."""
    words = raw.split()
    seed, tenth = divmod(zlib.crc32(str(doc).encode()), 10)
    if doc is None or tenth or not words:
        return words
    start = seed % len(words)
    period = 1 + (len(words) - start) // (3 + seed % 8)
    return words[:start] + [words[start + i % period] for i in range(len(words) - start)]


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    best = periodic.strongest("runs")
    found = periodic.collapse(docs, words=planted).withColumn("best", best)
    line = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query(
    """
    with recursive v as (
        select vec_id, embedding::double[] as e from embeddings
        where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
            and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    n as (select vec_id, e, list_dot_product(e, e) as s from v),
    l as (
        select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id
        where list_dot_product(a.e, b.e) >= 0.95 * sqrt(a.s * b.s)),
    reach as (select a, b from l union select r.a, l.b from reach r join l on r.b = l.a),
    c as (select a, min(b) as least from reach group by a),
    k as (select a, count(*) as n_links from l group by a)
    select vec_id, coalesce(n_links, 0) as n_links, least(vec_id, least) as component_id,
        least(vec_id, least) = vec_id as kept
    from embeddings left join c on c.a = vec_id left join k on k.a = vec_id
    """
)
def op12_tiled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query(
    r"""
    with d as (
        select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
        from documents),
    g as (select distinct lang, source from d),
    t as (select r, lang, source, unnest(w) as term from d),
    kept as (select lang, term, count(*) as n from t group by lang, term having count(distinct r) >= 30),
    langs as (select lang, count(*) as v, sum(n)::hugeint as total from kept group by lang),
    c as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by lang, source, term),
    totals as (
        select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total
        from g left join c on c.lang = g.lang and c.source = g.source group by g.lang, g.source),
    p as (
        select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
            (1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (s.total + 5 * l.v))::bigint as p,
            (1 + 1000000000::hugeint * (k.n + 5) // (l.total + 5 * l.v))::bigint as q
        from totals s join langs l on l.lang = s.lang join kept k on k.lang = s.lang
            left join c on c.lang = s.lang and c.source = s.source and c.term = k.term),
    apart as (
        select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    pairs as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
        from g a join g b on a.lang = b.lang and a.source <> b.source
            left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
    terms as (select lang, source, 'term' as part, term as item, p - q as value from p where n > 0 and p > q),
    ranked as (
        select *, (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank
        from (select * from pairs union all select * from terms))
    select * from ranked where part = 'pair' or rank <= 50
    """
)
def op13_count_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))
