"""The corpus pipeline: documents through the stages of STAGES, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citylake.llm import decontamination, language, mixing, neardup, sharding
from citylake.llm.common import plain_names, remainder, table, written


# A document stays if its language makes up half of it or more.
LEAST_SHARE = 0.5
SHARDS = 24
SHARD_DIMENSIONS = ["lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in which no language reaches half of the text, go.

    A null or empty text has no letter; repeated rows share their fate; rows without an id are judged like all others but
    nothing is learned from them. All columns stay as they are, whatever their names.
    """
    model = language.learn(docs.where(remainder("doc_id", 4) != 2))
    plain, names = plain_names(docs)
    found = language.identify(plain, model, names["text"])
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select(*names.values()).toDF(*docs.columns)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return neardup.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark passages go.

    Null and empty texts have no words and stay; repeated rows share their fate. All columns stay as they are.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole copies of `taken` words, the rest rounded by a hash of the id.

    A document with 1.4 times its words taken comes once or, in four of ten cases, twice; one that is not taken goes, as
    do null texts and others without words. Rows of one id, and rows without one, share what is taken of them together.
    All columns stay as they are, whatever their names.
    """
    mix = mixing.plan(docs)
    given = mixing.taken(mix).where("size > 0").groupBy("doc_id").agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    part = F.pmod(F.xxhash64("doc_id", F.lit(mix.seed)), F.lit(1 << 20)) / (1 << 20)
    times = given.select(F.col("doc_id").alias("_id"), F.floor(F.col("_taken") / F.col("_size") + part).cast("int").alias("_times")).where("_times > 0")
    plain, names = plain_names(docs)
    repeated = plain.join(times, F.col(names["doc_id"]).eqNullSafe(F.col("_id"))).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return repeated.select(*names.values()).toDF(*docs.columns)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it; shards hold nearly equal bytes.

    Null metadata stands before all other values; `shard` and `slot` replace columns of these names, all others stay.
    """
    return sharding.shard(docs, SHARD_DIMENSIONS, shards=SHARDS)


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_representatives),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

# EM, sketches and draws have no SQL; tests/llm/test_pipeline.py holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
