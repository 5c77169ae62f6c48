"""Top-k and reproducible sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_BITS = 16
HASH_BITS = 60
COPIES = 4096


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows in the given order; each task keeps k rows before anything moves."""
    return df.orderBy(*order).limit(k)


def seeded_hash(columns: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of the seed and the columns as text, joined by bars; null and empty text differ."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def exact_sample(df: DataFrame, rows: int, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly `rows` rows (all of them if there are fewer), the same ones on every run: those with the smallest hash.

    A histogram of the leading hash bits, combined before the exchange, finds the bucket where the running count
    reaches `rows`. Rows of the buckets before it pass as they are; only that bucket is ranked.
    """
    key = list(key or df.columns)
    hashed = df.withColumn("_hash", seeded_hash(key, seed))
    hashed = hashed.withColumn("_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("n"))
    # The window sees the histogram, one row per bucket, whatever the size of the table.
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("total", F.sum("n").over(upto)).filter(F.col("total") >= rows)
    cut = reached.agg(F.min_by(F.struct("_bucket", (F.col("total") - F.col("n")).alias("below")), "_bucket").alias("c")).first()["c"]
    if cut is None:
        return df
    whole = hashed.filter(F.col("_bucket") < cut["_bucket"])
    # Rows that repeat exactly share a hash: they are counted in their tasks first, so that a bucket of copies is one row.
    distinct = hashed.filter(F.col("_bucket") == cut["_bucket"]).groupBy("_bucket", "_hash", *df.columns).agg(F.count("*").alias("_copies"))
    ahead = Window.partitionBy("_bucket").orderBy("_hash", *df.columns).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(rows - cut["below"]) - F.coalesce(F.sum("_copies").over(ahead), F.lit(0))
    part = distinct.withColumn("_take", F.least("_copies", left)).filter("_take > 0")
    # Copies are made in two steps, so that no row carries a long array.
    blocks = part.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_take - 1) div {COPIES}"))))
    repeated = blocks.withColumn("_copy", F.explode(F.expr(f"sequence(1L, least({COPIES}L, _take - _block * {COPIES}))")))
    return whole.select(*df.columns).unionByName(repeated.select(*df.columns))
