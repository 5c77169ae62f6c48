"""What the operators share: table access, Arrow batches of bounded size, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from citylake.session import configure, cut_lineage, fresh_dir

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
# Rows of a group that are numbered or summed up together.
RUN = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package: UTC, adaptive plans, and Arrow batches that a Python worker can hold."""
    configure(spark)
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", str(value))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1, ..., which no name used inside an operator clashes with, and the new names by the old."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def checkpointed(df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def by_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """Every Arrow batch of the table through a function, without moving rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo a divisor; null where the value is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def char_offsets(raw: bytes, positions: np.ndarray) -> list[int]:
    """Code points before each byte position; the positions ascend."""
    found, at, count = [], 0, 0
    for position in positions.tolist():
        count += len(raw[at:position].decode("utf-8"))
        at = position
        found.append(count)
    return found


def small(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few rows the driver holds anyway, as a literal of the plan; types int, long, double, string."""
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    fields = [pa.field(name, types[kind]) for name, kind in (x.split() for x in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(v, f.type) for v, f in zip(columns, fields, strict=True)], schema=pa.schema(fields)))


def running(rows: DataFrame, group: str, order: list[str], weight: Column | None = None, per: int = RUN) -> DataFrame:
    """The rows with `_before`: the sum of the weights of the rows before each in its group, without bringing a group together.

    Rows are dealt to buckets of about `per` rows by a hash of the order columns; a bucket starts where the sums of the
    buckets before it end. Without a weight this numbers the rows of a group from 0 without gaps.
    """
    buckets = 1 + rows.count() // per
    dealt = rows.withColumns({"_bucket": F.pmod(F.xxhash64(*order), F.lit(buckets)), "_weight": F.lit(1) if weight is None else weight})
    sums = dealt.groupBy(group, "_bucket").agg(F.sum("_weight").alias("_sum"))
    ahead = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("_weight").over(within), F.lit(0))).join(starts, [group, "_bucket"])
    return placed.withColumn("_before", F.col("_start") + F.col("_inside")).drop("_bucket", "_weight", "_start", "_inside")
