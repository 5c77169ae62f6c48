"""New files only, and upserts per micro-batch. Both wrap the batch functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citylake.functions.columns import ColumnOrName
from citylake.operators.dedup import latest_wins
from citylake.plans.warehouse import upsert_partitions


def new_payloads(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed payload files not seen before."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).withColumnRenamed("value", "payload")


def new_rows(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Rows of Parquet files not seen before."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, handle: Callable[[DataFrame], object], checkpoint: str) -> StreamingQuery:
    """Hands every pending micro-batch to `handle` and stops when all files are read.

    The checkpoint remembers the files; a batch repeated after a failure must be harmless, which partition
    overwrites and upserts are.
    """
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: handle(batch) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[ColumnOrName],
    partition: str,
    checkpoint: str,
) -> StreamingQuery:
    """Upserts every micro-batch: per key, the row with the highest `order_by` of table and batch stays.

    A late older row never replaces a newer one, and repeating a batch changes nothing. The key must contain
    the partition column or determine it.
    """

    def newest(target: DataFrame, batch: DataFrame, on: Sequence[str]) -> DataFrame:
        return latest_wins(target.unionByName(batch, allowMissingColumns=True), list(on), order_by)

    def handle(batch: DataFrame) -> None:
        if not batch.isEmpty():
            latest = latest_wins(batch, list(keys), order_by)
            upsert_partitions(batch.sparkSession, path, latest, keys, partition, newest)

    return run_available(stream, handle, checkpoint)
