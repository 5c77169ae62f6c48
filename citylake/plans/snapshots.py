"""Snapshot tables as a log of changes, folded when they are read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from citylake.operators.scd2 import fold_changes
from citylake.session import cut_lineage
from citylake.sources.landing import read_if_exists

LOG, LOG_SCHEMA = "_log", "run string, kind string"
BASE, DELTA = "base", "delta"
# Runs with changes after which the log is folded into a new base.
COMPACT_AFTER = 30


def _run(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def _parts(spark: SparkSession, path: str, before: str | None = None) -> list[tuple[str, str]]:
    """(run, kind) of the newest base and the changes after it, as far as they were finished and are older than `before`."""
    log = read_if_exists(spark, f"{path}/{LOG}", LOG_SCHEMA)
    known = [] if log is None else [(r["run"], r["kind"]) for r in log.distinct().collect() if before is None or r["run"] < before]
    base = max((run for run, kind in known if kind == BASE), default="")
    return sorted((run, kind) for run, kind in known if (run == base if kind == BASE else run > base))


def read_snapshot(spark: SparkSession, path: str, before: datetime | None = None) -> DataFrame | None:
    """All versions with their validity after the last finished run, or the last one before an instant."""
    parts = _parts(spark, path, before and _run(before))
    if not parts:
        return None
    return fold_changes(spark.read.option("mergeSchema", True).parquet(*(f"{path}/{kind}={run}" for run, kind in parts)))


def append_changes(spark: SparkSession, path: str, changes: DataFrame, run_ts: datetime, compact_after: int = COMPACT_AFTER) -> DataFrame:
    """Writes the changes of a run, if there are any, then the log row that makes them count; returns the versions.

    A run that fails leaves the table as it is, and a run may be repeated: its changes replace those it wrote before.
    After `compact_after` runs with changes all versions are written as a base; what a base has replaced goes with the
    next one, so that readers of the state before are not cut off.
    """
    run = _run(run_ts)
    changes = cut_lineage(changes)

    def finished(kind: str) -> None:
        spark.createDataFrame([(run, kind)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")

    again = (run, DELTA) in _parts(spark, path)
    if again or not changes.isEmpty() or not _parts(spark, path):
        changes.write.mode("overwrite").parquet(f"{path}/{DELTA}={run}")
        if not again:
            finished(DELTA)
    parts = _parts(spark, path)
    if sum(kind == DELTA for _, kind in parts) >= compact_after:
        read_snapshot(spark, path).withColumn("scd_closes", F.lit(False)).write.mode("overwrite").parquet(f"{path}/{BASE}={run}")
        finished(BASE)
        kept = parts[0][0]
        for old, kind in {(r["run"], r["kind"]) for r in read_if_exists(spark, f"{path}/{LOG}", LOG_SCHEMA).collect()}:
            if old < kept:
                place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={old}")
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return read_snapshot(spark, path)
