"""Feeds over tables that are one file of one row group."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES, feeds
from catalog.registry import Tables
from citylake import session
from tests.conftest import SMALL


@pytest.mark.parametrize(
    "feed", ["bike_detections", "event_detections", "air_stations", "air_history", "bike_counters", "weather_hourly", "energy_prices", "energy_load", "fx_daily"]
)
def test_the_rows_of_a_feed_are_made_by_many_tasks(spark, monkeypatch, feed):
    make, t = getattr(feeds, feed).make, Tables(spark, SMALL)
    whole = make(t)
    monkeypatch.setattr(feeds, "TASK_ROWS", max(whole.count() // 8, 1))
    rows = make(t)
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 4 and max(tasks) < sum(tasks) / 2
    assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()


def test_the_texts_of_a_slot_are_made_once(spark):
    """Not once for every detection in it."""
    plan = feeds.bike_detections.make(Tables(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [k for k, line in enumerate(plan) if "date_format" in line]
    sources = [next(line for line in plan[k + 1 :] if "Project" not in line and "Filter" not in line) for k in made]
    assert sources and all("Range" in line for line in sources)


def test_small_feeds_stay_as_they_are(spark):
    events = Tables(spark, SMALL).events
    assert feeds.spread(events, "event_id") is events


def test_a_scan_task_reads_few_of_the_landed_files(spark, tmp_path):
    """Files that Spark would pack up to a core's share of the table go to tasks of SPLIT_BYTES."""
    held = spark.conf.get(session.SPLIT)
    path = str(tmp_path / "rows")
    spark.range(40_000).repartition(40).write.parquet(path)
    try:
        spark.conf.set(session.SPLIT, "128m")
        packed = spark.read.parquet(path).rdd.getNumPartitions()
        session.bound_scans(spark)
        assert packed <= 4 < 20 <= spark.read.parquet(path).rdd.getNumPartitions()
        spark.conf.set(session.SPLIT, "1m")
        session.bound_scans(spark)
        assert spark.conf.get(session.SPLIT) == "1m"
        spark.conf.set(session.SPLIT, "128m")
        QUERIES["d11_global"](spark, SMALL).collect()
        assert spark.conf.get(session.SPLIT) == str(session.SPLIT_BYTES)
    finally:
        spark.conf.set(session.SPLIT, held)
