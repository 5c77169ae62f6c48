"""Resampling of regular series to hours and local days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.exact import exact_avg
from citylake.functions.time import MARKET_ZONE, expected_slots, hour_start, local_date


def resample_hourly(df: DataFrame, keys: Sequence[str], ts: str, aggregates: Sequence[Column]) -> DataFrame:
    """One row per key and UTC hour with the given aggregates and `n_intervals`."""
    return df.groupBy(*keys, hour_start(ts).alias("hour_start_ts_utc")).agg(
        *aggregates, F.count("*").alias("n_intervals")
    )


def hourly_statistics(df: DataFrame, keys: Sequence[str], ts: str, value: str, loaded_at: str) -> DataFrame:
    """Exact mean, minimum, maximum, number of points and newest load stamp per hour."""
    return resample_hourly(
        df,
        keys,
        ts,
        [
            exact_avg(value).alias(value),
            F.min(value).alias(f"min_{value}"),
            F.max(value).alias(f"max_{value}"),
            F.max(loaded_at).alias(loaded_at),
        ],
    )


def rollup_local_day(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    aggregates: Sequence[Column],
    zone: str = MARKET_ZONE,
    slot_minutes: int = 5,
) -> DataFrame:
    """One row per key and local calendar day, with slot counts and completeness."""
    daily = df.groupBy(*keys, local_date(ts, zone).alias("local_date")).agg(
        *aggregates, F.count("*").alias("n_slots")
    )
    slots = expected_slots("local_date", zone, slot_minutes)
    return daily.withColumn("expected_slots", slots).withColumn(
        "is_complete_day", F.col("n_slots") >= F.col("expected_slots")
    )
