"""Instants, local wall clocks, calendar days and date spines."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citylake.functions.columns import ColumnOrName, as_col

MARKET_ZONE = "Europe/Prague"


def local_ts(ts: ColumnOrName, zone: str = MARKET_ZONE) -> Column:
    """Wall clock of an instant, in a UTC session. Repeats in the autumn switch hour, so never use it as a key.

    `convert_timezone` would look up both zones by name for every row.
    """
    return F.from_utc_timestamp(as_col(ts).cast("timestamp"), zone).cast("timestamp_ntz")


def local_date(ts: ColumnOrName, zone: str = MARKET_ZONE) -> Column:
    return local_ts(ts, zone).cast("date")


def date_key(day: ColumnOrName) -> Column:
    """Integer YYYYMMDD."""
    day = as_col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def local_day_bounds(day: ColumnOrName, zone: str = MARKET_ZONE) -> tuple[Column, Column]:
    """[local midnight, next local midnight) as instants: 23, 24 or 25 hours apart."""
    day = as_col(day).cast("date")
    return (
        F.to_utc_timestamp(day.cast("timestamp"), zone),
        F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone),
    )


def expected_slots(day: ColumnOrName, zone: str = MARKET_ZONE, minutes: int = 5) -> Column:
    """Slots a local day holds; daylight-saving switches shorten or lengthen it."""
    start, end = local_day_bounds(day, zone)
    return F.floor(F.timestamp_diff("MINUTE", start, end) / F.lit(minutes)).cast("int")


def instant(text: ColumnOrName) -> Column:
    """ISO text, with or without an offset, to an instant (no offset means UTC)."""
    return as_col(text).cast("timestamp")


def hour_start(ts: ColumnOrName) -> Column:
    return F.date_trunc("hour", as_col(ts))


def span(amount: int, unit: str) -> Column:
    """Interval literal, `unit` being minute, hour or day."""
    return F.make_dt_interval(
        days=F.lit(amount if unit == "day" else 0),
        hours=F.lit(amount if unit == "hour" else 0),
        mins=F.lit(amount if unit == "minute" else 0),
    )


def calendar_parts(day: ColumnOrName) -> dict[str, Column]:
    """The calendar attributes of a date, ISO weeks included."""
    day = as_col(day)
    return {
        "calendar_year": F.year(day),
        "calendar_quarter": F.quarter(day),
        "calendar_month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "iso_day_of_week": F.extract(F.lit("dayofweek_iso"), day),
        "day_name": F.date_format(day, "EEEE"),
        "iso_week": F.weekofyear(day),
        "iso_year": F.extract(F.lit("yearofweek"), day),
    }


def date_spine(spark: SparkSession, start: date, end: date, name: str = "date_day") -> DataFrame:
    """Days of [start, end)."""
    if end <= start:
        raise ValueError(f"end {end} is not after start {start}")
    days = F.sequence(F.lit(start), F.lit(end - timedelta(days=1)), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))


def days_between(first: ColumnOrName, last: ColumnOrName) -> Column:
    """Array of days, both ends included; null when `last` lies before `first`."""
    first, last = as_col(first).cast("date"), as_col(last).cast("date")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
