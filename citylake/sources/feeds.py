"""From landed payloads to bronze: what every source needs, in one place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citylake.functions.time import local_date
from citylake.sources import landing, payloads, schemas

# Column of the payload rows: the day a payload was asked for.
REQUESTED = "requested_day"


@dataclass(frozen=True)
class Feed:
    """How payloads become raw rows, which day a row is stored under, and how the source behaves.

    `reload_days` is how far back a source still revises what it gave; `clamp_future` is for sources that invent or
    reject days to come.
    """

    rows: Callable[[DataFrame], DataFrame]
    day: Callable[[], Column]
    doubles: tuple[str, ...] = ()
    reload_days: int = 0
    clamp_future: bool = False


def _features(properties: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: payloads.explode_features(df, properties)


def _records(fields: str, root: str | None = None) -> Callable[[DataFrame], DataFrame]:
    return lambda df: payloads.explode_records(df, fields, root)


def _market(field: str, unit: str, area: str = "area") -> Callable[[DataFrame], DataFrame]:
    """Points of all series of the documents, one row per instant, within the days that were asked for."""

    def rows(df: DataFrame) -> DataFrame:
        points = payloads.xml_points(df, field, unit, area)
        if REQUESTED in points.columns:
            points = points.filter(local_date("ts_utc") == F.col(REQUESTED)).drop(REQUESTED)
        return payloads.collapse_series(points)

    return rows


def _asked() -> Column:
    return F.col(REQUESTED)


FEEDS = {
    "air_stations": Feed(_features(schemas.STATION_PROPERTIES), _asked),
    "bike_counters": Feed(_features(schemas.COUNTER_PROPERTIES), _asked),
    "city_districts": Feed(_features(schemas.DISTRICT_PROPERTIES), _asked),
    "air_history": Feed(_records(schemas.HISTORY_RECORD), lambda: landing.day_of_text("updated_at")),
    "bike_detections": Feed(
        _records(schemas.DETECTION_RECORD),
        lambda: landing.day_of_text("measured_from"),
        ("value", "value_pedestrians"),
        landing.RELOAD_DAYS["bike_detections"],
    ),
    "energy_prices": Feed(_market("price.amount", "EUR/MWh"), lambda: local_date("ts_utc")),
    "energy_load": Feed(_market("quantity", "MW"), lambda: local_date("ts_utc")),
    "fx_daily": Feed(_records(schemas.RATE_RECORD, "rates"), _asked, clamp_future=True),
    "weather_hourly": Feed(
        payloads.unzip_columnar,
        lambda: landing.day_of_text("time"),
        schemas.WEATHER_VARIABLES,
        landing.RELOAD_DAYS["weather_hourly"],
        clamp_future=True,
    ),
}


def window(spark: SparkSession, root: str, source: str, today: date, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """Days to load of a source, both ends included, from its load mark; a first load needs a start."""
    feed = FEEDS[source]
    last = landing.last_loaded(spark, root, source)
    return landing.resolve_window(last, today, start, end, feed.reload_days, feed.clamp_future)


def land(df: DataFrame, root: str, source: str, loaded_at: datetime | Column, days: tuple[date, date] | None = None) -> int:
    """Payload rows of a source to its daily bronze partitions; returns the number of rows.

    Payloads come with the columns the source needs: `payload`; `requested_day` where the rows do not say their day;
    `stations` for column-wise arrays; `file_path` to be named in errors. Rows outside `days` are left out. A day that
    is landed again is replaced, and the load mark never moves back.
    """
    feed = FEEDS[source]
    rows = feed.rows(df).withColumn("load_date", feed.day())
    rows = rows.drop(REQUESTED, "file_path")
    if days is not None:
        rows = rows.filter(F.col("load_date").between(*(F.lit(d) for d in days)))
    return landing.land(rows, root, source, "load_date", loaded_at, feed.doubles)
