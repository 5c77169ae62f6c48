"""Declared data tests of every layer."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from citylake.operators.joins import overlapping_versions
from citylake.quality import (
    WARN,
    Check,
    accepted_range,
    accepted_values,
    bind,
    days_without,
    no_time_gaps,
    non_negative,
    not_null,
    relationship,
    short_horizon,
    unique,
    unique_together,
)

# Codes the sources are known to use.
POLLUTANTS = ("CO", "NO2", "NOx", "O3", "O3_Model", "PM10", "PM2_5", "SO2")
AIR_QUALITY_INDEX = ("-1", "0", "1A", "1B", "2A", "2B", "3A", "3B")
AVERAGING_HOURS = (1, 3)
DAY_SLOTS = (276, 288, 300)
LISTED = "not is_inferred"

# Age of the newest load at which a source is late (warn, error).
FRESHNESS = {
    "air_stations": (timedelta(days=2), timedelta(days=7)),
    "air_history": (timedelta(hours=6), timedelta(hours=24)),
    "bike_counters": (timedelta(days=2), timedelta(days=7)),
    "bike_detections": (timedelta(hours=12), timedelta(hours=48)),
    "city_districts": (timedelta(days=2), timedelta(days=7)),
    "energy_prices": (timedelta(hours=36), timedelta(hours=72)),
    "energy_load": (timedelta(hours=36), timedelta(hours=72)),
    "fx_daily": (timedelta(days=4), timedelta(days=7)),
    "weather_hourly": (timedelta(hours=36), timedelta(hours=72)),
}

BRONZE_CHECKS = [
    *bind("air_stations", not_null("id")),
    *bind("air_history", not_null("id", "updated_at")),
    *bind("bike_counters", not_null("id")),
    *bind("bike_detections", not_null("locations_id", "id", "measured_from")),
    *bind("city_districts", not_null("slug")),
    *bind("fx_daily", not_null("currencyCode", "validFor")),
    *bind("energy_prices", not_null("ts_utc")),
    *bind("energy_load", not_null("ts_utc")),
    *bind("weather_hourly", not_null("station_id", "time")),
]

SILVER_CHECKS = [
    *bind(
        "silver_air_stations",
        unique("station_id"),
        not_null("station_id", "is_inferred", "is_listed"),
        not_null(
            "station_name", "district_slug", "latitude", "longitude", "first_seen_date", "last_listed_date", where=LISTED
        ),
        relationship("district_slug", "silver_city_districts", "district_slug"),
    ),
    *bind(
        "silver_air_measurements",
        unique_together("station_id", "measured_hour_start_ts_utc", "pollutant"),
        not_null(
            "station_id", "measured_hour_start_ts_utc", "pollutant", "value_ugm3", "averaging_hours", "published_ts_utc"
        ),
        relationship("station_id", "silver_air_stations", "station_id"),
        accepted_values("pollutant", POLLUTANTS, WARN),
        accepted_values("averaging_hours", AVERAGING_HOURS, WARN),
        accepted_values("aq_hourly_index", AIR_QUALITY_INDEX, WARN),
    ),
    *bind(
        "silver_city_districts",
        unique("district_id", "district_slug"),
        not_null(
            "district_id",
            "district_slug",
            "district_name",
            "geometry_geojson",
            "first_seen_date",
            "last_listed_date",
            "is_listed",
        ),
    ),
    *bind(
        "silver_bike_counters",
        unique("counter_id"),
        not_null("counter_id", "is_inferred", "is_listed"),
        not_null(
            "counter_name", "district_slug", "latitude", "longitude", "first_seen_date", "last_listed_date", where=LISTED
        ),
        relationship("district_slug", "silver_city_districts", "district_slug"),
    ),
    *bind(
        "silver_bike_directions",
        unique_together("counter_id", "direction_id"),
        not_null("counter_id", "direction_id", "direction_name"),
        relationship("counter_id", "silver_bike_counters", "counter_id"),
    ),
    *bind(
        "silver_bike_detections",
        unique_together("counter_id", "direction_id", "interval_start_ts_utc"),
        not_null("counter_id", "direction_id", "interval_start_ts_utc", "interval_end_ts_utc"),
        relationship("counter_id", "silver_bike_counters", "counter_id"),
        accepted_range("bike_count", low=0, severity=WARN),
        accepted_range("pedestrian_count", low=0, severity=WARN),
    ),
    *bind(
        "silver_fx_rates_daily",
        unique_together("calendar_date", "currency_code"),
        not_null("calendar_date", "currency_code", "rate_date", "rate_czk_per_unit", "is_forward_filled"),
        accepted_range("rate_czk_per_unit", low=0, inclusive=False, severity=WARN),
    ),
    *bind(
        "silver_prices_hourly",
        unique("hour_start_ts_utc"),
        not_null("hour_start_ts_utc", "price_eur_mwh", "n_intervals"),
        accepted_range("n_intervals", 1, 4),
    ),
    *bind(
        "silver_load_hourly",
        unique("hour_start_ts_utc"),
        not_null("hour_start_ts_utc", "load_mw", "n_intervals"),
        accepted_range("load_mw", low=0, severity=WARN),
        accepted_range("n_intervals", 1, 4),
    ),
    *bind(
        "silver_weather_hourly",
        unique_together("station_id", "hour_start_ts_utc"),
        not_null("station_id", "hour_start_ts_utc"),
        relationship("station_id", "silver_air_stations", "station_id"),
        accepted_range("relative_humidity_pct", 0, 100, severity=WARN),
        accepted_range("precipitation_mm", low=0, severity=WARN),
        accepted_range("wind_speed_kmh", low=0, severity=WARN),
        accepted_range("wind_direction_deg", 0, 360, severity=WARN),
    ),
    *bind("seed_holidays", unique("holiday_date"), not_null("holiday_date", "holiday_name")),
    *bind("snapshot_air_stations", unique("scd_id"), not_null("scd_id", "station_id")),
]

_IN_STATION = relationship("station_key", "dim_station", "station_key")
_IN_DISTRICT = relationship("district_key", "dim_district", "district_key")
_IN_CALENDAR = relationship("date_key", "dim_date", "date_key")

GOLD_CHECKS = [
    *bind("dim_date", unique("date_key", "date_day"), not_null("date_key", "date_day", "is_cz_public_holiday")),
    *bind(
        "dim_district",
        unique("district_key", "district_slug"),
        not_null("district_key", "district_slug", "district_name", "is_listed"),
    ),
    *bind(
        "dim_station",
        unique("station_key"),
        not_null(
            "station_key",
            "station_id",
            "district_key",
            "valid_from_ts_utc",
            "valid_to_ts_utc",
            "is_current",
            "is_listed",
            "is_inferred",
        ),
        _IN_DISTRICT,
    ),
    *bind(
        "dim_bike_counter",
        unique("counter_key", "counter_id"),
        not_null("counter_key", "counter_id", "district_key", "is_listed", "is_inferred"),
        _IN_DISTRICT,
    ),
    *bind(
        "fact_air_quality_hourly",
        unique_together("station_id", "hour_start_ts_utc", "pollutant"),
        not_null("station_id", "hour_start_ts_utc", "station_key", "district_key", "date_key", "value_ugm3"),
        no_time_gaps("hour_start_ts_utc", "station_id"),
        accepted_values("pollutant", POLLUTANTS, WARN),
        _IN_STATION,
        _IN_DISTRICT,
        _IN_CALENDAR,
        non_negative("value_ugm3"),
    ),
    *bind(
        "fact_weather_hourly",
        unique_together("station_id", "hour_start_ts_utc"),
        not_null("hour_start_ts_utc", "station_key", "district_key", "date_key"),
        no_time_gaps("hour_start_ts_utc", "station_id"),
        _IN_STATION,
        _IN_DISTRICT,
        _IN_CALENDAR,
        non_negative("precipitation_mm", "wind_speed_ms"),
    ),
    *bind(
        "fact_energy_price_hourly",
        unique("hour_start_ts_utc"),
        not_null("hour_start_ts_utc", "date_key", "price_eur_mwh", "eur_czk_rate", "price_czk_mwh"),
        no_time_gaps("hour_start_ts_utc"),
        _IN_CALENDAR,
        non_negative("eur_czk_rate", "load_mw"),
    ),
    *bind(
        "fact_bike_traffic_daily",
        unique_together("counter_id", "direction_id", "local_date"),
        not_null("counter_key", "district_key", "date_key", "direction_name", "expected_slots"),
        relationship("counter_key", "dim_bike_counter", "counter_key"),
        _IN_DISTRICT,
        _IN_CALENDAR,
        non_negative("bike_count", "pedestrian_count"),
        accepted_values("expected_slots", DAY_SLOTS),
    ),
    *bind(
        "mart_air_vs_energy_daily",
        unique_together("district_key", "date_key"),
        not_null("district_key", "date_key", "n_aq_stations"),
        _IN_DISTRICT,
        _IN_CALENDAR,
        non_negative("avg_pm2_5_ugm3", "avg_pm10_ugm3"),
        accepted_values("aq_averaging_hours", AVERAGING_HOURS, WARN),
    ),
]


def inferred_members(stations, counters):
    """Members only the facts know, of both references."""
    parts = [
        df.filter("is_inferred").select(F.lit(kind).alias("reference"), F.col(key).alias("member_id"))
        for kind, df, key in (("station", stations, "station_id"), ("counter", counters, "counter_id"))
    ]
    return parts[0].unionByName(parts[1])


def singular_checks(as_of: date) -> list[Check]:
    """Checks that are a query of their own."""
    return [
        Check(
            "silver_fx_rates_daily",
            "eur_rate_every_day",
            failing=lambda t: days_without(
                t["silver_fx_rates_daily"],
                "calendar_date",
                (F.col("currency_code") == "EUR") & F.col("rate_czk_per_unit").isNotNull(),
            ),
        ),
        Check(
            "dim_station",
            "versions_do_not_overlap",
            failing=lambda t: overlapping_versions(t["dim_station"], "station_id", "station_key"),
        ),
        Check(
            "silver_air_stations",
            "no_inferred_members",
            WARN,
            failing=lambda t: inferred_members(t["silver_air_stations"], t["silver_bike_counters"]),
        ),
        Check(
            "seed_holidays",
            "holidays_cover_next_year",
            WARN,
            failing=lambda t: short_horizon(t["seed_holidays"], "holiday_date", as_of),
        ),
    ]


def all_checks(as_of: date) -> list[Check]:
    return [*BRONZE_CHECKS, *SILVER_CHECKS, *GOLD_CHECKS, *singular_checks(as_of)]
