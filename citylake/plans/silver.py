"""Bronze to silver: typed, de-duplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citylake.functions.columns import rounded_int
from citylake.functions.geo import point_lon_lat
from citylake.functions.json import strict_json
from citylake.functions.time import hour_start, instant, local_ts, span
from citylake.operators.dedup import latest_version, latest_wins
from citylake.operators.fill import dense_forward_fill
from citylake.operators.resample import hourly_statistics
from citylake.operators.scd2 import add_inferred
from citylake.operators.spatial import spatial_join

MEASUREMENT = "struct<AQ_hourly_index:string,components:array<struct<type:string,averaged_time:struct<averaged_hours:string,value:double>>>>"
DIRECTIONS = "array<struct<id:string,name:string>>"


def _inferred_flags():
    return {"is_listed": F.lit(False), "is_inferred": F.lit(True)}


def city_districts(bronze: DataFrame) -> DataFrame:
    rows = bronze.select("id", "name", "slug", "updated_at", "geometry", "_loaded_at", "load_date")
    return latest_version(rows, "id").select(
        F.col("id").cast("int").alias("district_id"),
        F.col("name").alias("district_name"),
        F.col("slug").alias("district_slug"),
        F.col("geometry").alias("geometry_geojson"),
        instant("updated_at").alias("source_updated_ts_utc"),
        "first_seen_date",
        "last_listed_date",
        "is_listed",
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )


def air_stations(bronze: DataFrame, history: DataFrame) -> DataFrame:
    """Every station ever listed, plus stations only the measurement history knows."""
    rows = bronze.select("id", "name", "district", "updated_at", "geometry", "_loaded_at", "load_date")
    lon, lat = point_lon_lat("geometry")
    listed = latest_version(rows, "id").select(
        F.col("id").alias("station_id"),
        F.col("name").alias("station_name"),
        F.col("district").alias("district_slug"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        instant("updated_at").alias("source_updated_ts_utc"),
        "first_seen_date",
        "last_listed_date",
        "is_listed",
        F.lit(False).alias("is_inferred"),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    return add_inferred(listed, history, "station_id", "id", _inferred_flags())


def air_measurements(history: DataFrame) -> DataFrame:
    """Station x measured hour x pollutant.

    A publication belongs to the hour that ended when its own hour began; the latest publication of that hour
    wins, and only then are its components exploded.
    """
    published = history.select(
        F.col("id").alias("station_id"),
        instant("updated_at").alias("published_ts_utc"),
        "measurement",
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    ).withColumn("measured_hour_start_ts_utc", hour_start("published_ts_utc") - span(1, "hour"))
    latest = latest_wins(
        published, ["station_id", "measured_hour_start_ts_utc"], ["published_ts_utc", "loaded_at_ts_utc"]
    )
    parsed = latest.withColumn("_m", strict_json("measurement", MEASUREMENT, "station_id")).withColumn(
        "_c", F.explode("_m.components")
    )
    return parsed.select(
        "station_id",
        "measured_hour_start_ts_utc",
        F.col("_c.type").alias("pollutant"),
        F.col("_c.averaged_time.value").alias("value_ugm3"),
        F.col("_c.averaged_time.averaged_hours").cast("int").alias("averaging_hours"),
        F.col("_m.AQ_hourly_index").alias("aq_hourly_index"),
        local_ts("measured_hour_start_ts_utc").alias("measured_hour_start_local"),
        "published_ts_utc",
        "loaded_at_ts_utc",
    )


def bike_counters(bronze: DataFrame, detections: DataFrame, districts: DataFrame, cell: float = 0.01) -> DataFrame:
    """Every counter ever listed with the district that contains it, plus counters only seen in detections."""
    rows = bronze.select("id", "name", "route", "updated_at", "geometry", "_loaded_at", "load_date")
    lon, lat = point_lon_lat("geometry")
    located = latest_version(rows, "id").withColumns({"longitude": lon, "latitude": lat})
    placed = spatial_join(located, districts.select("district_slug", "geometry_geojson"), cell=cell)
    listed = placed.select(
        F.col("id").alias("counter_id"),
        F.col("name").alias("counter_name"),
        F.col("route").alias("cycle_route"),
        "latitude",
        "longitude",
        "district_slug",
        instant("updated_at").alias("source_updated_ts_utc"),
        "first_seen_date",
        "last_listed_date",
        "is_listed",
        F.lit(False).alias("is_inferred"),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    return add_inferred(listed, detections, "counter_id", "locations_id", _inferred_flags())


def bike_directions(bronze: DataFrame) -> DataFrame:
    """Directions of the latest catalogue entry of every counter; placeholders without an id are dropped."""
    latest = latest_version(bronze.select("id", "directions", "_loaded_at", "load_date"), "id")
    pairs = latest.select(F.col("id").alias("counter_id"), F.explode(strict_json("directions", DIRECTIONS, "id")).alias("d"))
    return pairs.select(
        "counter_id", F.col("d.id").alias("direction_id"), F.col("d.name").alias("direction_name")
    ).filter("direction_id is not null")


def bike_detections(bronze: DataFrame) -> DataFrame:
    """Counter x direction x five-minute slot."""
    typed = bronze.select(
        F.col("locations_id").alias("counter_id"),
        F.col("id").alias("direction_id"),
        instant("measured_from").alias("interval_start_ts_utc"),
        instant("measured_to").alias("interval_end_ts_utc"),
        rounded_int("value").alias("bike_count"),
        rounded_int("value_pedestrians").alias("pedestrian_count"),
        rounded_int("measurement_count").alias("measurement_count"),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    return latest_wins(typed, ["counter_id", "direction_id", "interval_start_ts_utc"], ["loaded_at_ts_utc"])


def _energy_hourly(bronze: DataFrame, name: str) -> DataFrame:
    typed = bronze.select(
        F.col("ts_utc").cast("timestamp").alias("ts_utc"),
        F.col("value").cast("double").alias(name),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    points = latest_wins(typed, "ts_utc", ["loaded_at_ts_utc"])
    return hourly_statistics(points, [], "ts_utc", name, "loaded_at_ts_utc").withColumn(
        "hour_start_local", local_ts("hour_start_ts_utc")
    )


def prices_hourly(bronze: DataFrame) -> DataFrame:
    return _energy_hourly(bronze, "price_eur_mwh").select(
        "hour_start_ts_utc",
        "hour_start_local",
        "price_eur_mwh",
        "min_price_eur_mwh",
        "max_price_eur_mwh",
        "n_intervals",
        "loaded_at_ts_utc",
    )


def load_hourly(bronze: DataFrame) -> DataFrame:
    return _energy_hourly(bronze, "load_mw").select(
        "hour_start_ts_utc", "hour_start_local", "load_mw", "n_intervals", "loaded_at_ts_utc"
    )


def fx_rates_daily(bronze: DataFrame) -> DataFrame:
    """Calendar day x currency, per one unit; days without a table repeat the last one."""
    typed = bronze.select(
        F.col("load_date").alias("calendar_date"),
        F.col("currencyCode").alias("currency_code"),
        F.col("validFor").cast("date").alias("rate_date"),
        F.try_divide(F.col("rate").cast("double"), F.col("amount").cast("double")).alias("rate_czk_per_unit"),
        F.col("amount").cast("int").alias("quoted_amount"),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    rates = latest_wins(typed, ["calendar_date", "currency_code"], ["loaded_at_ts_utc"])
    return dense_forward_fill(rates, "currency_code", "calendar_date")


def weather_hourly(bronze: DataFrame) -> DataFrame:
    """Station x hour; wind also in m/s."""
    kmh = F.col("wind_speed_10m").cast("double")
    typed = bronze.select(
        "station_id",
        instant("time").alias("hour_start_ts_utc"),
        F.col("temperature_2m").cast("double").alias("temperature_c"),
        F.col("relative_humidity_2m").cast("double").alias("relative_humidity_pct"),
        F.col("precipitation").cast("double").alias("precipitation_mm"),
        kmh.alias("wind_speed_kmh"),
        (kmh / 3.6).alias("wind_speed_ms"),
        F.col("wind_direction_10m").cast("double").alias("wind_direction_deg"),
        F.col("latitude").cast("double").alias("grid_latitude"),
        F.col("longitude").cast("double").alias("grid_longitude"),
        F.col("elevation").cast("double").alias("grid_elevation_m"),
        F.col("_loaded_at").alias("loaded_at_ts_utc"),
    )
    latest = latest_wins(typed, ["station_id", "hour_start_ts_utc"], ["loaded_at_ts_utc"])
    return latest.withColumn("hour_start_local", local_ts("hour_start_ts_utc"))
