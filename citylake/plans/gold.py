"""Silver to gold: dimensions, facts and the district-by-day mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citylake.functions.exact import exact_avg, exact_parts, exact_ratio, exact_sum
from citylake.functions.keys import surrogate_key
from citylake.functions.time import calendar_parts, date_key, date_spine, local_date, local_day_bounds
from citylake.operators.incremental import LOOKBACK_DAYS, Days, lookback, lookback_bound
from citylake.operators.dedup import latest_value
from citylake.operators.joins import interval_join
from citylake.operators.resample import rollup_local_day
from citylake.operators.scd2 import add_unknown, lookup, scd2_dimension

# The unknown member, the first calendar day, and what makes a new station version.
UNKNOWN_KEY = "-1"
CALENDAR_START = date(2025, 1, 1)
STATION_CHECKED = ("station_name", "district_slug", "latitude", "longitude", "is_listed")
STATION_ATTRIBUTES = (*STATION_CHECKED, "is_inferred")
HOME_CURRENCY_SOURCE = "EUR"

# Facts are stored by local day, a function of their key that grows with time.
PARTITION = "date_key"
# Silver series are stored by the day of their bronze partition.
SILVER_DAY = "bronze_day"
FACT_KEYS = {
    "fact_air_quality_hourly": ("station_id", "hour_start_ts_utc", "pollutant"),
    "fact_weather_hourly": ("station_id", "hour_start_ts_utc"),
    "fact_energy_price_hourly": ("hour_start_ts_utc",),
    "fact_bike_traffic_daily": ("counter_id", "direction_id", "local_date"),
}


def dim_date(
    spark: SparkSession, holidays: DataFrame, as_of: date, start: date = CALENDAR_START
) -> DataFrame:
    """Calendar up to the end of the year after `as_of`."""
    days = date_spine(spark, start, date(as_of.year + 2, 1, 1))
    parts = calendar_parts("date_day")
    is_weekend = parts["iso_day_of_week"].isin(6, 7)
    is_holiday = F.col("holiday_date").isNotNull()
    return days.join(holidays, F.col("date_day") == F.col("holiday_date"), "left").select(
        date_key("date_day").alias("date_key"),
        "date_day",
        *[column.cast("int" if name != "day_name" else "string").alias(name) for name, column in parts.items()],
        is_weekend.alias("is_weekend"),
        is_holiday.alias("is_cz_public_holiday"),
        "holiday_name",
        (~is_weekend & ~is_holiday).alias("is_working_day"),
    )


def dim_district(districts: DataFrame) -> DataFrame:
    known = districts.select(
        surrogate_key("district_slug").alias("district_key"),
        "district_id",
        "district_slug",
        "district_name",
        "geometry_geojson",
        "is_listed",
    )
    return add_unknown(
        known,
        {"district_key": UNKNOWN_KEY, "district_slug": "unknown", "district_name": "Unknown", "is_listed": True},
    )


def _with_district(df: DataFrame, districts: DataFrame) -> DataFrame:
    return lookup(df, districts, "district_slug", ["district_key"], {"district_key": UNKNOWN_KEY})


def dim_bike_counter(counters: DataFrame, districts: DataFrame) -> DataFrame:
    return _with_district(counters, districts).select(
        surrogate_key("counter_id").alias("counter_key"),
        "counter_id",
        "counter_name",
        "cycle_route",
        "district_key",
        "district_slug",
        "latitude",
        "longitude",
        "is_listed",
        "is_inferred",
        "source_updated_ts_utc",
    )


def dim_station(snapshot: DataFrame, districts: DataFrame) -> DataFrame:
    """SCD2 station versions. Snapshot rows from before the flags existed count as listed and not inferred."""
    rows = snapshot.withColumn("is_listed", F.coalesce("is_listed", F.lit(True))).withColumn(
        "is_inferred", F.coalesce("is_inferred", F.lit(False))
    )
    versions = scd2_dimension(rows, "station_id", STATION_ATTRIBUTES)
    return _with_district(versions, districts).select(
        F.col("scd_id").alias("station_key"),
        "station_id",
        "station_name",
        "district_key",
        "district_slug",
        "latitude",
        "longitude",
        "is_listed",
        "is_inferred",
        "valid_from_ts_utc",
        "valid_to_ts_utc",
        "is_current",
    )


def _at_station(df: DataFrame, stations: DataFrame, ts: str) -> DataFrame:
    """Station version and district valid at the hour."""
    versions = stations.select("station_id", "station_key", "district_key", "valid_from_ts_utc", "valid_to_ts_utc")
    return interval_join(df, versions, "station_id", ts).withColumn(
        "district_key", F.coalesce("district_key", F.lit(UNKNOWN_KEY))
    )


def _of_local_days(df: DataFrame, ts: str, changed: Days) -> DataFrame:
    """The rows of whole local days; silver days next to them can hold some, others are not read."""
    near = changed.of(df, SILVER_DAY, reach=1) if SILVER_DAY in df.columns else df
    return changed.of(near, local_date(ts))


def _recent(df: DataFrame, ts: str, target: DataFrame | None, days: int, changed: Days | None) -> DataFrame:
    """The rows a run has to process: those of the changed local days, or those since the lookback bound."""
    if changed is not None:
        return _of_local_days(df, ts, changed)
    return lookback(df, ts, target, "hour_start_ts_utc", days, PARTITION)


def fact_air_quality_hourly(
    measurements: DataFrame, stations: DataFrame, target: DataFrame | None = None, days: int = LOOKBACK_DAYS, changed: Days | None = None
) -> DataFrame:
    recent = _recent(measurements, "measured_hour_start_ts_utc", target, days, changed)
    return _at_station(recent, stations, "measured_hour_start_ts_utc").select(
        "station_id",
        F.col("measured_hour_start_ts_utc").alias("hour_start_ts_utc"),
        "pollutant",
        "station_key",
        "district_key",
        date_key(local_date("measured_hour_start_ts_utc")).alias("date_key"),
        F.col("measured_hour_start_local").alias("hour_start_local"),
        "value_ugm3",
        "averaging_hours",
        "aq_hourly_index",
        "published_ts_utc",
    )


def fact_weather_hourly(
    weather: DataFrame, stations: DataFrame, target: DataFrame | None = None, days: int = LOOKBACK_DAYS, changed: Days | None = None
) -> DataFrame:
    recent = _recent(weather, "hour_start_ts_utc", target, days, changed)
    return _at_station(recent, stations, "hour_start_ts_utc").select(
        "station_id",
        "hour_start_ts_utc",
        "station_key",
        "district_key",
        date_key(local_date("hour_start_ts_utc")).alias("date_key"),
        "hour_start_local",
        "temperature_c",
        "relative_humidity_pct",
        "precipitation_mm",
        "wind_speed_ms",
        "wind_speed_kmh",
        "wind_direction_deg",
    )


def convert_currency(
    df: DataFrame,
    rates: DataFrame,
    day: str,
    amount: str,
    rate_name: str = "eur_czk_rate",
    converted: str = "price_czk_mwh",
    estimated: str = "is_eur_rate_estimated",
) -> DataFrame:
    """Converts by the rate of the local day, or by the latest known one (flagged as estimated).

    `rates` is (calendar_date, rate). The latest rate is a scalar subquery; without any rate the rows stay
    and the not-null check on the result reports them.
    """
    latest = latest_value(rates, "rate", "calendar_date")
    per_day = rates.select(F.col("calendar_date").alias(day), F.col("rate").alias("_rate"))
    joined = df.join(per_day, day, "left")
    return (
        joined.withColumn(rate_name, F.coalesce("_rate", latest))
        .withColumn(estimated, F.col("_rate").isNull())
        .withColumn(converted, F.col(amount) * F.col(rate_name))
        .drop("_rate")
    )


def home_rates(fx: DataFrame) -> DataFrame:
    """(calendar_date, rate) of the currency prices are quoted in."""
    return fx.filter(F.col("currency_code") == HOME_CURRENCY_SOURCE).select("calendar_date", F.col("rate_czk_per_unit").alias("rate"))


def fact_energy_price_hourly(
    prices: DataFrame, load: DataFrame, fx: DataFrame, target: DataFrame | None = None, days: int = LOOKBACK_DAYS, changed: Days | None = None
) -> DataFrame:
    recent = _recent(prices, "hour_start_ts_utc", target, days, changed)
    if changed is not None:
        load = _of_local_days(load, "hour_start_ts_utc", changed)
    demand = load.select("hour_start_ts_utc", "load_mw", F.col("n_intervals").alias("n_load_intervals"))
    hourly = (
        recent.withColumnRenamed("n_intervals", "n_price_intervals")
        .join(demand, "hour_start_ts_utc", "left")
        .withColumn("local_date", local_date("hour_start_ts_utc"))
    )
    return convert_currency(hourly, home_rates(fx), "local_date", "price_eur_mwh").select(
        "hour_start_ts_utc",
        date_key("local_date").alias("date_key"),
        "hour_start_local",
        "price_eur_mwh",
        "min_price_eur_mwh",
        "max_price_eur_mwh",
        "eur_czk_rate",
        "is_eur_rate_estimated",
        "price_czk_mwh",
        "load_mw",
        "n_price_intervals",
        "n_load_intervals",
    )


def fact_bike_traffic_daily(
    detections: DataFrame,
    directions: DataFrame,
    counters: DataFrame,
    target: DataFrame | None = None,
    days: int = LOOKBACK_DAYS,
    changed: Days | None = None,
) -> DataFrame:
    """Counts per counter direction and local day.

    A direction missing from the catalogue of its counter takes the name another counter gives that id.
    """
    first_day = None if changed is not None else lookback_bound(target, "local_date", days, PARTITION)
    recent = detections if changed is None else _of_local_days(detections, "interval_start_ts_utc", changed)
    if first_day is not None:
        # Whole local days from a local midnight on, as a bound on the stored instant.
        recent = detections.filter(F.col("interval_start_ts_utc") >= local_day_bounds(F.lit(first_day))[0])
    daily = rollup_local_day(
        recent,
        ["counter_id", "direction_id"],
        "interval_start_ts_utc",
        [
            F.sum("bike_count").alias("bike_count"),
            F.sum("pedestrian_count").alias("pedestrian_count"),
            F.count("bike_count").alias("n_slots_with_bike_data"),
        ],
    )
    own = directions.select("counter_id", "direction_id", F.col("direction_name").alias("_own"), F.lit(True).alias("_listed"))
    shared = directions.groupBy("direction_id").agg(F.min("direction_name").alias("_shared"))
    members = counters.select("counter_id", "counter_key", "district_key")
    joined = (
        daily.join(members, "counter_id", "left")
        .join(own, ["counter_id", "direction_id"], "left")
        .join(shared, "direction_id", "left")
    )
    return joined.select(
        "counter_id",
        "direction_id",
        "local_date",
        "counter_key",
        F.coalesce("district_key", F.lit(UNKNOWN_KEY)).alias("district_key"),
        date_key("local_date").alias("date_key"),
        F.coalesce("_own", "_shared").alias("direction_name"),
        F.col("_listed").isNull().alias("is_direction_inferred"),
        "bike_count",
        "pedestrian_count",
        "n_slots",
        "n_slots_with_bike_data",
        "expected_slots",
        "is_complete_day",
    )


# Pollutants the mart reports, with their column.
MART_POLLUTANTS = {"PM2_5": "avg_pm2_5_ugm3", "PM10": "avg_pm10_ugm3", "NO2": "avg_no2_ugm3"}


def _air_daily(air: DataFrame) -> DataFrame:
    """District-day means, through station-day partial sums.

    Exact partial sums and counts add up again, so one pre-aggregation serves the means and the station count;
    a distinct count beside filtered averages would multiply the input rows instead.
    """
    partial: list[Column] = [F.max("averaging_hours").alias("aq_averaging_hours")]
    final: list[Column] = []
    for code, name in MART_POLLUTANTS.items():
        value = exact_parts("value_ugm3", F.col("pollutant") == code)
        partial += [
            F.sum(value.whole).alias(f"_w_{code}"), F.sum(value.units).alias(f"_u_{code}"), F.count(value.whole).alias(f"_n_{code}")
        ]
        final.append(exact_ratio(F.sum(f"_w_{code}"), F.sum(f"_u_{code}"), F.sum(f"_n_{code}")).alias(name))
    stations = air.groupBy("district_key", "date_key", "station_id").agg(*partial)
    return stations.groupBy("district_key", "date_key").agg(
        *final, F.count("station_id").alias("n_aq_stations"), F.max("aq_averaging_hours").alias("aq_averaging_hours")
    )


def _weather_daily(weather: DataFrame) -> DataFrame:
    """Mean over stations of the station means, and of the station rain sums."""
    means = ("temperature_c", "wind_speed_ms", "relative_humidity_pct")
    stations = weather.groupBy("station_id", "district_key", "date_key").agg(
        *[exact_avg(c).alias(f"avg_{c}") for c in means],
        exact_sum("precipitation_mm").alias("precipitation_mm"),
    )
    return stations.groupBy("district_key", "date_key").agg(
        *[exact_avg(f"avg_{c}").alias(f"avg_{c}") for c in means],
        exact_avg("precipitation_mm").alias("precipitation_mm"),
    )


def _energy_daily(energy: DataFrame) -> DataFrame:
    return energy.groupBy("date_key").agg(
        exact_avg("price_eur_mwh").alias("avg_price_eur_mwh"),
        exact_avg("price_czk_mwh").alias("avg_price_czk_mwh"),
        F.min("price_eur_mwh").alias("min_price_eur_mwh"),
        F.max("price_eur_mwh").alias("max_price_eur_mwh"),
        exact_avg("load_mw").alias("avg_load_mw"),
        F.count("*").alias("n_price_hours"),
    )


# What the mart takes from the dimensions.
MART_DISTRICT = ("district_key", "district_slug", "district_name")
MART_DATE = ("date_key", "date_day", "is_weekend", "is_cz_public_holiday")


def mart_air_vs_energy_daily(
    air: DataFrame, weather: DataFrame, energy: DataFrame, districts: DataFrame, dates: DataFrame, changed: Days | None = None
) -> DataFrame:
    """District x local day; days without air-quality rows do not appear. With `changed` only these days."""
    if changed is not None:
        air, weather, energy = (changed.of_keys(fact, PARTITION) for fact in (air, weather, energy))
    return (
        _air_daily(air)
        .join(_weather_daily(weather), ["district_key", "date_key"], "left")
        .join(_energy_daily(energy), "date_key", "left")
        .join(districts.select(*MART_DISTRICT), "district_key", "left")
        .join(dates.select(*MART_DATE), "date_key", "left")
        .select(
            "district_key",
            "date_key",
            "district_slug",
            "district_name",
            "date_day",
            "is_weekend",
            "is_cz_public_holiday",
            *MART_POLLUTANTS.values(),
            "n_aq_stations",
            "aq_averaging_hours",
            "avg_temperature_c",
            "avg_wind_speed_ms",
            "avg_relative_humidity_pct",
            "precipitation_mm",
            "avg_price_eur_mwh",
            "avg_price_czk_mwh",
            "min_price_eur_mwh",
            "max_price_eur_mwh",
            "avg_load_mw",
            "n_price_hours",
        )
    )
