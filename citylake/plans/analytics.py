"""Questions on the gold layer. Every function returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.columns import in_list
from citylake.operators.joins import outer_merge, semi
from citylake.operators.ordered import rolling_mean
from citylake.operators.stats import correlations, exact_quantiles, growth, pivot_wide

# Pollutants on offer with their mart column, drivers with their label, window lengths.
POLLUTANT_COLUMN = {"PM10": "avg_pm10_ugm3", "NO2": "avg_no2_ugm3", "PM2_5": "avg_pm2_5_ugm3"}
DRIVERS = {
    "avg_price_eur_mwh": "Day-ahead price",
    "avg_load_mw": "Electricity load",
    "avg_wind_speed_ms": "Wind speed",
    "avg_temperature_c": "Temperature",
    "precipitation_mm": "Precipitation",
}
GROWTH_ROWS = 28
ROLLING_ROWS = 7
MIN_CORRELATION_DAYS = 14


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _within(start: date, end: date) -> Column:
    """Local-day period on a fact: facts are partitioned by this key, so it prunes directories."""
    return F.col("date_key").between(_key(start), _key(end))


def date_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))


def districts_with_data(districts: DataFrame, mart: DataFrame, bikes: DataFrame) -> DataFrame:
    used = mart.select("district_key").union(bikes.select("district_key")).distinct()
    found = semi(districts, used, "district_key").select("district_slug", "district_name").distinct()
    return found.orderBy("district_name")


def district_daily(mart: DataFrame, start: date, end: date, districts: Sequence[str] = ()) -> DataFrame:
    period = _within(start, end) & in_list("district_slug", districts)
    return mart.filter(period).orderBy("date_day", "district_name")


def station_pollution(air: DataFrame, stations: DataFrame, start: date, end: date, pollutant: str) -> DataFrame:
    """Current stations with their level in the period; stations without data keep zero hours."""
    stats = (
        air.filter((F.col("pollutant") == pollutant) & _within(start, end))
        .groupBy("station_id")
        .agg(
            F.avg("value_ugm3").alias("mean_ugm3"),
            F.max("value_ugm3").alias("max_ugm3"),
            F.count("*").alias("n_hours"),
        )
    )
    current = stations.filter("is_current and latitude is not null")
    return (
        current.select("station_id", "station_name", "district_slug", "latitude", "longitude")
        .join(stats, "station_id", "left")
        .withColumn("n_hours", F.coalesce("n_hours", F.lit(0)))
        .orderBy("station_name")
    )


def station_coverage(pollution: DataFrame) -> DataFrame:
    """How many of the stations have data."""
    return pollution.agg(F.count("mean_ugm3").alias("n_with_data"), F.count("*").alias("n_stations"))


def hourly_pollutant_wind(
    air: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    energy: DataFrame,
    start: date,
    end: date,
    pollutant: str,
    districts: Sequence[str] = (),
) -> DataFrame:
    """Station-hour level with the wind there and the price of the hour."""
    levels = air.filter((F.col("pollutant") == pollutant) & _within(start, end)).select(
        "station_id", "station_key", "hour_start_ts_utc", "hour_start_local", "value_ugm3"
    )
    versions = stations.filter(in_list("district_slug", districts)).select("station_key", "station_name")
    wind = weather.filter(_within(start, end)).select("station_id", "hour_start_ts_utc", "wind_speed_ms")
    price = energy.filter(_within(start, end)).select("hour_start_ts_utc", "price_eur_mwh")
    return (
        levels.join(versions, "station_key")
        .join(wind, ["station_id", "hour_start_ts_utc"])
        .join(price, "hour_start_ts_utc")
        .select("station_id", "station_name", "hour_start_local", "value_ugm3", "wind_speed_ms", "price_eur_mwh")
    )


def daily_price(energy: DataFrame, start: date, end: date) -> DataFrame:
    return (
        energy.filter(_within(start, end))
        .groupBy(F.col("hour_start_local").cast("date").alias("date_day"))
        .agg(
            F.avg("price_eur_mwh").alias("price_eur_mwh"),
            F.avg("price_czk_mwh").alias("price_czk_mwh"),
            F.min("price_eur_mwh").alias("min_price_eur_mwh"),
            F.max("price_eur_mwh").alias("max_price_eur_mwh"),
            F.avg("load_mw").alias("load_mw"),
        )
        .orderBy("date_day")
    )


def _complete_sum(joined: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Bike sums of groups in which every row is a complete day."""
    return (
        joined.groupBy(*keys, F.col("local_date").alias("date_day"))
        .agg(F.sum("bike_count").alias("bikes"), *more, F.bool_and("is_complete_day").alias("_complete"))
        .filter("_complete and bikes is not null")
        .drop("_complete")
    )


def bike_daily(bikes: DataFrame, districts: DataFrame, start: date, end: date) -> DataFrame:
    """Bicycles per district and day. Counts meet the district names after they are summed per counter."""
    per_counter = (
        bikes.filter(_within(start, end))
        .groupBy("district_key", "counter_id", "local_date")
        .agg(F.sum("bike_count").alias("bike_count"), F.bool_and("is_complete_day").alias("is_complete_day"))
    )
    named = per_counter.join(districts.select("district_key", "district_slug", "district_name"), "district_key")
    result = _complete_sum(named, ["district_slug", "district_name"], F.count("counter_id").alias("n_counters"))
    return result.orderBy("district_slug", "date_day")


def bike_counter_daily(
    bikes: DataFrame, counters: DataFrame, districts: DataFrame, start: date, end: date
) -> DataFrame:
    names = counters.select("counter_key", F.col("counter_id").alias("_id"), "counter_name", F.col("district_key").alias("_d"))
    joined = (
        bikes.filter(_within(start, end))
        .join(names, "counter_key")
        .join(districts.select(F.col("district_key").alias("_d"), "district_name"), "_d")
    )
    result = _complete_sum(joined, ["_id", "counter_name", "district_name"]).withColumnRenamed("_id", "counter_id")
    return result.orderBy("counter_id", "date_day")


def freshness(air: DataFrame, energy: DataFrame, weather: DataFrame, bikes: DataFrame) -> DataFrame:
    """Newest instant of each dataset."""
    newest = [
        ("Air quality", air, F.max("published_ts_utc")),
        ("Electricity price", energy, F.max("hour_start_ts_utc")),
        ("Weather", weather, F.max("hour_start_ts_utc")),
        ("Bicycle counters", bikes, F.max("local_date").cast("timestamp")),
    ]
    parts = [df.agg(latest.alias("latest_utc")).select(F.lit(name).alias("dataset"), "latest_utc")
             for name, df, latest in newest]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


def daily_pollution(daily: DataFrame, pollutant: str) -> DataFrame:
    """Mean of the district means per day; each district with data counts once."""
    column = POLLUTANT_COLUMN[pollutant]
    return (
        daily.filter(F.col(column).isNotNull())
        .groupBy("date_day")
        .agg(F.avg(column).alias("value_ugm3"), F.countDistinct("district_slug").alias("n_districts"))
        .orderBy("date_day")
    )


def district_correlations(daily: DataFrame, pollutant: str, min_days: int = MIN_CORRELATION_DAYS) -> DataFrame:
    result = correlations(daily, ["district_slug", "district_name"], POLLUTANT_COLUMN[pollutant], DRIVERS, min_days)
    return result.withColumnRenamed("n_rows", "n_days")


def correlation_heat_table(result: DataFrame) -> DataFrame:
    """District x driver grid of r, districts in descending order."""
    return pivot_wide(result, "district_name", "driver", list(DRIVERS.values()), "r").orderBy(F.desc("district_name"))


def rolling_bike_traffic(daily: DataFrame, window: int = ROLLING_ROWS) -> DataFrame:
    return rolling_mean(daily, "district_slug", "date_day", "bikes", window, "bikes_rolling")


def bike_growth(
    daily: DataFrame, window: int = GROWTH_ROWS, group_cols: Sequence[str] = ("district_slug", "district_name")
) -> DataFrame:
    counter = "n_counters" if "n_counters" in daily.columns else None
    return growth(daily, group_cols, "date_day", "bikes", window, counter)


def top_growing(result: DataFrame, n: int = 3) -> DataFrame:
    """Districts to highlight when none is chosen."""
    return result.orderBy(F.desc("growth_pct"), "district_slug").limit(n)


def pollution_and_price(pollution: DataFrame, price: DataFrame) -> DataFrame:
    return outer_merge(pollution, price, "date_day")


def colour_bounds(hourly: DataFrame, value: str = "price_eur_mwh") -> DataFrame:
    """5 % and 95 % quantile: rare spikes should not squeeze the scale."""
    return exact_quantiles(hourly, value, [0.05, 0.95])


def kpis(pollution: DataFrame, price: DataFrame, bikes: DataFrame) -> DataFrame:
    """One row; empty inputs give nulls and zero negative-price days."""
    air = pollution.agg(F.avg("value_ugm3").alias("pollutant_mean"), F.max("value_ugm3").alias("pollutant_max_day"))
    money = price.agg(
        F.avg("price_eur_mwh").alias("price_mean_eur"),
        F.avg("price_czk_mwh").alias("price_mean_czk"),
        F.count_if(F.col("min_price_eur_mwh") < 0).alias("negative_price_days"),
    )
    per_day = bikes.groupBy("date_day").agg(F.coalesce(F.sum("bikes"), F.lit(0)).alias("bikes"))
    traffic = per_day.agg(F.avg("bikes").alias("bikes_per_day"))

    def packed(df: DataFrame) -> Column:
        return df.select(F.struct(*df.columns).alias("s")).scalar()

    row = pollution.sparkSession.range(1).select(
        packed(air).alias("a"), packed(money).alias("m"), packed(traffic).alias("t")
    )
    return row.select("a.*", "m.*", "t.*")
