"""City feeds derived from the test tables: the same bronze rows in Spark and in SQL.

Districts come from `nation`, stations and detections from `supplier`, counters from `customer`; publications,
weather, prices, load, exchange rates and a second feed of detections from `events`.
"""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from catalog.registry import FRAGMENTS, Tables, local
from citylake.operators.scd2 import snapshot_changes
from citylake.plans import gold, silver
from citylake.plans.snapshots import append_changes
from citylake.session import fresh_dir
from citylake.sources.landing import write_partitions

RUNS = (date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21))
HOLIDAYS = ((date(2024, 1, 1), "New year"), (date(2024, 1, 15), "Mid month"), (date(2024, 3, 29), "Good Friday"))
CALENDAR_START = date(2024, 1, 1)
AS_OF = date(2024, 6, 1)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Rows that one task makes of a feed.
TASK_ROWS = 250_000


def spread(df: DataFrame, key: str, made: int = 1) -> DataFrame:
    """The rows dealt over tasks by a unique key, so that each task makes about TASK_ROWS rows, `made` of every row.

    A table may be one file of one row group: it is read by one task, and all that is made of it would be that task's
    work, and its only block of every day that is written.
    """
    tasks = math.ceil(df.count() * made / TASK_ROWS)
    return df.repartition(tasks, key) if tasks > 1 else df


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(make, write):
    """Writes the table once per session and input folder, as the layered build does, and reads it from then on."""

    def read(t: Tables) -> DataFrame:
        key = (t.spark.sparkContext.applicationId, t.folder, make.__name__)
        if key not in _WRITTEN:
            path = fresh_dir(t.spark, make.__name__)
            write(make(t), path)
            _WRITTEN[key] = path
        return t.spark.read.parquet(_WRITTEN[key])

    read.__name__, read.make = make.__name__, make
    return read


def _layer(make):
    return _once(make, lambda df, path: df.write.parquet(path))


def _landed(make):
    """Bronze: one directory per day."""
    return _once(make, write_partitions)


@_landed
def city_districts(t: Tables) -> DataFrame:
    """Rectangles, every second one with a hole, and triangles in the last column of the grid."""
    k = "n_nationkey"
    x0, x1 = f"(140 + {k} % 5) / 10.0D", f"(141 + {k} % 5) / 10.0D"
    y0, y1 = f"(500 + {k} div 5) / 10.0D", f"(501 + {k} div 5) / 10.0D"
    hx0, hx1 = f"(1404 + 10 * ({k} % 5)) / 100.0D", f"(1406 + 10 * ({k} % 5)) / 100.0D"
    hy0, hy1 = f"(5004 + 10 * ({k} div 5)) / 100.0D", f"(5006 + 10 * ({k} div 5)) / 100.0D"

    def ring(*vertices: tuple[str, str]) -> str:
        return "array(" + ",".join(f"array({x},{y})" for x, y in vertices) + ")"

    outer = ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    hole = ring((hx0, hy0), (hx1, hy0), (hx1, hy1), (hx0, hy1), (hx0, hy0))
    triangle = ring((x0, y0), (x1, y0), (x0, y1), (x0, y0))
    rings = F.expr(f"case when {k} % 5 = 4 then array({triangle}) when {k} % 2 = 1 then array({outer}, {hole}) "
                   f"else array({outer}) end")
    rows = t.nation.withColumn("load_date", F.explode(F.array(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 15)))))
    return rows.filter("not (n_nationkey = 24 and load_date = date'2024-01-15')").select(
        F.col(k).alias("id"),
        F.col("n_name").alias("name"),
        F.format_string("d%d", k).alias("slug"),
        F.lit("2024-01-01T00:00:00.000Z").alias("updated_at"),
        F.to_json(F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))).alias("geometry"),
        F.col("load_date").cast("timestamp").alias("_loaded_at"),
        "load_date",
    )


def _point(x: str, y: str):
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(F.expr(x), F.expr(y)).alias("coordinates")))


POINT_X, POINT_Y = "14 + (({k} * 37) % 5200) / 10000.0D", "50 + (({k} * 61) % 5200) / 10000.0D"
SQL_X = "(14 + ((({k}) * 37) % 5200) / 10000.0::double)"
SQL_Y = "(50 + ((({k}) * 61) % 5200) / 10000.0::double)"


@_landed
def bike_counters(t: Tables) -> DataFrame:
    k = "c_custkey"
    rows = spread(t.customer, "c_custkey", 2).withColumn("load_date", F.explode(F.array(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 15)))))
    directions = F.array(
        F.struct(F.format_string("D%d", F.expr(f"{k} % 7")).alias("id"), F.format_string("to %d", F.expr(f"{k} % 70")).alias("name")),
        F.struct(F.lit(None).cast("string").alias("id"), F.lit("none").alias("name")),
    )
    return rows.filter("not (c_custkey % 11 = 0 and load_date = date'2024-01-15')").select(
        F.format_string("C%d", k).alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("route"),
        F.lit("2024-01-01T00:00:00.000Z").alias("updated_at"),
        F.to_json(directions, {"ignoreNullFields": "false"}).alias("directions"),
        _point(POINT_X.format(k=k), POINT_Y.format(k=k)).alias("geometry"),
        F.col("load_date").cast("timestamp").alias("_loaded_at"),
        "load_date",
    )


FIRST_SLOT = datetime(2024, 3, 29, 23)
SLOTS = 852


@_landed
def bike_detections(t: Tables) -> DataFrame:
    """Three local days of five-minute slots over the spring switch, with gaps and repeated slots."""
    start = F.lit(FIRST_SLOT) + F.expr("make_dt_interval(0, 0, slot * 5)")
    # The texts of a slot are made once, not for every detection in it.
    slots = t.spark.range(SLOTS).select(F.col("id").cast("int").alias("slot")).select(
        "slot",
        start.alias("start"),
        F.date_format(start, ISO).alias("measured_from"),
        F.date_format(start + F.expr("interval 5 minutes"), ISO).alias("measured_to"),
    )
    rows = (
        spread(t.supplier.select(F.col("s_suppkey").alias("s")), "s", SLOTS)
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
        .filter("not (s % 3 = 0 and (s div 20) % 2 = 0 and slot % 97 = s % 97)")
        .withColumn("again", F.explode(F.expr("case when slot % 25 = 0 then array(0, 1) else array(0) end")))
        .join(slots, "slot")
    )
    value = F.expr("case when (s + slot) % 50 = 0 then null else cast((s * 31 + slot * 7) % 40 + again as double) end")
    return rows.select(
        F.expr("case when s % 10 = 9 then concat('X', s) else concat('C', s) end").alias("locations_id"),
        F.expr("concat('D', case when s % 5 = 0 then (s + 1) % 7 else s % 7 end)").alias("id"),
        "measured_from",
        "measured_to",
        value.alias("value"),
        F.expr("case when s % 2 = 0 then cast(slot % 9 as double) end").alias("value_pedestrians"),
        F.lit(1).alias("measurement_count"),
        (F.col("start") + F.expr("make_dt_interval(0, 1 + again)")).alias("_loaded_at"),
        F.to_date("start").alias("load_date"),
    )


@_landed
def event_detections(t: Tables) -> DataFrame:
    """Every event is a detection at its user's counter, on a five-minute grid with the gaps and repeated slots the events have."""
    start = F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / 300) * 300)
    return spread(t.events, "event_id").select(
        F.format_string("C%d", "user_id").alias("locations_id"),
        F.expr("concat('D', case when user_id % 5 = 0 then (user_id + 1) % 7 else user_id % 7 end)").alias("id"),
        F.date_format(start, ISO).alias("measured_from"),
        F.date_format(start + F.expr("interval 5 minutes"), ISO).alias("measured_to"),
        F.expr("case when event_type <> 'error' then cast(floor(value) as double) end").alias("value"),
        F.expr("case when event_type = 'view' then cast(floor(value / 10) as double) end").alias("value_pedestrians"),
        F.lit(1).alias("measurement_count"),
        F.col("ts").alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


@_landed
def air_stations(t: Tables) -> DataFrame:
    """Three snapshots: renamed, moved and removed stations."""
    rows = spread(t.supplier, "s_suppkey", len(RUNS)).withColumn("load_date", F.explode(F.array(*[F.lit(d) for d in RUNS])))
    s = "s_suppkey"
    return rows.filter(f"not ({s} % 10 = 3 and load_date = date'2024-01-21')").select(
        F.format_string("S%d", s).alias("id"),
        F.expr(f"case when {s} % 7 = 0 and load_date > date'2024-01-01' then concat(s_name, ' new') else s_name end").alias("name"),
        F.expr(f"concat('d', case when {s} % 13 = 0 and load_date > date'2024-01-11' then (s_nationkey + 1) % 25 else s_nationkey end)").alias("district"),
        F.lit("2024-01-01T00:00:00.000Z").alias("updated_at"),
        F.lit(None).cast("string").alias("measurement"),
        _point(POINT_X.format(k=s), POINT_Y.format(k=s)).alias("geometry"),
        F.col("load_date").cast("timestamp").alias("_loaded_at"),
        "load_date",
    )


@_landed
def air_history(t: Tables) -> DataFrame:
    def component(code: str, value: str) -> str:
        hours = "case when ts < timestamp'2024-01-10 00:00:00' then '3' else '1' end"
        return f"named_struct('type','{code}','averaged_time',named_struct('averaged_hours',{hours},'value',{value}))"

    components = F.expr(
        "filter(array("
        + component("PM10", "value") + ","
        + "case when event_type <> 'error' then " + component("NO2", "value * 2") + " end,"
        + "case when event_id % 3 = 0 then " + component("PM2_5", "value / 2") + " end), c -> c is not null)"
    )
    index = F.expr("case event_type when 'view' then '1A' when 'click' then '1B' when 'error' then '0' else '2A' end")
    return spread(t.events, "event_id").select(
        F.format_string("S%d", "user_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("updated_at"),
        F.to_json(F.struct(index.alias("AQ_hourly_index"), components.alias("components"))).alias("measurement"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


@_landed
def weather_hourly(t: Tables) -> DataFrame:
    return spread(t.events, "event_id").select(
        F.format_string("S%d", "user_id").alias("station_id"),
        F.lit(14.0).alias("requested_latitude"),
        F.lit(50.0).alias("requested_longitude"),
        F.lit(14.0).alias("latitude"),
        F.lit(50.0).alias("longitude"),
        F.lit(200.0).alias("elevation"),
        F.lit("UTC").alias("timezone"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.expr("value / 5").alias("temperature_2m"),
        F.expr("cast(event_id % 101 as double)").alias("relative_humidity_2m"),
        F.expr("case when event_id % 4 = 0 then value / 100 else 0D end").alias("precipitation"),
        F.expr("value / 3").alias("wind_speed_10m"),
        F.expr("cast((event_id * 7) % 361 as double)").alias("wind_direction_10m"),
        F.lit("{}").alias("hourly_units"),
        F.col("ts").alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


def _quarter(ts: str):
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / 900) * 900)


@_landed
def energy_prices(t: Tables) -> DataFrame:
    return spread(t.events, "event_id").select(
        _quarter("ts").alias("ts_utc"),
        F.expr("value - 20").alias("value"),
        F.lit("EUR/MWh").alias("unit"),
        F.lit("area").alias("area_code"),
        F.col("ts").alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


@_landed
def energy_load(t: Tables) -> DataFrame:
    return spread(t.events, "event_id").select(
        _quarter("ts").alias("ts_utc"),
        F.expr("value * 100").alias("value"),
        F.lit("MW").alias("unit"),
        F.lit("area").alias("area_code"),
        F.col("ts").alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


# On every sixth day of the month and after the 27th all rates are of two more currencies: the others have gaps there.
CURRENCY = ("case when day(ts) % 6 = 5 or day(ts) > 27 then case when event_type in ('purchase', 'error') then 'SEK' else 'CHF' end "
            "when event_type = 'view' then 'EUR' when event_type = 'click' then 'USD' "
            "when event_type = 'purchase' then 'JPY' when event_type = 'error' then 'HUF' else 'GBP' end")


@_landed
def fx_daily(t: Tables) -> DataFrame:
    """One table per day; every event is a rate."""
    return spread(t.events, "event_id").select(
        F.date_format("ts", "yyyy-MM-dd").alias("validFor"),
        F.lit(1).alias("order"),
        F.lit("x").alias("country"),
        F.lit("x").alias("currency"),
        F.expr("case when event_type in ('purchase', 'error') then 100 else 1 end").alias("amount"),
        F.expr(CURRENCY).alias("currencyCode"),
        F.expr("20 + value / 10").alias("rate"),
        F.col("ts").alias("_loaded_at"),
        F.to_date("ts").alias("load_date"),
    )


def bronze(t: Tables) -> dict[str, DataFrame]:
    makers = (air_stations, air_history, bike_counters, bike_detections, city_districts, energy_prices, energy_load,
              fx_daily, weather_hourly)
    return {make.__name__: make(t) for make in makers}


def holidays(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(list(HOLIDAYS), "holiday_date date, holiday_name string")


# ---------------------------------------------------------------- silver and gold over the feeds

@_layer
def s_districts(t):
    return silver.city_districts(city_districts(t))


@_layer
def s_stations(t):
    return silver.air_stations(air_stations(t), air_history(t))


@_layer
def s_counters(t):
    return silver.bike_counters(bike_counters(t), bike_detections(t), s_districts(t), cell=0.02)


def station_snapshot(t: Tables) -> DataFrame:
    """Snapshot table after one run per station list."""
    path = fresh_dir(t.spark, "snapshot")
    history = None
    for run in RUNS:
        seen = silver.air_stations(air_stations(t).filter(F.col("load_date") <= F.lit(run)), air_history(t))
        stamp = datetime(run.year, run.month, run.day)
        changes = snapshot_changes(history, seen, "station_id", gold.STATION_CHECKED, stamp)
        history = append_changes(t.spark, path, changes, stamp)
    return history


@_layer
def g_date(t):
    return gold.dim_date(t.spark, holidays(t), AS_OF, CALENDAR_START)


@_layer
def g_district(t):
    return gold.dim_district(s_districts(t))


@_layer
def g_station(t):
    return gold.dim_station(station_snapshot(t), g_district(t))


@_layer
def g_counter(t):
    return gold.dim_bike_counter(s_counters(t), g_district(t))


def plan_air(t):
    return gold.fact_air_quality_hourly(silver.air_measurements(air_history(t)), g_station(t))


def plan_weather(t):
    return gold.fact_weather_hourly(silver.weather_hourly(weather_hourly(t)), g_station(t))


def plan_energy(t):
    return gold.fact_energy_price_hourly(
        silver.prices_hourly(energy_prices(t)), silver.load_hourly(energy_load(t)), silver.fx_rates_daily(fx_daily(t))
    )


def plan_bike(t):
    return gold.fact_bike_traffic_daily(
        silver.bike_detections(bike_detections(t)), silver.bike_directions(bike_counters(t)), g_counter(t)
    )


def plan_event_bike(t):
    """The fact over the detections that events make, with counters that only the events know."""
    counters = silver.bike_counters(bike_counters(t), event_detections(t), s_districts(t), cell=0.02)
    members = gold.dim_bike_counter(counters, g_district(t))
    return gold.fact_bike_traffic_daily(silver.bike_detections(event_detections(t)), silver.bike_directions(bike_counters(t)), members)


def plan_mart(t):
    return gold.mart_air_vs_energy_daily(g_air(t), g_weather(t), g_energy(t), g_district(t), g_date(t))


g_air, g_weather, g_energy, g_bike, g_mart = (_layer(p) for p in (plan_air, plan_weather, plan_energy, plan_bike, plan_mart))


# ---------------------------------------------------------------- the same in SQL

F_ = FRAGMENTS
F_["q_polygons"] = """
select n_nationkey as k, (140 + n_nationkey % 5) / 10.0::double as x0, (141 + n_nationkey % 5) / 10.0::double as x1,
  (500 + n_nationkey // 5) / 10.0::double as y0, (501 + n_nationkey // 5) / 10.0::double as y1,
  (1404 + 10 * (n_nationkey % 5)) / 100.0::double as hx0, (1406 + 10 * (n_nationkey % 5)) / 100.0::double as hx1,
  (5004 + 10 * (n_nationkey // 5)) / 100.0::double as hy0, (5006 + 10 * (n_nationkey // 5)) / 100.0::double as hy1
from nation"""
F_["q_counters"] = f"""
select 'C' || c_custkey as counter_id, c_name as counter_name, c_mktsegment as cycle_route,
  {SQL_X.format(k='c_custkey')} as longitude, {SQL_Y.format(k='c_custkey')} as latitude,
  date '2024-01-01' as first_seen_date, c_custkey % 11 <> 0 as is_listed,
  case when c_custkey % 11 = 0 then date '2024-01-01' else date '2024-01-15' end as last_listed_date, c_custkey
from customer"""
INSIDE = """p.x0 < c.longitude and p.y0 < c.latitude and case
  when p.k % 5 = 4 then (p.x0 - p.x1) * (c.latitude - p.y0) - (c.longitude - p.x1) * (p.y1 - p.y0) > 0
  else c.longitude < p.x1 and c.latitude < p.y1 and
    not (p.k % 2 = 1 and c.longitude >= p.hx0 and c.longitude <= p.hx1 and c.latitude >= p.hy0 and c.latitude <= p.hy1)
  end"""
F_["s_counters"] = f"""
select c.counter_id, c.counter_name, c.cycle_route, c.latitude, c.longitude, 'd' || p.k as district_slug,
  c.first_seen_date, c.last_listed_date, c.is_listed, false as is_inferred
from q_counters c left join q_polygons p on {INSIDE}
union all
select 'X' || s_suppkey, null, null, null, null, null, null, null, false, true from supplier where s_suppkey % 10 = 9
union all
select 'C' || s_suppkey, null, null, null, null, null, null, null, false, true from supplier
where s_suppkey % 10 <> 9 and s_suppkey not in (select c_custkey from customer)"""
F_["q_detections"] = """
select case when s % 10 = 9 then 'X' || s else 'C' || s end as counter_id,
  'D' || (case when s % 5 = 0 then (s + 1) % 7 else s % 7 end) as direction_id,
  timestamp '2024-03-29 23:00:00' + to_minutes((slot * 5)::bigint) as ts,
  case when (s + slot) % 50 = 0 then null else (s * 31 + slot * 7) % 40 + (slot % 25 = 0)::int end as bike_count,
  case when s % 2 = 0 then slot % 9 end as pedestrian_count, s, slot
from (select s_suppkey as s, unnest(range(0, 852)) as slot from supplier)
where not (s % 3 = 0 and (s // 20) % 2 = 0 and slot % 97 = s % 97)"""
F_["q_event_detections"] = """
select 'C' || user_id as counter_id, 'D' || (case when user_id % 5 = 0 then (user_id + 1) % 7 else user_id % 7 end) as direction_id,
  time_bucket(interval 5 minutes, ts) as slot, case when event_type <> 'error' then floor(value)::bigint end as bike_count,
  case when event_type = 'view' then floor(value / 10)::bigint end as pedestrian_count
from events qualify row_number() over (partition by user_id, time_bucket(interval 5 minutes, ts) order by ts desc, event_id desc) = 1"""
F_["q_station_runs"] = f"""
select 'S' || s_suppkey as station_id, r.run,
  s_name || case when s_suppkey % 7 = 0 and r.run > date '2024-01-01' then ' new' else '' end as station_name,
  'd' || (case when s_suppkey % 13 = 0 and r.run > date '2024-01-11' then (s_nationkey + 1) % 25 else s_nationkey end) as district_slug,
  {SQL_Y.format(k='s_suppkey')} as latitude, {SQL_X.format(k='s_suppkey')} as longitude, s_suppkey
from supplier, (values (date '2024-01-01'), (date '2024-01-11'), (date '2024-01-21')) r(run)"""
F_["q_station_state"] = """
select station_id, run, station_name, latitude, longitude, is_listed, false as is_inferred,
  case when not is_listed then first_value(district_slug) over (partition by station_id order by run rows between 1 preceding and current row) else district_slug end as district_slug
from (select *, not (s_suppkey % 10 = 3 and run = date '2024-01-21') as is_listed from q_station_runs)
union all
select distinct 'S' || user_id, date '2024-01-01', null::varchar, null::double, null::double, false, true, null::varchar
from events where user_id not in (select s_suppkey from supplier)"""
F_["s_station_versions"] = """
select *, coalesce(lead(run) over (partition by station_id order by run), date '9999-12-31') as valid_to,
  case when row_number() over (partition by station_id order by run) = 1 then date '1900-01-01' else run end as valid_from,
  lead(run) over (partition by station_id order by run) is null as is_current
from (select *, lag((station_name, district_slug, is_listed)) over (partition by station_id order by run) as before
      from q_station_state)
where before is null or before is distinct from (station_name, district_slug, is_listed)"""
F_["g_station"] = """
select md5(station_id || '|' || strftime(run, '%Y-%m-%d') || ' 00:00:00.000000') as station_key, station_id, station_name,
  case when district_slug is null or district_slug not in (select 'd' || n_nationkey from nation) then '-1'
    else md5(district_slug) end as district_key,
  district_slug, latitude, longitude, is_listed, is_inferred, valid_from::timestamp as valid_from_ts_utc,
  valid_to::timestamp as valid_to_ts_utc, is_current
from s_station_versions"""
F_["q_publications"] = """
select *, date_trunc('hour', ts) - interval 1 hour as hour from events
qualify row_number() over (partition by user_id, date_trunc('hour', ts) order by ts desc, event_id desc) = 1"""
F_["s_measurements"] = """
select 'S' || user_id as station_id, hour as measured_hour_start_ts_utc, c.pollutant, c.v as value_ugm3,
  case when ts < timestamp '2024-01-10' then 3 else 1 end as averaging_hours,
  case event_type when 'view' then '1A' when 'click' then '1B' when 'error' then '0' else '2A' end as aq_hourly_index,
  ts as published_ts_utc
from (select *, unnest([{'pollutant': 'PM10', 'v': value}, {'pollutant': 'NO2', 'v': value * 2}, {'pollutant': 'PM2_5', 'v': value / 2}]) as c
      from q_publications)
where (c.pollutant = 'PM10') or (c.pollutant = 'NO2' and event_type <> 'error') or (c.pollutant = 'PM2_5' and event_id % 3 = 0)"""


def _key(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')::int"


F_["g_air"] = f"""
select m.station_id, m.measured_hour_start_ts_utc as hour_start_ts_utc, m.pollutant, s.station_key,
  coalesce(s.district_key, '-1') as district_key, {_key(local('m.measured_hour_start_ts_utc'))} as date_key,
  {local('m.measured_hour_start_ts_utc')} as hour_start_local, m.value_ugm3, m.averaging_hours, m.aq_hourly_index, m.published_ts_utc
from s_measurements m left join g_station s on m.station_id = s.station_id
  and m.measured_hour_start_ts_utc >= s.valid_from_ts_utc and m.measured_hour_start_ts_utc < s.valid_to_ts_utc"""
F_["s_weather"] = """
select 'S' || user_id as station_id, date_trunc('hour', ts) as hour_start_ts_utc, value / 5 as temperature_c,
  (event_id % 101)::double as relative_humidity_pct, case when event_id % 4 = 0 then value / 100 else 0 end as precipitation_mm,
  value / 3 as wind_speed_kmh, value / 3 / 3.6::double as wind_speed_ms, ((event_id * 7) % 361)::double as wind_direction_deg
from events qualify row_number() over (partition by user_id, date_trunc('hour', ts) order by ts desc, event_id desc) = 1"""
F_["g_weather"] = f"""
select w.*, s.station_key, coalesce(s.district_key, '-1') as district_key, {_key(local('w.hour_start_ts_utc'))} as date_key,
  {local('w.hour_start_ts_utc')} as hour_start_local
from s_weather w left join g_station s on w.station_id = s.station_id
  and w.hour_start_ts_utc >= s.valid_from_ts_utc and w.hour_start_ts_utc < s.valid_to_ts_utc"""
F_["q_prices"] = """
select time_bucket(interval 15 minutes, ts) as ts_utc, value - 20 as value, ts as loaded_at from events
qualify row_number() over (partition by time_bucket(interval 15 minutes, ts) order by ts desc, event_id desc) = 1"""
F_["s_prices"] = f"""
select date_trunc('hour', ts_utc) as hour_start_ts_utc, {local("date_trunc('hour', ts_utc)")} as hour_start_local,
  avg(value::decimal(18,6)) as price_eur_mwh, min(value) as min_price_eur_mwh, max(value) as max_price_eur_mwh,
  count(*) as n_intervals, max(loaded_at) as loaded_at_ts_utc
from q_prices group by all"""
F_["q_load"] = """
select time_bucket(interval 15 minutes, ts) as ts_utc, value * 100 as value, ts as loaded_at from events
qualify row_number() over (partition by time_bucket(interval 15 minutes, ts) order by ts desc, event_id desc) = 1"""
F_["s_load"] = f"""
select date_trunc('hour', ts_utc) as hour_start_ts_utc, {local("date_trunc('hour', ts_utc)")} as hour_start_local,
  avg(value::decimal(18,6)) as load_mw, count(*) as n_intervals, max(loaded_at) as loaded_at_ts_utc
from q_load group by all"""
F_["q_rates"] = f"""
select ts::date as day, {CURRENCY} as currency_code, (20 + value / 10) / (case when event_type in ('purchase', 'error') then 100 else 1 end) as rate,
  case when event_type in ('purchase', 'error') then 100 else 1 end as amount, ts as loaded_at
from events
qualify row_number() over (partition by ts::date, {CURRENCY} order by ts desc, event_id desc) = 1"""
F_["s_fx"] = """
select g.calendar_date, g.currency_code, r.day as rate_date, r.rate as rate_czk_per_unit, r.amount as quoted_amount,
  r.day is distinct from g.calendar_date as is_forward_filled, r.loaded_at as loaded_at_ts_utc
from (select d.calendar_date, c.currency_code
      from (select unnest(generate_series(min(day), max(day), interval 1 day))::date as calendar_date from q_rates) d,
           (select distinct currency_code from q_rates) c) g
asof left join q_rates r on g.currency_code = r.currency_code and g.calendar_date >= r.day"""
F_["g_energy"] = f"""
select p.hour_start_ts_utc, {_key('p.hour_start_local')} as date_key, p.hour_start_local, p.price_eur_mwh, p.min_price_eur_mwh, p.max_price_eur_mwh,
  coalesce(f.rate_czk_per_unit, z.rate) as eur_czk_rate, f.rate_czk_per_unit is null as is_eur_rate_estimated,
  p.price_eur_mwh * coalesce(f.rate_czk_per_unit, z.rate) as price_czk_mwh, l.load_mw,
  p.n_intervals as n_price_intervals, l.n_intervals as n_load_intervals
from s_prices p left join s_load l using (hour_start_ts_utc)
  left join s_fx f on f.currency_code = 'EUR' and f.calendar_date = p.hour_start_local::date,
  (select arg_max(rate_czk_per_unit, calendar_date) as rate from s_fx where currency_code = 'EUR') z"""
F_["g_district"] = """
select md5('d' || n_nationkey) as district_key, n_nationkey as district_id, 'd' || n_nationkey as district_slug, n_name as district_name,
  n_nationkey <> 24 as is_listed from nation
union all select '-1', null, 'unknown', 'Unknown', true"""
F_["g_counter"] = """
select md5(c.counter_id) as counter_key, c.*, coalesce(d.district_key, '-1') as district_key
from s_counters c left join g_district d on c.district_slug = d.district_slug"""
F_["g_bike"] = f"""
select d.*, c.counter_key, coalesce(c.district_key, '-1') as district_key, {_key('d.local_date')} as date_key,
  case when cat.c_custkey is not null then 'to ' || cat.c_custkey % 70 else n.shared end as direction_name,
  cat.c_custkey is null as is_direction_inferred,
  case when d.local_date = date '2024-03-31' then 276 else 288 end as expected_slots,
  d.n_slots >= case when d.local_date = date '2024-03-31' then 276 else 288 end as is_complete_day
from (select counter_id, direction_id, ({local('ts')})::date as local_date, sum(bike_count) as bike_count, sum(pedestrian_count) as pedestrian_count,
        count(*) as n_slots, count(bike_count) as n_slots_with_bike_data from q_detections group by all) d
  left join g_counter c using (counter_id)
  left join customer cat on d.counter_id = 'C' || cat.c_custkey and d.direction_id = 'D' || cat.c_custkey % 7
  left join (select 'D' || c_custkey % 7 as direction_id, min('to ' || c_custkey % 70) as shared from customer group by 1) n
    on d.direction_id = n.direction_id"""
F_["g_event_bike"] = f"""
select d.*, md5(d.counter_id) as counter_key, coalesce(c.district_key, '-1') as district_key, {_key('d.local_date')} as date_key,
  case when cat.c_custkey is not null then 'to ' || cat.c_custkey % 70 else n.shared end as direction_name,
  cat.c_custkey is null as is_direction_inferred, x.expected_slots, d.n_slots >= x.expected_slots as is_complete_day
from (select counter_id, direction_id, ({local('slot')})::date as local_date, sum(bike_count) as bike_count,
        sum(pedestrian_count) as pedestrian_count, count(*) as n_slots, count(bike_count) as n_slots_with_bike_data
      from q_event_detections group by all) d
  join (select local_date, datediff('minute', timezone('Europe/Prague', local_date::timestamp),
          timezone('Europe/Prague', (local_date + interval 1 day)::timestamp)) // 5 as expected_slots
        from (select distinct ({local('slot')})::date as local_date from q_event_detections)) x using (local_date)
  left join (select * from g_counter where counter_id in (select 'C' || c_custkey from customer)) c on c.counter_id = d.counter_id
  left join customer cat on d.counter_id = 'C' || cat.c_custkey and d.direction_id = 'D' || cat.c_custkey % 7
  left join (select 'D' || c_custkey % 7 as direction_id, min('to ' || c_custkey % 70) as shared from customer group by 1) n
    on d.direction_id = n.direction_id"""
F_["g_date"] = """
select strftime(d, '%Y%m%d')::int as date_key, d as date_day, isodow(d) in (6, 7) as is_weekend, h.name as holiday_name,
  h.name is not null as is_cz_public_holiday
from (select unnest(generate_series(date '2024-01-01', date '2025-12-31', interval 1 day))::date as d)
  left join (values (date '2024-01-01', 'New year'), (date '2024-01-15', 'Mid month'), (date '2024-03-29', 'Good Friday')) h(day, name) on d = h.day"""
F_["q_air_day"] = """
select district_key, date_key, avg(value_ugm3::decimal(18,6)) filter (where pollutant = 'PM2_5') as avg_pm2_5_ugm3,
  avg(value_ugm3::decimal(18,6)) filter (where pollutant = 'PM10') as avg_pm10_ugm3,
  avg(value_ugm3::decimal(18,6)) filter (where pollutant = 'NO2') as avg_no2_ugm3,
  count(distinct station_id) as n_aq_stations, max(averaging_hours) as aq_averaging_hours
from g_air group by all"""
F_["q_weather_day"] = """
select district_key, date_key, avg(t::decimal(18,6)) as avg_temperature_c, avg(w::decimal(18,6)) as avg_wind_speed_ms,
  avg(h::decimal(18,6)) as avg_relative_humidity_pct, avg(r::decimal(18,6)) as precipitation_mm
from (select station_id, district_key, date_key, avg(temperature_c::decimal(18,6)) as t, avg(wind_speed_ms::decimal(18,6)) as w,
        avg(relative_humidity_pct::decimal(18,6)) as h, sum(precipitation_mm::decimal(18,6))::double as r from g_weather group by all)
group by all"""
F_["q_energy_day"] = """
select date_key, avg(price_eur_mwh::decimal(18,6)) as avg_price_eur_mwh, avg(price_czk_mwh::decimal(18,6)) as avg_price_czk_mwh,
  min(price_eur_mwh) as min_price_eur_mwh, max(price_eur_mwh) as max_price_eur_mwh, avg(load_mw::decimal(18,6)) as avg_load_mw,
  count(*) as n_price_hours
from g_energy group by all"""
F_["g_mart"] = """
select a.*, d.district_slug, d.district_name, x.date_day, x.is_weekend, x.is_cz_public_holiday, w.avg_temperature_c, w.avg_wind_speed_ms,
  w.avg_relative_humidity_pct, w.precipitation_mm, e.avg_price_eur_mwh, e.avg_price_czk_mwh, e.min_price_eur_mwh, e.max_price_eur_mwh,
  e.avg_load_mw, e.n_price_hours
from q_air_day a left join q_weather_day w using (district_key, date_key) left join q_energy_day e using (date_key)
  left join g_district d using (district_key) left join g_date x using (date_key)"""
