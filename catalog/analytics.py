"""Profiles (K), analytics on the gold layer (L) and streaming ingest (M)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import feeds
from catalog.model import MART
from catalog.registry import Tables, pick, query
from citylake import profiling
from citylake.operators import totals
from citylake.plans import analytics
from citylake.plans.warehouse import upsert_partitions
from citylake.session import fresh_dir
from citylake.sources.landing import day_of_text, read_bronze
from citylake.streaming import ingest

START, END = date(2024, 1, 5), date(2024, 1, 25)
KEYS = "date_key between 20240105 and 20240125"


def _nullable(t: Tables):
    return t.customer.withColumn("c_name", F.when(F.col("c_nationkey") >= 6, F.col("c_name"))).withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))


@query("k01_profile_overview", """select (select count(*) from lineitem) as total_rows, 3 as n_columns,
  (select count(*) from lineitem) - (select count(*) from (select distinct l_partkey, l_linenumber, l_returnflag from lineitem)) as duplicate_rows""")
def _(t):
    return profiling.overview(t.lineitem.select("l_partkey", "l_linenumber", "l_returnflag"))


@query("k01_missing", """select 'c_name' as "column", round(avg((c_nationkey < 6)::int) * 100, 2) as null_pct from customer
  union all select 'c_acctbal', round(avg((not c_acctbal > 0)::int) * 100, 2) from customer having avg((not c_acctbal > 0)::int) > 0""")
def _(t):
    return profiling.missing(_nullable(t))


@query("k02_whole_table_profile", """select 'l_quantity' as "column", count(*) as total_rows, count(*) - (select count(*) from (select distinct l_orderkey, l_partkey, l_quantity from lineitem)) as duplicate_rows,
    count(l_quantity) as n, count(*) - count(l_quantity) as n_null, min(l_quantity)::double as low, max(l_quantity)::double as high, round(avg(l_quantity), 6) as mean from lineitem
  union all select 'l_partkey', count(*), count(*) - (select count(*) from (select distinct l_orderkey, l_partkey, l_quantity from lineitem)),
    count(l_partkey), count(*) - count(l_partkey), min(l_partkey), max(l_partkey), round(avg(l_partkey), 6) from lineitem""")
def _(t):
    parts = profiling.profile(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"))
    columns = parts["columns"].where("column <> 'l_orderkey'")
    whole = {c: parts["overview"].select(c).scalar() for c in ("total_rows", "duplicate_rows")}
    return columns.withColumns(whole).select(
        "column", "total_rows", "duplicate_rows", "n", "n_null", F.col("min").cast("double").alias("low"), F.col("max").cast("double").alias("high"), "mean")


@query("k03_naive_utc", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from events")
def _(t):
    return profiling.naive_utc(t.events.select("event_id", "ts"))


@query("k04_correlations", """with v as (select l as column_a, r as column_b, x, y from (select unnest([
    {'l': 'c_acctbal', 'r': 'c_acctbal', 'x': c_acctbal, 'y': c_acctbal}, {'l': 'c_acctbal', 'r': 'c_nationkey', 'x': c_acctbal, 'y': c_nationkey::double},
    {'l': 'c_nationkey', 'r': 'c_nationkey', 'x': c_nationkey::double, 'y': c_nationkey::double}], recursive := true) from customer)),
  k as (select *, rank() over (partition by column_a, column_b order by x) + (count(*) over (partition by column_a, column_b, x) - 1) / 2 as rx,
      rank() over (partition by column_a, column_b order by y) + (count(*) over (partition by column_a, column_b, y) - 1) / 2 as ry from v)
  select column_a, column_b, round(corr(x, y), 6) as pearson, round(corr(rx, ry), 6) as spearman from k group by all""")
def _(t):
    return profiling.correlation_matrix(t.customer, ["c_acctbal", "c_nationkey"])


@query("k05_column_statistics", """select 'l_quantity' as "column", count(l_quantity) as n, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as stddev from lineitem
  union all select 'l_returnflag', count(l_returnflag), null, null from lineitem""")
def _(t):
    rows = profiling.column_statistics(t.lineitem.select("l_quantity", "l_returnflag"))
    return rows.select("column", "n", "mean", "stddev")


@query("k05_merged_profile", """with r as (select * from events where ts::date between date '2024-01-08' and date '2024-01-21')
  select 'value' as "column", count(*) as n, 0::bigint as n_null, round(min(value), 6) as low, round(max(value), 6) as high, null as first, null as last, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev from r
  union all select 'event_type', count(*), 0, null, null, min(event_type), max(event_type), null, null from r""")
def _(t):
    """A profile of two weeks from the profiles of single days."""
    rows = t.events.select(F.to_date("ts").alias("day"), "value", "event_type")
    days = profiling.daily_profile(rows, "day").where("day between date'2024-01-08' and date'2024-01-21'")
    return profiling.merged_profile(days).drop("n_distinct_approx", "quantiles_approx")


@query("k06_catalogue", """select 'lineitem' as table_name, count(*) as total_rows, 11 as n_columns from lineitem union all select 'orders', count(*), 6 from orders
  union all select 'events', count(*), 6 from events""")
def _(t):
    return profiling.catalogue({"lineitem": t.lineitem, "orders": t.orders, "events": t.events})


# ---------------------------------------------------------------- L analytics


@query("l01_date_bounds", "select strftime(min(date_day), '%Y-%m-%d') as lo, strftime(max(date_day), '%Y-%m-%d') as hi from g_mart")
def _(t):
    return analytics.date_bounds(feeds.g_mart(t))


@query("l02_districts_with_data", "select distinct district_slug, district_name from g_district where district_key in (select district_key from g_air union select district_key from g_bike)")
def _(t):
    return analytics.districts_with_data(feeds.g_district(t), feeds.g_mart(t), feeds.g_bike(t))


def _customer_daily(t):
    """A long district-by-day table: one row per nation and order day."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    day = joined.groupBy(F.format_string("d%d", "c_nationkey").alias("district_slug"), F.to_date("o_orderdate").alias("date_day"))
    return day.agg(F.count("*").alias("bikes"), F.countDistinct("o_custkey").alias("n_counters"), F.max("o_totalprice").alias("top")).withColumn(
        "district_name", F.col("district_slug"))


# Pollutant column {c} of the mart against each driver.
CORRELATIONS = """select district_slug, district_name, u.n as driver, round(corr({c}, u.v), 2) as r, count(*) as n_days from (
  select district_slug, district_name, {c}, unnest([{{'n': 'Day-ahead price', 'v': avg_price_eur_mwh}}, {{'n': 'Electricity load', 'v': avg_load_mw}}, {{'n': 'Wind speed', 'v': avg_wind_speed_ms}},
    {{'n': 'Temperature', 'v': avg_temperature_c}}, {{'n': 'Precipitation', 'v': precipitation_mm}}]) as u from g_mart where {c} is not null)
where u.v is not null group by 1, 2, 3 having count(*) >= 14 and min(u.v) < max(u.v) and min({c}) < max({c})"""


@query("l03_district_correlations", CORRELATIONS.format(c="avg_pm10_ugm3"))
def _(t):
    return analytics.district_correlations(feeds.g_mart(t), "PM10")


@query("l04_district_daily", f"select {pick(MART)} from g_mart where {KEYS} and district_slug in ('d1', 'd2', 'd3', 'unknown')")
def _(t):
    return analytics.district_daily(feeds.g_mart(t), START, END, ["d1", "d2", "d3", "unknown"])


def _periods(*days: tuple[date, date]) -> str:
    """SQL: the periods as a relation p(a, b)."""
    return f"(values {', '.join(f"(date '{a}', date '{b}')" for a, b in days)}) p(a, b)"


_PERIOD = "strftime(p.a, '%Y-%m-%d') as period_start, strftime(p.b, '%Y-%m-%d') as period_end"
WINTER = ((date(2023, 12, 1), date(2024, 1, 7)), (date(2024, 1, 5), date(2024, 1, 25)), (date(2024, 1, 10), date(2024, 1, 10)), (date(2024, 1, 20), date(2025, 6, 30)))


def _written_totals(t, rows, keys, day, values, scale=totals.SCALE):
    path = fresh_dir(t.spark, "totals")
    totals.write_totals(totals.daily_sums(rows, keys, day, values, scale), keys, day, values, path)
    return t.spark.read.parquet(path)


@query("l04_period_means", f"""select {_PERIOD}, district_slug, count(*) as n_rows, count(avg_pm10_ugm3) as n_pm10, round(avg(avg_pm10_ugm3), 3) as mean_pm10, round(avg(avg_price_eur_mwh), 3) as mean_price
  from g_mart join {_periods(*WINTER)} on date_day between p.a and p.b group by all""")
def _(t):
    """District means of overlapping periods from the same running totals."""
    values = ["avg_pm10_ugm3", "avg_price_eur_mwh"]
    kept = _written_totals(t, feeds.g_mart(t), "district_slug", "date_day", values, scale=9)
    found = totals.period_sums(kept, "district_slug", "date_day", values, WINTER, scale=9)
    return found.select(
        "period_start", "period_end", "district_slug", "n_rows", F.col("avg_pm10_ugm3_n").alias("n_pm10"),
        F.round("avg_pm10_ugm3_mean", 3).alias("mean_pm10"), F.round("avg_price_eur_mwh_mean", 3).alias("mean_price"))


@query("l05_station_pollution", f"""select station_id, station_name, district_slug, round(latitude, 6) as latitude, round(longitude, 6) as longitude, round(avg(a.value_ugm3), 6) as mean_ugm3,
  max(a.value_ugm3) as max_ugm3, count(a.value_ugm3) as n_hours from g_station s left join (select station_id, value_ugm3 from g_air where pollutant = 'NO2' and {KEYS}) a using (station_id)
  where s.is_current and s.latitude is not null group by all""")
def _(t):
    return analytics.station_pollution(feeds.g_air(t), feeds.g_station(t), START, END, "NO2")


_HOURLY = f"""select a.station_id, s.station_name, a.hour_start_local, a.value_ugm3, w.wind_speed_ms, e.price_eur_mwh from g_air a join g_station s using (station_key)
  join g_weather w on w.station_id = a.station_id and w.hour_start_ts_utc = a.hour_start_ts_utc join g_energy e on e.hour_start_ts_utc = a.hour_start_ts_utc
  where a.pollutant = 'PM10' and a.{KEYS}"""


@query("l06_hourly_pollutant_wind", f"select {pick('s station_id, s station_name, t hour_start_local, f value_ugm3, f wind_speed_ms, f price_eur_mwh')} from ({_HOURLY} and s.district_slug <> 'd0')")
def _(t):
    slugs = [f"d{k}" for k in range(1, 25)]
    return analytics.hourly_pollutant_wind(feeds.g_air(t), feeds.g_station(t), feeds.g_weather(t), feeds.g_energy(t), START, END, "PM10", slugs)


_DAILY_PRICE = f"""select strftime(hour_start_local, '%Y-%m-%d') as date_day, round(avg(price_eur_mwh), 6) as price_eur_mwh, round(avg(price_czk_mwh), 6) as price_czk_mwh,
  round(min(price_eur_mwh), 6) as min_price_eur_mwh, round(max(price_eur_mwh), 6) as max_price_eur_mwh, round(avg(load_mw), 6) as load_mw from g_energy where {KEYS} group by 1"""


def _daily_price(t):
    return analytics.daily_price(feeds.g_energy(t), START, END)


@query("l07_daily_price", _DAILY_PRICE)
def _(t):
    return _daily_price(t)


@query("l07_period_price", f"""select {_PERIOD}, count(price_eur_mwh) as n_hours, round(avg(price_eur_mwh), 3) as price_eur_mwh, round(sum(load_mw), 3) as load_mwh
  from g_energy join {_periods(*WINTER)} on hour_start_local::date between p.a and p.b group by all""")
def _(t):
    """Mean price and consumption of whole periods: one group, two rows read per period."""
    values, rows = ["price_eur_mwh", "load_mw"], feeds.g_energy(t).withColumn("local_day", F.to_date("hour_start_local"))
    found = totals.period_sums(_written_totals(t, rows, [], "local_day", values, 9), [], "local_day", values, WINTER, scale=9)
    return found.select(
        "period_start", "period_end", F.col("price_eur_mwh_n").alias("n_hours"),
        F.round("price_eur_mwh_mean", 3).alias("price_eur_mwh"), F.round("load_mw_sum", 3).alias("load_mwh"))


_BIKES = """select d.district_slug, d.district_name, f.local_date, sum(f.bike_count)::bigint as bikes, count(distinct f.counter_id) as n_counters from g_bike f join g_district d using (district_key)
  group by all having bool_and(f.is_complete_day) and sum(f.bike_count) is not null"""
SPRING = (date(2024, 3, 1), date(2024, 4, 30))


def _bike_daily(t):
    return analytics.bike_daily(feeds.g_bike(t), feeds.g_district(t), *SPRING)


@query("l08_bike_daily", f"select * exclude (local_date), strftime(local_date, '%Y-%m-%d') as date_day from ({_BIKES})")
def _(t):
    return _bike_daily(t)


@query("l09_bike_counter_daily", """select c.counter_id, c.counter_name, d.district_name, strftime(f.local_date, '%Y-%m-%d') as date_day, sum(f.bike_count)::bigint as bikes from g_bike f
  join g_counter c on f.counter_key = c.counter_key join g_district d on c.district_key = d.district_key group by 1, 2, 3, 4 having bool_and(f.is_complete_day) and sum(f.bike_count) is not null""")
def _(t):
    return analytics.bike_counter_daily(feeds.g_bike(t), feeds.g_counter(t), feeds.g_district(t), *SPRING)


@query("l10_freshness", """select 'Air quality' as dataset, strftime(max(published_ts_utc), '%Y-%m-%d %H:%M:%S') as latest_utc from g_air
  union all select 'Electricity price', strftime(max(hour_start_ts_utc), '%Y-%m-%d %H:%M:%S') from g_energy
  union all select 'Weather', strftime(max(hour_start_ts_utc), '%Y-%m-%d %H:%M:%S') from g_weather
  union all select 'Bicycle counters', strftime(max(local_date)::timestamp, '%Y-%m-%d %H:%M:%S') from g_bike""")
def _(t):
    return analytics.freshness(feeds.g_air(t), feeds.g_energy(t), feeds.g_weather(t), feeds.g_bike(t))


_POLLUTION = f"""select strftime(date_day, '%Y-%m-%d') as date_day, round(avg(avg_no2_ugm3), 6) as value_ugm3, count(distinct district_slug) as n_districts from g_mart
  where {KEYS} and avg_no2_ugm3 is not null group by 1"""


def _pollution(t):
    return analytics.daily_pollution(analytics.district_daily(feeds.g_mart(t), START, END), "NO2")


@query("l11_daily_pollution", _POLLUTION)
def _(t):
    return _pollution(t)


_LONG = """select 'd' || c_nationkey as district_slug, o_orderdate::date as d, count(*) as bikes, count(distinct o_custkey) as n_counters from orders join customer on o_custkey = c_custkey group by all"""


@query("l12_rolling_bikes", f"""select district_slug, strftime(d, '%Y-%m-%d') as date_day, bikes, round(case when count(*) over w = 7 then avg(bikes) over w end, 6) as bikes_rolling from ({_LONG})
  window w as (partition by district_slug order by d rows between 6 preceding and current row)""")
def _(t):
    return analytics.rolling_bike_traffic(_customer_daily(t)).select("district_slug", "date_day", "bikes", "bikes_rolling")


_GROWTH = f"""select district_slug, district_slug as district_name, max(n_counters) as n_counters, round(avg(bikes) filter (where a <= 28), 1) as first_window_mean,
  round(avg(bikes) filter (where z <= 28), 1) as last_window_mean, round((avg(bikes) filter (where z <= 28) / avg(bikes) filter (where a <= 28) - 1) * 100, 1) as growth_pct
  from (select *, row_number() over (partition by district_slug order by d) as a, row_number() over (partition by district_slug order by d desc) as z from ({_LONG})) group by 1 having count(*) >= 56"""


@query("l13_bike_growth", _GROWTH)
def _(t):
    return analytics.bike_growth(_customer_daily(t))


@query("l13_top_growing", f"select district_slug, growth_pct from ({_GROWTH}) order by growth_pct desc, district_slug limit 3")
def _(t):
    return analytics.top_growing(analytics.bike_growth(_customer_daily(t))).select("district_slug", "growth_pct")


YEARS = ((date(1995, 1, 1), date(1995, 12, 31)), (date(1996, 2, 15), date(1998, 8, 3)), (date(1997, 7, 1), date(1997, 7, 1)), (date(1990, 1, 1), date(2010, 1, 1)))


@query("l13_period_orders", f"""select {_PERIOD}, c_nationkey::bigint as nation, count(*) as n_rows, round(sum(o_totalprice::decimal(18,6))::double, 6) as total
  from orders join customer on o_custkey = c_custkey join {_periods(*YEARS)} on o_orderdate::date between p.a and p.b group by all""")
def _(t):
    """Totals of finished and open orders are written; those still in process come late and are added when asked."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select(F.col("c_nationkey").alias("nation"), "o_orderstatus", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"))
    kept = _written_totals(t, rows.filter("o_orderstatus <> 'P'"), "nation", "day", ["price"])
    late = totals.daily_sums(rows.filter("o_orderstatus = 'P'"), "nation", "day", ["price"])
    found = totals.period_sums(kept, "nation", "day", ["price"], YEARS, late)
    return found.select("period_start", "period_end", "nation", "n_rows", F.col("price_sum").alias("total"))


@query("l14_kpis", f"""select * from (select round(avg(value_ugm3), 3) as pollutant_mean, round(max(value_ugm3), 3) as pollutant_max_day from ({_POLLUTION})),
  (select round(avg(price_eur_mwh), 3) as price_mean_eur, round(avg(price_czk_mwh), 3) as price_mean_czk, count(*) filter (where min_price_eur_mwh < 0) as negative_price_days from ({_DAILY_PRICE})),
  (select round(avg(b), 3) as bikes_per_day from (select sum(bikes) as b from ({_BIKES}) group by local_date))""")
def _(t):
    row = analytics.kpis(_pollution(t), _daily_price(t), _bike_daily(t))
    return row.select(*[F.round(c, 3).alias(c) if c != "negative_price_days" else F.col(c) for c in row.columns])


@query("l15_pollution_and_price", f"select coalesce(p.date_day, e.date_day) as date_day, p.value_ugm3, p.n_districts, e.price_eur_mwh, e.load_mw from ({_POLLUTION}) p full join ({_DAILY_PRICE}) e on p.date_day = e.date_day")
def _(t):
    merged = analytics.pollution_and_price(_pollution(t), _daily_price(t))
    return merged.select("date_day", "value_ugm3", "n_districts", "price_eur_mwh", "load_mw")


@query("l15_colour_bounds", f"select p as probability, round(case when p = 0.05 then quantile_cont(price_eur_mwh, 0.05) else quantile_cont(price_eur_mwh, 0.95) end, 6) as quantile from ({_HOURLY}), (values (0.05::double), (0.95::double)) v(p) group by 1")
def _(t):
    hourly = analytics.hourly_pollutant_wind(feeds.g_air(t), feeds.g_station(t), feeds.g_weather(t), feeds.g_energy(t), START, END, "PM10")
    return analytics.colour_bounds(hourly)


@query("l15_heat_table", f"""with c as ({CORRELATIONS.format(c='avg_no2_ugm3')})
select district_name, max(r) filter (where driver = 'Day-ahead price') as "Day-ahead price", max(r) filter (where driver = 'Electricity load') as "Electricity load",
  max(r) filter (where driver = 'Wind speed') as "Wind speed", max(r) filter (where driver = 'Temperature') as "Temperature", max(r) filter (where driver = 'Precipitation') as "Precipitation" from c group by 1""")
def _(t):
    return analytics.correlation_heat_table(analytics.district_correlations(feeds.g_mart(t), "NO2"))


@query("l16_station_coverage", f"""select (select count(distinct station_id) from g_air join (select station_id from g_station where is_current and latitude is not null) using (station_id) where pollutant = 'PM2_5' and {KEYS}) as n_with_data,
  (select count(*) from g_station where is_current and latitude is not null) as n_stations""")
def _(t):
    return analytics.station_coverage(analytics.station_pollution(feeds.g_air(t), feeds.g_station(t), START, END, "PM2_5"))


# ---------------------------------------------------------------- M streaming


@query("m01_new_files_ingest", "select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n from events group by 1")
def _(t):
    """Files arriving in two drops; the second run of the stream reads only the new ones."""
    inbox, root, marks = (fresh_dir(t.spark, label) for label in ("inbox", "bronze", "marks"))
    rows = feeds.air_history(t).drop("load_date")
    for early in (True, False):
        drop = rows.filter((F.col("_loaded_at") < F.lit("2024-01-15").cast("timestamp")) == F.lit(early))
        drop.write.mode("append").parquet(inbox)
        stream = ingest.new_rows(t.spark, inbox, rows.schema)
        ingest.run_available(stream, lambda batch: land_new(batch, root), marks)
    return read_bronze(t.spark, root, "air_history").groupBy("load_date").agg(F.count("*").alias("n"))


def land_new(batch, root: str) -> None:
    """A day that gets rows in several batches is rewritten together with what it already holds."""
    rows = batch.withColumn("load_date", day_of_text("updated_at"))
    upsert_partitions(batch.sparkSession, f"{root}/air_history", rows, ("id", "updated_at"), "load_date")


@query("m02_late_upsert", """select strftime(ts::date, '%Y-%m-%d') as day, event_type, event_id, round(value, 6) as value from events
  qualify row_number() over (partition by ts::date, event_type order by value desc, event_id desc) = 1""")
def _(t):
    """Rows arrive out of order in several micro-batches; the highest version per key stays."""
    inbox, path, marks = (fresh_dir(t.spark, label) for label in ("inbox", "table", "marks"))
    rows = t.events.select(F.to_date("ts").alias("day"), "event_type", "event_id", "value")
    rows.repartition(3, "event_id").write.parquet(inbox)
    stream = ingest.new_rows(t.spark, inbox, rows.schema, files_per_batch=1)
    ingest.upsert_stream(stream, path, ["day", "event_type"], ["value", "event_id"], "day", marks)
    return t.spark.read.parquet(path).select("day", "event_type", "event_id", "value")

