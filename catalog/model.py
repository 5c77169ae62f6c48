"""Dimensional and incremental operators (I) and data-quality checks (J) on the city feeds."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from catalog import feeds
from catalog.registry import pick, query
from citylake import quality
from citylake.operators import incremental, joins, scd2
from citylake.operators.fill import dense_forward_fill
from citylake.plans import contracts, gold, ledger, silver
from citylake.plans.warehouse import upsert_partitions
from citylake.session import fresh_dir


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "o_totalprice")


_UPSERT = """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, case when o_orderdate >= timestamp '1999-01-01' then 'new' else o_orderstatus end as o_orderstatus,
  case when o_orderdate >= timestamp '1999-01-01' then 1::bigint end as revision from orders"""


@query("i01_delete_insert", _UPSERT)
def _(t):
    """The table up to 2000; a batch from 1999 on replaces or adds rows and brings a new column."""
    rows = _orders(t).select("o_orderkey", "day", "o_orderstatus")
    batch = rows.filter("day >= date'1999-01-01'").withColumn("o_orderstatus", F.lit("new")).withColumn("revision", F.lit(1))
    return incremental.delete_insert(rows.filter("day < date'2000-01-01'"), batch, "o_orderkey")


@query("i01_upsert_partitions", """select year(o_orderdate)::bigint as year, o_orderpriority = '1-URGENT' and year(o_orderdate) >= 2000 as replaced, count(*) as n,
  round(sum(case when o_orderpriority = '1-URGENT' and year(o_orderdate) >= 2000 then 1 else o_totalprice end::decimal(18,6))::double, 6) as total from orders group by 1, 2""")
def _(t):
    """A written table whose urgent orders of the last years are upserted in place."""
    path = fresh_dir(t.spark, "upsert")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("year"), F.lit(False).alias("replaced"))
    urgent = rows.filter("year >= 2000 and o_orderpriority = '1-URGENT'")
    batch = urgent.withColumn("o_totalprice", F.lit(1.0)).withColumn("replaced", F.lit(True))
    upsert_partitions(t.spark, path, rows, ("o_orderkey",), "year")
    table = upsert_partitions(t.spark, path, batch, ("o_orderkey",), "year")
    return table.groupBy("year", "replaced").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,6)")).alias("total"))


@query("i02_lookback", "select event_id from events where ts >= (select max(ts) from events where ts < timestamp '2024-01-25') - interval 3 days")
def _(t):
    target = t.events.filter(F.col("ts") < F.lit("2024-01-25").cast("timestamp"))
    return incremental.lookback(t.events, "ts", target, "ts").select("event_id")


@query("i02_changed_days", """with late as (select distinct ts::date as d from events where event_id % 997 = 0)
  select strftime(ts::date, '%Y-%m-%d') as day, count(*) as n, round(sum(case when ts::date in (select d from late) then value + 1 else value end::decimal(18,6))::double, 6) as total from events group by 1""")
def _(t):
    """Events that land again, raised by one on their days; only these days of a stored table are rewritten."""
    path = fresh_dir(t.spark, "changed")
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,6)").alias("value"))
    landed = rows.withColumn("loaded", F.when(F.col("event_id") % 997 == 0, F.lit(datetime(2024, 3, 1))).otherwise(F.lit(datetime(2024, 2, 1))))
    days = incremental.changed_days(landed, "day", "loaded", datetime(2024, 3, 1))
    upsert_partitions(t.spark, path, rows, ("event_id",), "day")
    raised = days.of(rows, "day").withColumn("value", (F.col("value") + 1).cast("decimal(18,6)"))
    table = upsert_partitions(t.spark, path, raised, ("event_id",), "day")
    return table.groupBy("day").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("i03_snapshot", """select station_id, station_name, district_slug, is_listed, strftime(run, '%Y-%m-%d') as valid_from,
  case when valid_to < date '9999-01-01' then strftime(valid_to, '%Y-%m-%d') end as valid_to from s_station_versions""")
def _(t):
    return feeds.station_snapshot(t).select(
        "station_id", "station_name", "district_slug", "is_listed", F.col("scd_valid_from").cast("date").alias("valid_from"),
        F.col("scd_valid_to").cast("date").alias("valid_to"))


_STATION = "s station_key, s station_id, s station_name, s district_key, s district_slug, f latitude, f longitude, s is_listed, s is_inferred, t valid_from_ts_utc, t valid_to_ts_utc, s is_current"


@query("i04_dim_station", f"select {pick(_STATION)} from g_station")
def _(t):
    return gold.dim_station(feeds.station_snapshot(t), feeds.g_district(t))


@query("i05_inferred_members", """select 'S' || s_suppkey as station_id, s_name as station_name, false as is_inferred from supplier
  union all select distinct 'S' || user_id, null, true from events where user_id not in (select s_suppkey from supplier)""")
def _(t):
    listed = t.supplier.select(
        F.format_string("S%d", "s_suppkey").alias("station_id"), F.col("s_name").alias("station_name"), F.lit(False).alias("is_inferred"))
    return scd2.add_inferred(listed, feeds.air_history(t), "station_id", "id", {"is_inferred": F.lit(True)})


@query("i06_unknown_member", "select r_regionkey::bigint as r_regionkey, r_name, null::varchar as geometry from region union all select -1, 'Unknown', null")
def _(t):
    dimension = t.region.withColumn("geometry", F.lit(None).cast("string"))
    return scd2.add_unknown(dimension, {"r_regionkey": -1, "r_name": "Unknown"})


@query("i07_calendar", """select strftime(d, '%Y%m%d')::bigint as date_key, strftime(d, '%Y-%m-%d') as date_day, year(d) as calendar_year, quarter(d) as calendar_quarter,
  month(d) as calendar_month, day(d) as day_of_month, isodow(d) as iso_day_of_week, dayname(d) as day_name, weekofyear(d) as iso_week, isoyear(d) as iso_year,
  isodow(d) > 5 as is_weekend, h.n is not null as is_cz_public_holiday, h.n as holiday_name, isodow(d) <= 5 and h.n is null as is_working_day
  from (select unnest(generate_series(make_date(min(year(o_orderdate)), 1, 1), make_date(max(year(o_orderdate)) + 1, 12, 31), interval 1 day))::date as d from orders)
  left join (select o_orderdate::date as hd, 'busiest of ' || year(o_orderdate) as n from orders group by o_orderdate, year(o_orderdate)
    qualify row_number() over (partition by year(o_orderdate) order by count(*) desc, o_orderdate) = 1) h on d = h.hd""")
def _(t):
    """Calendar over the order years, with the busiest day of each year as its holiday."""
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    best = counts.groupBy(F.year("day").alias("year")).agg(F.max(F.struct("n", (-F.unix_date("day")).alias("back"), "day")).alias("m"))
    holidays = best.select(F.col("m.day").alias("holiday_date"), F.format_string("busiest of %d", "year").alias("holiday_name"))
    years = t.orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")).first()
    return gold.dim_date(t.spark, holidays, date(years["hi"], 1, 1), date(years["lo"], 1, 1))


@query("i08_densified_rates", f"select {pick('d calendar_date, s currency_code, d rate_date, f rate_czk_per_unit, i quoted_amount, s is_forward_filled, t loaded_at_ts_utc')} from s_fx")
def _(t):
    return silver.fx_rates_daily(feeds.fx_daily(t))


@query("i08_dense_fill_orders", """with v as (select c_nationkey::bigint as nation, o_orderdate::date as day, max(o_totalprice) as top from orders join customer on o_custkey = c_custkey group by all)
  select g.nation, strftime(g.d, '%Y-%m-%d') as day, round(v.top, 6) as top, v.day is distinct from g.d as is_forward_filled
  from (select distinct nation, d from v, (select unnest(generate_series(min(day), max(day), interval 1 day))::date as d from v)) g
  asof left join v on v.nation = g.nation and g.d >= v.day""")
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    daily = joined.groupBy(F.col("c_nationkey").alias("nation"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("top"))
    return dense_forward_fill(daily, "nation", "day")


@query("i08_fill_of_a_quarter", """with v as (select c_nationkey::bigint as nation, o_orderdate::date as day, max(o_totalprice) as top from orders join customer on o_custkey = c_custkey where o_orderpriority = '1-URGENT' group by all)
  select g.nation, strftime(g.d, '%Y-%m-%d') as day, round(v.top, 6) as top, v.day is distinct from g.d as is_forward_filled
  from (select distinct nation, d from v, (select unnest(generate_series(date '1996-10-01', date '1996-12-31', interval 1 day))::date as d)) g
  asof left join v on v.nation = g.nation and g.d >= v.day""")
def _(t):
    """Rows are made for the days of the quarter only; what was known before it reaches into it."""
    joined = t.orders.filter("o_orderpriority = '1-URGENT'").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    daily = joined.groupBy(F.col("c_nationkey").alias("nation"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("top"))
    return dense_forward_fill(daily, "nation", "day", date(1996, 10, 1), date(1996, 12, 31))


@query("i09_currency", f"select {pick('t hour_start_ts_utc, f price_eur_mwh, f eur_czk_rate, s is_eur_rate_estimated, f price_czk_mwh')} from g_energy")
def _(t):
    return feeds.plan_energy(t).select("hour_start_ts_utc", "price_eur_mwh", "eur_czk_rate", "is_eur_rate_estimated", "price_czk_mwh")


@query("i10_measured_hours", f"select {pick('s station_id, t measured_hour_start_ts_utc, s pollutant, f value_ugm3, i averaging_hours, s aq_hourly_index, t published_ts_utc')} from s_measurements")
def _(t):
    return silver.air_measurements(feeds.air_history(t)).drop("measured_hour_start_local", "loaded_at_ts_utc")


@query("i10_silver_districts", "select n_nationkey::bigint as district_id, n_name as district_name, 'd' || n_nationkey as district_slug, case when n_nationkey = 24 then '2024-01-01' else '2024-01-15' end as last_listed_date, n_nationkey <> 24 as is_listed from nation")
def _(t):
    return silver.city_districts(feeds.city_districts(t)).select("district_id", "district_name", "district_slug", "last_listed_date", "is_listed")


@query("i11_fact_bike", f"""select {pick('s counter_id, s direction_id, d local_date, s counter_key, s district_key, i date_key, s direction_name, s is_direction_inferred, i bike_count, i pedestrian_count, i n_slots, i n_slots_with_bike_data, i expected_slots, s is_complete_day')} from g_bike""")
def _(t):
    return feeds.plan_bike(t)


@query("i11_event_fact", f"""select {pick('s counter_id, s direction_id, d local_date, s counter_key, s district_key, i date_key, s direction_name, s is_direction_inferred, i bike_count, i pedestrian_count, i n_slots, i n_slots_with_bike_data, i expected_slots, s is_complete_day')} from g_event_bike""")
def _(t):
    return feeds.plan_event_bike(t)


@query("i11_event_detections", f"""select {pick('s counter_id, s direction_id, t slot, i bike_count, i pedestrian_count')} from q_event_detections""")
def _(t):
    rows = silver.bike_detections(feeds.event_detections(t))
    return rows.select("counter_id", "direction_id", F.col("interval_start_ts_utc").alias("slot"), "bike_count", "pedestrian_count")


@query("i11_silver_detections", """select counter_id, direction_id, count(*) as n, sum(bike_count)::bigint as bikes, sum(pedestrian_count)::bigint as pedestrians from q_detections group by all""")
def _(t):
    rows = silver.bike_detections(feeds.bike_detections(t))
    return rows.groupBy("counter_id", "direction_id").agg(
        F.count("*").alias("n"), F.sum("bike_count").alias("bikes"), F.sum("pedestrian_count").alias("pedestrians"))


@query("i12_fact_air", f"select {pick('s station_id, t hour_start_ts_utc, s pollutant, s station_key, s district_key, i date_key, t hour_start_local, f value_ugm3, i averaging_hours, s aq_hourly_index, t published_ts_utc')} from g_air")
def _(t):
    return feeds.plan_air(t)


@query("i12_fact_air_incremental", "select count(*) as n, count(distinct station_id) as n_stations, round(sum(value_ugm3::decimal(18,6))::double, 6) as total from g_air")
def _(t):
    """Full load of the first weeks, then a run that only re-processes the lookback window of the rest."""
    path, stations = fresh_dir(t.spark, "fact"), feeds.g_station(t)
    rows = silver.air_measurements(feeds.air_history(t))
    first = rows.filter(F.col("measured_hour_start_ts_utc") < F.lit("2024-01-28").cast("timestamp"))
    keys = gold.FACT_KEYS["fact_air_quality_hourly"]
    target = upsert_partitions(t.spark, path, gold.fact_air_quality_hourly(first, stations), keys)
    table = upsert_partitions(t.spark, path, gold.fact_air_quality_hourly(rows, stations, target), keys)
    return table.agg(F.count("*").alias("n"), F.countDistinct("station_id").alias("n_stations"), F.sum(F.col("value_ugm3").cast("decimal(18,6)")).alias("total"))


@query("i13_fact_weather", f"select {pick('s station_id, t hour_start_ts_utc, s station_key, s district_key, i date_key, t hour_start_local, f temperature_c, f relative_humidity_pct, f precipitation_mm, f wind_speed_ms, f wind_speed_kmh, f wind_direction_deg')} from g_weather")
def _(t):
    return feeds.plan_weather(t)


MART = ("s district_key, i date_key, s district_slug, s district_name, d date_day, s is_weekend, s is_cz_public_holiday, f avg_pm2_5_ugm3, f avg_pm10_ugm3, f avg_no2_ugm3, "
        "i n_aq_stations, i aq_averaging_hours, f avg_temperature_c, f avg_wind_speed_ms, f avg_relative_humidity_pct, f precipitation_mm, f avg_price_eur_mwh, "
        "f avg_price_czk_mwh, f min_price_eur_mwh, f max_price_eur_mwh, f avg_load_mw, i n_price_hours")


@query("i14_mart", f"select {pick(MART)} from g_mart")
def _(t):
    return feeds.plan_mart(t)


@query("i14_mart_changed_days", f"""select {pick(MART)} from g_mart
  where date_key in (select strftime(ts::date, '%Y%m%d')::int from events where event_type = 'error' and event_id % 50 = 0)""")
def _(t):
    """Only the days of the mart that some events touch, from the partitions of the facts they need."""
    touched = t.events.filter("event_type = 'error' and event_id % 50 = 0").select(F.to_date("ts"))
    facts = feeds.g_air(t), feeds.g_weather(t), feeds.g_energy(t)
    return gold.mart_air_vs_energy_daily(*facts, feeds.g_district(t), feeds.g_date(t), incremental.Days(touched))


@query("i15_silver_weather", f"select {pick('s station_id, t hour_start_ts_utc, f temperature_c, f precipitation_mm, f wind_speed_ms')} from s_weather")
def _(t):
    return silver.weather_hourly(feeds.weather_hourly(t)).select("station_id", "hour_start_ts_utc", "temperature_c", "precipitation_mm", "wind_speed_ms")


@query("i16_directions", "select 'C' || c_custkey as counter_id, 'D' || c_custkey % 7 as direction_id, 'to ' || c_custkey % 70 as direction_name from customer")
def _(t):
    return silver.bike_directions(feeds.bike_counters(t))


@query("i17_dim_district", "select district_key, district_id::bigint as district_id, district_slug, district_name, is_listed from g_district")
def _(t):
    return gold.dim_district(feeds.s_districts(t)).drop("geometry_geojson")


@query("i17_dim_counter", f"select {pick('s counter_key, s counter_id, s counter_name, s cycle_route, s district_key, s district_slug, f latitude, f longitude, s is_listed, s is_inferred')} from g_counter")
def _(t):
    counters = silver.bike_counters(feeds.bike_counters(t), feeds.bike_detections(t), feeds.s_districts(t), cell=0.02)
    return gold.dim_bike_counter(counters, feeds.g_district(t)).drop("source_updated_ts_utc")


@query("i18_prices_hourly", f"select {pick('t hour_start_ts_utc, t hour_start_local, f price_eur_mwh, f min_price_eur_mwh, f max_price_eur_mwh, i n_intervals, t loaded_at_ts_utc')} from s_prices")
def _(t):
    return silver.prices_hourly(feeds.energy_prices(t))


@query("i18_load_hourly", f"select {pick('t hour_start_ts_utc, t hour_start_local, f load_mw, i n_intervals, t loaded_at_ts_utc')} from s_load")
def _(t):
    return silver.load_hourly(feeds.energy_load(t))


# ---------------------------------------------------------------- J checks


@query("j01_not_null", "select l_orderkey, l_linenumber::bigint as l_linenumber from lineitem where l_returnflag = 'R' and l_quantity < 3")
def _(t):
    rows = t.lineitem.withColumn("l_partkey", F.when(F.col("l_quantity") >= 3, F.col("l_partkey")))
    return rows.filter(quality.null_rows("l_partkey", "l_returnflag = 'R'")).select("l_orderkey", "l_linenumber")


@query("j02_unique", "select o_custkey, count(*) as n_records from orders group by 1 having count(*) > 1")
def _(t):
    return quality.duplicated(t.orders, "o_custkey")


@query("j03_unique_together", "select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as n_records from lineitem group by all having count(*) > 1")
def _(t):
    return quality.duplicated(t.lineitem, ["l_orderkey", "l_linenumber"], ignore_nulls=False)


@query("j04_relationships", "select l_suppkey, count(*) as failures from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) group by 1")
def _(t):
    return joins.orphans(t.lineitem, "l_suppkey", t.supplier.filter("s_acctbal > 0"), "s_suppkey")


@query("j05_accepted_values", "select event_type, count(*) as n from events where event_type not in ('view', 'click') group by 1")
def _(t):
    return t.events.filter(quality.outside_values("event_type", ["view", "click"])).groupBy("event_type").agg(F.count("*").alias("n"))


@query("j06_accepted_range", "select l_orderkey, l_linenumber::bigint as l_linenumber from lineitem where l_quantity < 2 or l_quantity >= 50 union all select p_partkey, -1 from part where p_size <= 1")
def _(t):
    low = t.lineitem.filter(quality.outside_range("l_quantity", 2, None) | quality.outside_range("l_quantity", None, 50, inclusive=False))
    parts = t.part.filter(quality.outside_range("p_size", 1, None, inclusive=False))
    return low.select("l_orderkey", "l_linenumber").union(parts.select("p_partkey", F.lit(-1)))


@query("j07_non_negative", "select c_custkey from customer where c_acctbal < 0")
def _(t):
    check = quality.bind("customer", quality.non_negative("c_acctbal"))[0]
    return check.rows({"customer": t.customer}).select("c_custkey")


@query("j08_no_time_gaps", f"""with p as (select distinct event_type, date_trunc('hour', ts) as ts from events), n as (select *, lead(ts) over (partition by event_type order by ts) as next_ts from p)
  select event_type, {pick('t ts, t next_ts')} from n where next_ts > ts + interval 1 hour""")
def _(t):
    hours = t.events.select("event_type", F.date_trunc("hour", "ts").alias("ts"))
    check = quality.bind("hours", quality.no_time_gaps("ts", "event_type"))[0]
    return check.rows({"hours": hours})


@query("j09_rate_every_day", "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as day from events group by 1 having not bool_or(event_type = 'view' and value > 60)")
def _(t):
    rows = t.events.withColumn("day", F.date_trunc("hour", "ts"))
    return quality.days_without(rows, "day", (F.col("event_type") == "view") & (F.col("value") > 60))


@query("j10_versions_do_not_overlap", """select station_id, station_key from g_station where false
  union all select 'S' || s_suppkey, 'late' from supplier""")
def _(t):
    """The built dimension has no overlap; versions that start a day early are reported."""
    stations = feeds.g_station(t).select("station_id", "station_key", "valid_from_ts_utc", "valid_to_ts_utc")
    early = t.supplier.select(
        F.format_string("S%d", "s_suppkey").alias("station_id"), F.lit("late").alias("station_key"),
        F.lit(datetime(9999, 12, 30)).alias("valid_from_ts_utc"), F.lit(datetime(9999, 12, 31)).alias("valid_to_ts_utc"))
    return joins.overlapping_versions(stations.union(early), "station_id", "station_key").select("station_id", "station_key")


@query("j11_inferred_members", """select 'station' as reference, station_id as member_id from g_station where is_inferred
  union all select 'counter', counter_id from s_counters where is_inferred""")
def _(t):
    return contracts.inferred_members(feeds.s_stations(t), feeds.s_counters(t))


@query("j12_seed_horizon", "select strftime(max(o_orderdate), '%Y-%m-%d') as last_day from orders")
def _(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day"))
    return quality.short_horizon(days, "day", date(2001, 12, 31))


@query("j13_freshness", """select event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as max_loaded_at,
  case when timestamp '2024-01-31' - max(ts) > interval 12 hours then 'error' when timestamp '2024-01-31' - max(ts) > interval 1 hour then 'warn' else 'pass' end as status from events group by 1""")
def _(t):
    kinds = {k: t.events.filter(F.col("event_type") == k) for k in ("view", "click", "purchase", "error", "signup")}
    limits = dict.fromkeys(kinds, (timedelta(hours=1), timedelta(hours=12)))
    rows = quality.freshness_report(kinds, limits, datetime(2024, 1, 31), "ts")
    return rows.select(F.col("table_name").alias("event_type"), "max_loaded_at", "status")


@query("j14_report", """
select 'lineitem' as table_name, 'not_null(l_orderkey)' as check_name, 'error' as severity, 0 as failures, 'pass' as status
union all select 'lineitem', 'accepted_range(l_quantity)', 'warn', count(*), case when count(*) = 0 then 'pass' else 'warn' end from lineitem where l_quantity > 49
union all select 'lineitem', 'unique_together(l_orderkey, l_linenumber)', 'error', count(*), case when count(*) = 0 then 'pass' else 'fail' end from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'lineitem', 'relationship(l_partkey -> part.p_partkey)', 'error', count(*), case when count(*) = 0 then 'pass' else 'fail' end from lineitem where l_partkey not in (select p_partkey from part)
union all select 'customer', 'non_negative(c_acctbal)', 'warn', count(*), case when count(*) = 0 then 'pass' else 'warn' end from customer where c_acctbal < 0
union all select 'events', 'accepted_values(event_type)', 'error', count(*), case when count(*) = 0 then 'pass' else 'fail' end from events where event_type not in ('view', 'click')""")
def _(t):
    q = quality
    checks = [
        *q.bind("lineitem", q.not_null("l_orderkey"), q.accepted_range("l_quantity", high=49, severity=q.WARN),
                q.unique_together("l_orderkey", "l_linenumber"), q.relationship("l_partkey", "part", "p_partkey")),
        *q.bind("customer", q.non_negative("c_acctbal")),
        *q.bind("events", q.accepted_values("event_type", ["view", "click"])),
    ]
    tables = {"lineitem": t.lineitem, "part": t.part, "customer": t.customer, "events": t.events}
    return q.report(tables, checks)


@query("j14_ledger", """with e as (select *, case when event_type = 'error' and event_id % 40 = 0 then -value else value end as v, event_type || user_id % 50 as k from events),
  g as (select k, ts, lead(ts) over (partition by k order by ts) as next_ts from (select distinct k, ts from e))
  select 'not_null(v)' as check_name, 0::bigint as failures, 'pass' as status
  union all select 'non_negative(v)', count(*), 'warn' from e where v < 0
  union all select 'unique_together(ts, k)', count(*), case when count(*) = 0 then 'pass' else 'fail' end from (select 1 from e group by ts, k having count(*) > 1)
  union all select 'relationship(user_id -> supplier.s_suppkey)', count(*), 'fail' from e where user_id not in (select s_suppkey from supplier)
  union all select 'no_time_gaps(ts)', count(*), 'warn' from g where next_ts > ts + interval 1 hour""")
def _(t):
    """Checks of events by day: a first report, then one after the days of some errors were written again."""
    q, path, table = quality, fresh_dir(t.spark, "ledger"), "fact_bike_traffic_daily"
    rows = t.events.select("event_id", "event_type", "user_id", "ts", "value", gold.date_key(F.to_date("ts")).alias("date_key"), F.concat("event_type", F.col("user_id") % 50).alias("k"))
    bad = (F.col("event_type") == "error") & (F.col("event_id") % 40 == 0)
    checks = q.bind(table, q.not_null("v"), q.non_negative("v"), q.relationship("user_id", "supplier", "s_suppkey"), q.no_time_gaps("ts", "k"))
    checks += q.bind("events", q.unique_together("ts", "k"))
    before = rows.withColumn("v", F.col("value"))
    after = rows.withColumn("v", F.when(bad, -F.col("value")).otherwise(F.col("value")))
    ledger.ledger_report(path, {table: before, "events": before, "supplier": t.supplier}, checks).count()
    days = incremental.Days(rows.filter(bad).select(F.to_date("ts")))
    found = ledger.ledger_report(path, {table: after, "events": after, "supplier": t.supplier}, checks, {table: days})
    return found.select("check_name", "failures", "status")
