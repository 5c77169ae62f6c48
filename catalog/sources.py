"""Sources, landing and sinks (A)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from catalog import feeds
from catalog.registry import pick, query
from citylake.functions.json import nested_to_json
from citylake.functions.time import local_day_bounds
from citylake.plans.warehouse import write_table
from citylake.session import fresh_dir
from citylake.sources import feeds as source_feeds, landing
from citylake.sources.payloads import (
    clip_half_open,
    collapse_series,
    explode_features,
    explode_records,
    latest_coordinates,
    unzip_columnar,
    xml_points,
)
from citylake.sources.schemas import DETECTION_RECORD
from citylake.sources.seed import read_seed


def chunks(df, key: str, size: int):
    """Number of the payload a row travels in: a payload holds at most `size` records."""
    return df.withColumn("chunk", F.floor(F.col(key) / size))


@query("a01_hive_scan", "select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n, round(sum(value::decimal(18,6))::double, 6) as total "
       "from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-21' group by 1")
def _(t):
    path = fresh_dir(t.spark, "scan")
    landing.write_partitions(t.events.withColumn("load_date", F.to_date("ts")), path)
    rows = t.spark.read.parquet(path).filter(F.col("load_date").between(date(2024, 1, 5), date(2024, 1, 20)))
    return rows.groupBy("load_date").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,6)")).alias("total")
    )


@query("a02_csv_seed", "select n_nationkey::bigint as n_nationkey, n_name, n_regionkey::bigint as n_regionkey from nation")
def _(t):
    path = fresh_dir(t.spark, "seed")
    t.nation.write.option("header", True).csv(path)
    return read_seed(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("a03_features", f"select 'C' || c_custkey as id, c_name as name, round({feeds.SQL_X.format(k='c_custkey')}, 6) as lon, "
       f"round({feeds.SQL_Y.format(k='c_custkey')}, 6) as lat from customer")
def _(t):
    k = "c_custkey"
    geometry = F.struct(F.lit("Point").alias("type"), F.array(
        F.expr(feeds.POINT_X.format(k=k)), F.expr(feeds.POINT_Y.format(k=k))).alias("coordinates"))
    properties = F.struct(F.format_string("C%d", k).alias("id"), F.col("c_name").alias("name"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))
    payloads = chunks(t.customer, k, 50).groupBy("chunk").agg(F.collect_list(feature).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("payload"))
    point = F.from_json("geometry", "coordinates array<double>")["coordinates"]
    return explode_features(payloads, "id string, name string").select("id", "name", point[0].alias("lon"), point[1].alias("lat"))


@query("a04_raw_rows", """select event_id, event_type, '{"type":"' || event_type || '","value":null}' as detail,
       '[' || event_id || ',' || user_id || ']' as ids from events""")
def _(t):
    rows = t.events.select(
        "event_id", "event_type",
        F.struct(F.col("event_type").alias("type"), F.lit(None).cast("int").alias("value")).alias("detail"),
        F.array("event_id", "user_id").alias("ids"))
    return rows.select(*nested_to_json(rows.schema))


@query("a05_records", "select 'list' as shape, 'C' || user_id as locations_id, event_type as id, round(value, 6) as value from events "
       "union all select 'rates', 'C' || user_id, event_type, round(value, 6) from events")
def _(t):
    record = F.struct(F.format_string("C%d", "user_id").alias("locations_id"), F.col("event_type").alias("id"), "value")
    grouped = chunks(t.events, "event_id", 100).groupBy("chunk").agg(F.collect_list(record).alias("rates"))
    plain = grouped.select(F.to_json("rates").alias("payload"))
    missing = F.to_json(F.struct(F.lit("no data").alias("error")))
    # Every second payload is an error document without the list.
    rooted = grouped.select(F.explode(F.array(F.to_json(F.struct("rates")), missing)).alias("payload"))
    parts = [
        explode_records(plain, DETECTION_RECORD).withColumn("shape", F.lit("list")),
        explode_records(rooted, DETECTION_RECORD, root="rates").withColumn("shape", F.lit("rates")),
    ]
    return parts[0].unionByName(parts[1]).select("shape", "locations_id", "id", "value")


VARIABLES = ("temperature_2m", "precipitation")


def _locations(t):
    """24 hours per location, from consecutive events; at most ten locations per answer."""
    hour = F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "value")
    grouped = chunks(t.events, "event_id", 24).groupBy("chunk").agg(F.sort_array(F.collect_list(hour)).alias("h"))
    hourly = F.struct(
        F.col("h.time").alias("time"),
        F.col("h.value").alias("temperature_2m"),
        F.transform("h", lambda x: x["event_id"] % 5).alias("precipitation"))
    location = F.struct(
        "chunk", F.col("chunk").cast("double").alias("latitude"), F.lit(50.5).alias("longitude"),
        F.lit(200.0).alias("elevation"), F.lit("UTC").alias("timezone"),
        F.struct(F.lit("mm").alias("precipitation")).alias("hourly_units"), hourly.alias("hourly"))
    station = F.struct("chunk", F.format_string("L%d", "chunk").alias("station_id"),
                       F.col("chunk").cast("double").alias("latitude"), F.lit(50.0).alias("longitude"))
    return grouped.select("chunk", location.alias("location"), station.alias("station"))


_HOURS = """select 'L' || event_id // 24 as station_id, (event_id // 24)::double as requested_latitude, 50.5::double as longitude,
  strftime(ts, '%Y-%m-%dT%H:%M') as time, round(value, 6) as temperature_2m, (event_id % 5)::double as precipitation,
  '{"precipitation":"mm"}' as hourly_units from events"""
_HOUR_COLUMNS = ("station_id", "requested_latitude", "longitude", "time", *VARIABLES, "hourly_units")


@query("a06_unzip_columnar", _HOURS)
def _(t):
    answers = _locations(t).groupBy(F.floor(F.col("chunk") / 10).alias("answer")).agg(
        F.sort_array(F.collect_list("location")).alias("l"), F.sort_array(F.collect_list("station")).alias("stations"))
    return unzip_columnar(answers.select(F.to_json("l").alias("payload"), "stations"), VARIABLES).select(*_HOUR_COLUMNS)


@query("a07_positional_identity", _HOURS)
def _(t):
    single = _locations(t).select(F.to_json("location").alias("payload"), F.array("station").alias("stations"))
    return unzip_columnar(single, VARIABLES).select(*_HOUR_COLUMNS)


def _documents(t):
    """One document per 48 events, which stand at every second position."""
    kept = chunks(t.events, "event_id", 48)
    point = F.struct("event_id", F.format_string(
        "<Point><position>%d</position><price.amount>%s</price.amount></Point>",
        F.expr("event_id % 48 * 2 + 1"), F.col("value").cast("string")).alias("x"))
    grouped = kept.groupBy("chunk").agg(F.sort_array(F.collect_list(point)).alias("p"))
    begin = F.timestamp_seconds(F.lit(1704060000) + F.col("chunk") * 86400)
    text = F.format_string(
        "<?xml version=\"1.0\"?><Publication_MarketDocument xmlns=\"urn:x\"><TimeSeries><curveType>A03</curveType><Period>"
        "<timeInterval><start>%s</start><end>%s</end></timeInterval><resolution>PT15M</resolution>%s</Period></TimeSeries>"
        "</Publication_MarketDocument>",
        F.date_format(begin, "yyyy-MM-dd'T'HH:mm'Z'"),
        F.date_format(begin + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm'Z'"), F.array_join("p.x", ""))
    return grouped.select("chunk", text.alias("payload"))


@query("a08_xml_series", """
with g as (select c, p from (select distinct event_id // 48 as c from events), (select unnest(range(0, 96)) as p)),
v as (select event_id // 48 as c, event_id % 48 * 2 as p, value from events)
select strftime(timestamp '2023-12-31 22:00:00' + to_days(g.c::int) + to_minutes(g.p * 15), '%Y-%m-%d %H:%M:%S') as ts_utc,
  round(v.value, 6) as value, 'EUR/MWh' as unit, 'area' as area_code
from g asof join v on g.c = v.c and g.p >= v.p""")
def _(t):
    return xml_points(_documents(t).select("payload"), "price.amount", "EUR/MWh", "area")


@query("a09_duplicate_series", f"select {pick('t ts')}, round(value, 6) as value, event_type from events")
def _(t):
    rows = t.events.select("ts", "value", "event_type")
    return collapse_series(rows.unionByName(rows), ["ts", "event_type"])


@query("a10_half_open_clip", f"select event_id, {pick('t ts')} from events where ts >= timestamp '2024-01-08 22:00:00' and ts < timestamp '2024-01-09 22:00:00'")
def _(t):
    clipped = clip_half_open(t.events, "ts", F.lit("2024-01-08 22:00:00").cast("timestamp"), F.lit("2024-01-09 22:00:00").cast("timestamp"))
    return clipped.select("event_id", "ts")


_UTC = "timezone('UTC', timezone('Europe/Prague', {d}::timestamp))"


@query("a11_delivery_day", f"""select strftime(d, '%Y-%m-%d') as day, strftime({_UTC.format(d='d')}, '%Y-%m-%d %H:%M:%S') as start_utc,
  datediff('hour', {_UTC.format(d='d')}, {_UTC.format(d='(d + interval 1 day)')}) as hours
  from (select distinct o_orderdate::date as d from orders)""")
def _(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    start, end = local_day_bounds("day")
    return days.select("day", start.alias("start_utc"), F.timestamp_diff("HOUR", start, end).alias("hours"))


@query("a12_day_split", "select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n from events group by 1")
def _(t):
    text = t.events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"))
    return text.groupBy(landing.day_of_text("time").alias("load_date")).agg(F.count("*").alias("n"))


@query("a13_bronze_writer", """select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n, '2024-02-02 00:00:00' as _loaded_at
  from events where ts < timestamp '2024-01-03' group by 1
  union all select strftime(ts, '%Y-%m-%d'), count(*), '2024-02-01 00:00:00' from events where ts >= timestamp '2024-01-03' group by 1""")
def _(t):
    """Landed, partly landed again, and an empty batch on top."""
    root = fresh_dir(t.spark, "bronze")
    rows = feeds.air_history(t).drop("_loaded_at")
    first, second = (F.lit(f"2024-02-0{n} 00:00:00").cast("timestamp") for n in (1, 2))
    landing.land(rows, root, "air_history", "load_date", first)
    landing.land(rows.filter("load_date < date'2024-01-03'"), root, "air_history", "load_date", second)
    landing.land(rows.filter("load_date < date'2000-01-01'"), root, "air_history", "load_date", second)
    return landing.read_bronze(t.spark, root, "air_history").groupBy("load_date").agg(
        F.count("*").alias("n"), F.max("_loaded_at").alias("_loaded_at"))


@query("a13_source_feeds", """
with d as (select ts::date as day, count(*) as n from events group by 1)
select s.source, strftime(s.day, '%Y-%m-%d') as load_date, s.n, '2024-02-0' || (case when s.day = date '2024-01-03' then 3 when s.day >= date '2024-01-14' then 2 else 1 end) || ' 00:00:00' as _loaded_at,
  strftime((select max(day) from d), '%Y-%m-%d') as mark
from (select 'air_history' as source, * from d union all select 'fx_daily', * from d) s""")
def _(t):
    """Two feeds, several payloads a day: the first half, the rest with two days again, and one late day that is landed last."""
    root = fresh_dir(t.spark, "feeds")
    day = F.to_date("ts").alias("requested_day")
    records = F.struct(F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"), F.lit("{}").alias("measurement"))
    cut = chunks(t.events, "event_id", 200)
    history = cut.groupBy(day, "chunk").agg(F.to_json(F.collect_list(records)).alias("payload")).drop("chunk")
    rate = F.struct(F.col("event_type").alias("currencyCode"), F.lit(1).alias("amount"), F.col("value").alias("rate"))
    rates = cut.groupBy(day, "chunk").agg(F.to_json(F.struct(F.collect_list(rate).alias("rates"))).alias("payload")).drop("chunk")
    loads = (("requested_day <= date'2024-01-15'", 1), ("requested_day >= date'2024-01-14'", 2), ("requested_day = date'2024-01-03'", 3))
    parts = []
    for source, texts in (("air_history", history.withColumn("file_path", F.lit("events"))), ("fx_daily", rates)):
        for some, run in loads:
            payload = texts.filter(some)
            source_feeds.land(payload.drop("requested_day") if source == "air_history" else payload, root, source, datetime(2024, 2, run))
        mark = landing.last_loaded(t.spark, root, source)
        counts = landing.read_bronze(t.spark, root, source).groupBy("load_date").agg(F.count("*").alias("n"), F.max("_loaded_at").alias("_loaded_at"))
        parts.append(counts.select(F.lit(source).alias("source"), "load_date", "n", "_loaded_at", F.lit(mark).alias("mark")))
    return parts[0].unionByName(parts[1])


@query("a14_stable_schema", "select l_returnflag, 'double' as kind, sum(l_linenumber)::double as total from lineitem group by 1")
def _(t):
    typed = landing.as_doubles(t.lineitem.select("l_returnflag", "l_linenumber"), ["l_linenumber", "absent"])
    return typed.groupBy("l_returnflag").agg(
        F.max(F.typeof("l_linenumber")).alias("kind"), F.sum("l_linenumber").alias("total"))


def _marks(t):
    return t.events.select(
        F.col("event_type").alias("source"), F.to_date("ts").alias("last_loaded_date"), F.col("ts").alias("updated_at"))


@query("a15_high_water_mark", "select event_type as source, strftime(max(ts), '%Y-%m-%d') as last_loaded_date, "
       "strftime(max(ts), '%Y-%m-%d %H:%M:%S') as updated_at from events group by 1")
def _(t):
    return landing.high_water_marks(_marks(t))


@query("a16_load_window", "select event_id from events where event_type = 'view' and ts::date between "
       "(select max(ts)::date - 3 from events where event_type = 'view') and date '2024-02-15'")
def _(t):
    last = landing.high_water_marks(_marks(t)).filter("source = 'view'").first()["last_loaded_date"]
    start, end = landing.resolve_window(last, today=date(2024, 2, 15), reload_days=3)
    day = F.to_date("ts")
    return t.events.filter((F.col("event_type") == "view") & day.between(start, end)).select("event_id")


@query("a17_future_clamp", "select event_id from events where ts::date between date '2024-01-10' and date '2024-01-12'")
def _(t):
    today = date(2024, 1, 12)
    start, end = landing.resolve_window(None, today, date(2024, 1, 10), today + timedelta(days=9), clamp_future=True)
    return t.events.filter(F.to_date("ts").between(start, end)).select("event_id")


@query("a18_day_range", """select strftime(d, '%Y-%m-%d') as load_date, count(o_orderkey) as n
  from (select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day))::date as d from orders)
  left join orders on o_orderdate::date = d group by 1""")
def _(t):
    orders = t.orders.select(F.to_date("o_orderdate").alias("load_date"))
    bounds = orders.agg(F.min("load_date").alias("lo"), F.max("load_date").alias("hi")).first()
    counts = orders.groupBy("load_date").agg(F.count("*").alias("n"))
    return landing.day_range(t.spark, bounds["lo"], bounds["hi"]).join(counts, "load_date", "left").select(
        "load_date", F.coalesce("n", F.lit(0)).alias("n"))


@query("a19_latest_coordinates", f"select 'S' || s_suppkey as station_id, round({feeds.SQL_Y.format(k='s_suppkey')}, 6) as latitude, "
       f"round({feeds.SQL_X.format(k='s_suppkey')}, 6) as longitude from supplier")
def _(t):
    return latest_coordinates(feeds.air_stations(t))


@query("a20_layer_sinks", "select l_returnflag, count(*) as n, max(l_orderkey) as newest from lineitem group by 1")
def _(t):
    silver = write_table(t.lineitem.select("l_returnflag", "l_orderkey"), fresh_dir(t.spark, "silver"))
    gold = silver.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.max("l_orderkey").alias("newest"))
    return write_table(gold, fresh_dir(t.spark, "gold"))
