"""Projections, joins, sorts, sets and scalar functions (B, C, F, G, H)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window, functions as F

from catalog import feeds
from catalog.registry import local, query
from citylake.functions.columns import in_list, rounded_int, typed_null
from citylake.functions.geo import contains, point_lon_lat
from citylake.functions.json import json_double, json_int, json_text
from citylake.functions.keys import surrogate_key
from citylake.functions.time import (
    calendar_parts,
    date_key,
    days_between,
    expected_slots,
    hour_start,
    instant,
    local_date,
    local_ts,
    span,
)
from citylake.operators import joins, sampling
from citylake.operators.dedup import latest_value
from citylake.operators.fill import densify, value_on, value_runs
from citylake.operators.incremental import lookback_start
from citylake.operators.scd2 import add_unknown, lookup
from citylake.operators.spatial import spatial_join
from citylake.operators.stats import null_share

# ---------------------------------------------------------------- B projections and filters


@query("b01_rename_cast", "select l_orderkey::varchar as order_id, round_even(l_extendedprice, 0)::bigint as price, "
       "strftime(l_shipdate, '%Y-%m-%d') as ship_day, l_linenumber::bigint as line from lineitem")
def _(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("order_id"), rounded_int("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("ship_day"), F.col("l_linenumber").alias("line"))


@query("b02_units", "select l_orderkey, l_linenumber::bigint as l_linenumber, round(l_extendedprice / l_quantity, 6) as per_unit, "
       "round(l_quantity / 3.6::double, 6) as metres from lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.try_divide("l_extendedprice", "l_quantity").alias("per_unit"),
        (F.col("l_quantity") / 3.6).alias("metres"))


@query("b03_coalesce", "select c_custkey, coalesce('d' || n_nationkey, '-1') as district, coalesce(n_nationkey < 10, true) as flag "
       "from customer left join nation on c_nationkey = n_nationkey and n_nationkey < 20")
def _(t):
    nations = t.nation.filter("n_nationkey < 20").select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("d"), "n_nationkey").alias("district"),
        (F.col("n_nationkey") < 10).alias("flag"))
    return lookup(t.customer, nations, "c_nationkey", ["district", "flag"], {"district": "-1", "flag": True}).select(
        "c_custkey", "district", "flag")


@query("b04_case", "select o_orderkey, case when o_orderstatus = 'F' then 'done' when o_totalprice > 250000 then 'large' else 'open' end as state from orders")
def _(t):
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_totalprice") > 250000, "large").otherwise("open")
    return t.orders.select("o_orderkey", state.alias("state"))


@query("b05_null_flags", "select c_custkey, c_custkey not in (select o_custkey from orders) as is_inactive from customer")
def _(t):
    active = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_found", F.lit(True))
    return t.customer.join(active, "c_custkey", "left").select("c_custkey", F.col("_found").isNull().alias("is_inactive"))


@query("b06_in_lists", "select p_partkey, p_size in (6, 7) as is_weekend, p_size not in (6, 7) and p_brand <> 'Brand#2' as is_working from part")
def _(t):
    weekend = F.col("p_size").isin(6, 7)
    return t.part.select("p_partkey", weekend.alias("is_weekend"), (~weekend & (F.col("p_brand") != "Brand#2")).alias("is_working"))


@query("b07_filters", "select l_orderkey, l_partkey from lineitem where l_returnflag = 'R' and l_quantity between 10 and 20 "
       "and l_shipdate >= timestamp '1998-01-01' and l_partkey is not null")
def _(t):
    shipped = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return t.lineitem.filter(
        (F.col("l_returnflag") == "R") & F.col("l_quantity").between(10, 20) & shipped & F.col("l_partkey").isNotNull()
    ).select("l_orderkey", "l_partkey")


@query("b08_optional_list", "select 'some' as filter, count(*) as n from orders where o_orderpriority in ('1-URGENT', '2-HIGH') "
       "union all select 'all', count(*) from orders")
def _(t):
    some = t.orders.filter(in_list("o_orderpriority", ["1-URGENT", "2-HIGH"])).agg(F.count("*").alias("n"))
    every = t.orders.filter(in_list("o_orderpriority", [])).agg(F.count("*").alias("n"))
    return some.select(F.lit("some").alias("filter"), "n").unionByName(every.select(F.lit("all").alias("filter"), "n"))


@query("b09_typed_nulls", "select s_suppkey, s_name, null::double as latitude, true as is_inferred from supplier")
def _(t):
    return t.supplier.select("s_suppkey", "s_name", typed_null("double").alias("latitude"), F.lit(True).alias("is_inferred"))


@query("b10_having", "select l_suppkey, count(*) as n from lineitem group by 1 having bool_and(l_quantity > 0) and count(*) > 550")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.bool_and(F.col("l_quantity") > 0).alias("ok")).filter(
        "ok and n > 550").drop("ok")


@query("b11_qualify", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) <= 2")
def _(t):
    best = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.withColumn("rank", F.row_number().over(best)).filter("rank <= 2").select("o_custkey", "o_orderkey")


@query("b12_scalar_bounds", "select event_id from events where ts >= (select max(ts) from events) - interval 3 days")
def _(t):
    return t.events.filter(F.col("ts") >= lookback_start(t.events, "ts", 3)).select("event_id")


# ---------------------------------------------------------------- C joins


@query("c01_dimension_lookup", "select n_name, count(*) as n, round(sum(c_acctbal::decimal(18,6))::double, 6) as balance from customer left join nation on c_nationkey = n_nationkey group by 1")
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,6)")).alias("balance"))


@query("c02_composite_key", """select a.l_partkey, a.l_suppkey, a.n, b.n as n_returned
  from (select l_partkey, l_suppkey, count(*) as n from lineitem group by all) a
  left join (select l_partkey, l_suppkey, count(*) as n from lineitem where l_returnflag = 'R' group by all) b using (l_partkey, l_suppkey)""")
def _(t):
    keys = ["l_partkey", "l_suppkey"]
    every = t.lineitem.groupBy(*keys).agg(F.count("*").alias("n"))
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.count("*").alias("n_returned"))
    return every.join(returned, keys, "left")


@query("c03_star", """select r_name, p_brand, count(*) as n, round(sum(l_extendedprice::decimal(18,6))::double, 6) as revenue
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey where o_orderstatus = 'F' group by all""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    return (
        lines.join(t.orders.filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("r_name", "p_brand")
        .agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,6)")).alias("revenue"))
    )


def _intervals(t, orders=None):
    """Validity intervals per customer: one version per order day, until the next order day."""
    days = (orders or t.orders).groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.max("o_orderkey").alias("version"))
    nxt = F.lead("day").over(Window.partitionBy("o_custkey").orderBy("day"))
    return days.select(
        F.col("o_custkey").alias("cust"), "version", F.col("day").cast("timestamp").alias("valid_from_ts_utc"),
        F.coalesce(nxt, F.lit(date(9999, 12, 31))).cast("timestamp").alias("valid_to_ts_utc"))


def _shipments(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("ship_ts"))
    keys = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cust"))
    return lines.join(keys, "l_orderkey")


_INTERVAL_SQL = """
with v as (select o_custkey as cust, o_orderdate::date as d, max(o_orderkey) as version from orders group by all),
s as (select o_custkey as cust, l_shipdate::date as d from lineitem join orders on l_orderkey = o_orderkey)
select version, count(*) as n_lines from s asof left join v on s.cust = v.cust and s.d >= v.d group by 1"""


@query("c04_interval_join", _INTERVAL_SQL)
def _(t):
    joined = joins.interval_join(_shipments(t), _intervals(t), "cust", "ship_ts")
    return joined.groupBy("version").agg(F.count("*").alias("n_lines"))


@query("c04_interval_join_by_month", _INTERVAL_SQL)
def _(t):
    joined = joins.interval_join(_shipments(t), _intervals(t), "cust", "ship_ts", by_month=True)
    return joined.groupBy("version").agg(F.count("*").alias("n_lines"))


@query("c04_interval_join_merged", """
with v as (select o_custkey % 5 as k, o_orderdate::date as d, max(o_orderkey) as version from orders group by all),
s as (select o_custkey % 5 as k, l_shipdate::date as d from lineitem join orders on l_orderkey = o_orderkey)
select version, count(*) as n_lines from s asof left join v on s.k = v.k and s.d >= v.d group by 1""")
def _(t):
    """Five keys with a version per day: far more versions than a fact may be held against."""
    orders = t.orders.withColumn("o_custkey", F.col("o_custkey") % 5)
    lines = _shipments(t).withColumn("cust", F.col("cust") % 5)
    joined = joins.interval_join(lines, _intervals(t, orders), "cust", "ship_ts")
    return joined.groupBy("version").agg(F.count("*").alias("n_lines"))


@query("c05_spatial_join", f"select c.counter_id, 'd' || p.k as district_slug from q_counters c left join q_polygons p on {feeds.INSIDE}")
def _(t):
    k = "c_custkey"
    points = t.customer.select(
        F.format_string("C%d", k).alias("counter_id"), F.expr(feeds.POINT_X.format(k=k)).alias("longitude"),
        F.expr(feeds.POINT_Y.format(k=k)).alias("latitude"))
    polygons = feeds.city_districts(t).filter("load_date = date'2024-01-01'").select(
        F.col("slug").alias("district_slug"), F.col("geometry").alias("geometry_geojson"))
    return spatial_join(points, polygons, cell=0.02).select("counter_id", "district_slug")


@query("c06_dense_grid", """with v as (select ts::date as d, user_id, count(*) as n from events group by all)
  select strftime(d, '%Y-%m-%d') as day, user_id, coalesce(n, 0) as n, n is null as is_forward_filled
  from (select d, user_id from (select unnest(generate_series(min(d), max(d), interval 1 day))::date as d from v), (select distinct user_id from v))
  left join v using (d, user_id)""")
def _(t):
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count("*").alias("n"))
    return densify(daily, "user_id", "day").withColumn("n", F.coalesce("n", F.lit(0)))


@query("c06_run_lookup", """with v as (select c_nationkey as nation, o_orderdate::date as day, max(o_totalprice) as top from orders join customer on o_custkey = c_custkey where o_orderstatus = 'F' group by all),
  a as (select o_orderkey, c_nationkey as nation, o_orderdate::date as d from orders join customer on o_custkey = c_custkey)
  select a.o_orderkey, strftime(v.day, '%Y-%m-%d') as known_day, round(v.top, 6) as top from a asof left join v on v.nation = a.nation and a.d >= v.day""")
def _(t):
    """Every order meets the last known best finished order of its nation; no row is made for a day without orders."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.col("c_nationkey").alias("nation"), F.to_date("o_orderdate").alias("day"))
    best = orders.filter("o_orderstatus = 'F'").groupBy("nation", "day").agg(F.max("o_totalprice").alias("top"))
    asked = orders.select("o_orderkey", "nation", "day")
    return value_on(asked, value_runs(best, "nation", "day"), "nation", "day", "day", ["top"]).select("o_orderkey", "known_day", "top")


@query("c07_one_row_relation", """select o_orderkey, round(o_totalprice * (select arg_max(o_totalprice, (o_orderdate, o_orderkey)) from orders) / 1000000, 3) as scaled from orders""")
def _(t):
    latest = latest_value(t.orders, "o_totalprice", F.struct("o_orderdate", "o_orderkey"))
    scaled = joins.with_scalar(t.orders, "rate", latest)
    return scaled.select("o_orderkey", F.round(F.col("o_totalprice") * F.col("rate") / 1000000, 3).alias("scaled"))


@query("c08_not_in", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def _(t):
    return joins.not_in(t.customer, "c_custkey", t.orders.filter("o_totalprice > 300000"), "o_custkey").select("c_custkey")


@query("c09_anti", "select p_partkey from part left join lineitem on p_partkey = l_partkey and l_quantity > 49 where l_partkey is null")
def _(t):
    return joins.anti(t.part, t.lineitem.filter("l_quantity > 49"), "p_partkey", "l_partkey").select("p_partkey")


@query("c10_semi", "select n_name from nation where n_nationkey in (select c_nationkey from customer where c_acctbal > 5000 union select s_nationkey from supplier)")
def _(t):
    used = t.customer.filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()
    return joins.semi(t.nation, used, "n_nationkey", "k").select("n_name")


@query("c11_group_minimum", """select o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as first_day from orders
  qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1""")
def _(t):
    first = t.orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("f"))
    return first.select("o_custkey", F.col("f.o_orderkey").alias("o_orderkey"), F.to_date("f.o_orderdate").alias("first_day"))


@query("c12_overlap", """
with v as (select l_orderkey as ord, l_linenumber::bigint as line, min(l_shipdate) as valid_from, max(l_shipdate + to_days(l_quantity::int)) as valid_to from lineitem group by all)
select a.ord, a.line, max({'until': b.valid_to, 'line': b.line}).line as overlapping_line from v a join v b on a.ord = b.ord
  and (b.valid_from, b.line) < (a.valid_from, a.line) group by a.ord, a.line, a.valid_from having max(b.valid_to) > a.valid_from""")
def _(t):
    until = F.expr("l_shipdate + make_dt_interval(cast(l_quantity as int))")
    windows = t.lineitem.groupBy(F.col("l_orderkey").alias("ord"), F.col("l_linenumber").cast("bigint").alias("line")).agg(
        F.min("l_shipdate").alias("valid_from"), F.max(until).alias("valid_to"))
    return joins.overlapping_versions(windows, "ord", "line", "valid_from", "valid_to")


@query("c13_full_outer", """select strftime(coalesce(o.d, s.d), '%Y-%m-%d') as day, o.n as n_orders, s.n as n_shipments
  from (select o_orderdate::date as d, count(*) as n from orders group by 1) o
  full join (select l_shipdate::date as d, count(*) as n from lineitem group by 1) s on o.d = s.d""")
def _(t):
    ordered = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n_orders"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n_shipments"))
    return joins.outer_merge(ordered, shipped, "day")


@query("c14_orphans", "select user_id, count(*) as failures from events where user_id not in (select s_suppkey from supplier) group by 1")
def _(t):
    return joins.orphans(t.events, "user_id", t.supplier, "s_suppkey")


# ---------------------------------------------------------------- F sorts and samples


@query("f01_order_by", "select o_orderpriority, o_orderstatus, count(*) as n from orders group by all order by 1 desc, 2")
def _(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).orderBy(
        F.desc("o_orderpriority"), "o_orderstatus")


@query("f02_top_k", "select o_custkey, round(sum(o_totalprice::decimal(18,6))::double, 6) as total from orders group by 1 order by 2 desc, 1 limit 3")
def _(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,6)")).alias("total"))
    return sampling.top_k(totals, [F.desc("total"), F.asc("o_custkey")], 3)


@query("f03_exact_sample", """select o_orderkey, o_orderpriority from orders
  order by ('0x' || substr(md5('42|' || o_orderkey || '|' || o_orderpriority), 1, 15))::bigint, o_orderkey limit 500""")
def _(t):
    return sampling.exact_sample(t.orders.select("o_orderkey", "o_orderpriority"), 500)


@query("f03_sample_size", "select least(500, count(*)) as n_rows, least(500, count(*)) as n_distinct, least(500, count(*)) as n_known from orders")
def _(t):
    """Exactly n rows, all different, all from the table."""
    sample = sampling.exact_sample(t.orders, 500)
    known = joins.semi(sample, t.orders, "o_orderkey")
    return sample.agg(F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_distinct")).withColumn(
        "n_known", known.agg(F.count("*")).scalar())


@query("f04_top_missing", """select 'n_small' as "column", round(avg((l_quantity >= 5)::int) * 100, 2) as null_pct from lineitem
  union all select 'n_r', round(avg((l_returnflag <> 'R')::int) * 100, 2) from lineitem""")
def _(t):
    rows = t.lineitem.select(
        F.when(F.col("l_quantity") < 5, 1).alias("n_small"), F.when(F.col("l_returnflag") == "R", 1).alias("n_r"), "l_orderkey")
    return sampling.top_k(null_share(rows), [F.desc("null_pct"), F.asc("column")], 2)


# ---------------------------------------------------------------- G sets


@query("g01_union_all", "select r_regionkey::bigint as r_regionkey, r_name from region union all select -1, 'Unknown'")
def _(t):
    return add_unknown(t.region.select("r_regionkey", "r_name"), {"r_regionkey": -1, "r_name": "Unknown"})


@query("g02_union", "select c_nationkey::bigint as k from customer union select s_nationkey from supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


# ---------------------------------------------------------------- H scalar functions

ORDER_TS = "o_orderdate + to_hours(o_orderkey % 24)"


def _order_times(t):
    shift = F.expr("make_dt_interval(0, cast(o_orderkey % 24 as int))")
    return t.orders.select("o_orderkey", (F.col("o_orderdate").cast("timestamp") + shift).alias("ts"))


@query("h01_date_trunc", f"select event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, strftime(date_trunc('year', ts), '%Y-%m-%d') as year from events")
def _(t):
    return t.events.select("event_id", hour_start("ts").alias("hour"), F.date_trunc("year", "ts").cast("date").alias("year"))


@query("h02_interval_shift", "select event_id, strftime(date_trunc('hour', ts) - interval 1 hour, '%Y-%m-%d %H:%M:%S') as measured_hour, strftime(ts + interval 5 minutes, '%Y-%m-%d %H:%M:%S') as slot_end from events")
def _(t):
    return t.events.select("event_id", (hour_start("ts") - span(1, "hour")).alias("measured_hour"), (F.col("ts") + span(5, "minute")).alias("slot_end"))


@query("h03_local_timestamp", f"select o_orderkey, strftime({local(ORDER_TS)}, '%Y-%m-%d %H:%M:%S') as local_ts from orders")
def _(t):
    return _order_times(t).select("o_orderkey", local_ts("ts").alias("local_ts"))


@query("h04_local_date", f"select o_orderkey, strftime({local(ORDER_TS)}, '%Y-%m-%d') as local_date from orders")
def _(t):
    return _order_times(t).select("o_orderkey", local_date("ts").alias("local_date"))


@query("h05_date_key", f"select o_orderkey, strftime({local(ORDER_TS)}, '%Y%m%d')::bigint as date_key from orders")
def _(t):
    return _order_times(t).select("o_orderkey", date_key(local_date("ts")).alias("date_key"))


@query("h06_expected_slots", """select strftime(d, '%Y-%m-%d') as day, datediff('minute', timezone('Europe/Prague', d::timestamp), timezone('Europe/Prague', (d + interval 1 day)::timestamp)) // 5 as slots
  from (select distinct o_orderdate::date as d from orders)""")
def _(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", expected_slots("day").alias("slots"))


_PARTS = """select strftime(d, '%Y-%m-%d') as date_day, year(d) as calendar_year, quarter(d) as calendar_quarter, month(d) as calendar_month,
  day(d) as day_of_month, isodow(d) as iso_day_of_week, dayname(d) as day_name, weekofyear(d) as iso_week, isoyear(d) as iso_year"""


@query("h07_calendar_parts", f"{_PARTS} from (select distinct o_orderdate::date as d from orders)")
def _(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("date_day")).distinct()
    return days.select("date_day", *[c.cast("bigint" if n != "day_name" else "string").alias(n) for n, c in calendar_parts("date_day").items()])


@query("h08_date_arithmetic", "select o_orderkey, strftime(o_orderdate::date + 30, '%Y-%m-%d') as due, date '2002-01-01' - o_orderdate::date as age, strftime(o_orderdate::date + interval 1 month, '%Y-%m-%d') as next_month from orders")
def _(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.date_add(day, 30).alias("due"), F.date_diff(F.lit(date(2002, 1, 1)), day).alias("age"),
        F.add_months(day, 1).alias("next_month"))


@query("h09_date_spine", "select strftime(unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day)), '%Y-%m-%d') as date_day from orders")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return bounds.select(F.explode(days_between("lo", "hi")).alias("date_day"))


@query("h10_iso_text", "select event_id, epoch_us(ts) as zulu_us, epoch(date_trunc('minute', ts))::bigint as naive_s from events")
def _(t):
    zulu = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return t.events.select(
        "event_id", F.unix_micros(instant(zulu)).alias("zulu_us"), F.unix_seconds(instant(naive)).alias("naive_s"))


@query("h11_json_scalar", "select event_id, json_extract_string(props, '$.k') as k_text, (props->>'$.k')::double as k_double, (props->>'$.k')::bigint as k_int from events")
def _(t):
    return t.events.select(
        "event_id", json_text("props", "$.k").alias("k_text"), json_double("props", "$.k").alias("k_double"), json_int("props", "$.k").alias("k_int"))


@query("h12_json_explode", "select event_id, unnest([user_id, event_id % 3]) as item from events where event_type <> 'error'")
def _(t):
    """Errors hold an empty array and yield nothing."""
    text = F.when(F.col("event_type") == "error", F.lit("[]")).otherwise(F.to_json(F.array("user_id", F.expr("event_id % 3"))))
    return t.events.select("event_id", F.explode(F.from_json(text, "array<bigint>")).alias("item"))


@query("h13_geojson_point", f"select c_custkey, round({feeds.SQL_X.format(k='c_custkey')}, 6) as lon, round({feeds.SQL_Y.format(k='c_custkey')}, 6) as lat from customer")
def _(t):
    k = "c_custkey"
    geometry = F.format_string('{"type": "Point", "coordinates": [%s, %s]}', F.expr(feeds.POINT_X.format(k=k)).cast("string"), F.expr(feeds.POINT_Y.format(k=k)).cast("string"))
    lon, lat = point_lon_lat(geometry)
    return t.customer.select(k, lon.alias("lon"), lat.alias("lat"))


@query("h14_contains", """select c_custkey, x > 0 and x < 10 and y > 0 and y < 10 and not (x >= 4 and x <= 6 and y >= 4 and y <= 6) as inside
  from (select c_custkey, c_custkey % 13 - 1 as x, (c_custkey // 13) % 13 - 1 as y from customer)""")
def _(t):
    """Integer points over a square with a square hole: edges and corners count as outside."""
    square = '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[4,4],[6,4],[6,6],[4,6],[4,4]]]}'
    point = F.format_string('{"type":"Point","coordinates":[%d,%d]}', F.expr("c_custkey % 13 - 1"), F.expr("(c_custkey div 13) % 13 - 1"))
    return t.customer.select("c_custkey", contains(F.lit(square), point).alias("inside"))


@query("h15_surrogate_key", "select o_orderkey, md5(o_orderkey::varchar || '-' || case when o_orderstatus = 'O' then '_dbt_utils_surrogate_key_null_' else o_orderstatus end) as key from orders")
def _(t):
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", surrogate_key("o_orderkey", status).alias("key"))


@query("h16_round", "select l_orderkey, l_linenumber::bigint as l_linenumber, round(l_extendedprice / 7, 2) as two, round(l_extendedprice / 7, 4) as four from lineitem")
def _(t):
    price = F.col("l_extendedprice") / 7
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(price, 2).alias("two"), F.round(price, 4).alias("four"))


@query("h17_array_functions", "select vec_id, len(embedding)::bigint as n, list_contains([1, 3, 5], label) as odd from embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.size("embedding").alias("n"), F.array_contains(F.array(*[F.lit(v) for v in (1, 3, 5)]), F.col("label")).alias("odd"))

