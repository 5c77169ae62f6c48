"""Aggregations (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import local, query
from citylake.functions.exact import exact_avg, exact_sum
from citylake.functions.time import MARKET_ZONE
from citylake.operators import stats
from citylake.operators.resample import hourly_statistics, rollup_local_day


@query("d01_group_keys", "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity::decimal(18,6))::double, 6) as qty from lineitem group by all")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), exact_sum("l_quantity").alias("qty"))


@query("d02_counts", "select event_type, count(*) as n_slots, count(case when value > 20 then value end) as n_with_data from events group by 1")
def _(t):
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("n_slots"), F.count(F.when(F.col("value") > 20, F.col("value"))).alias("n_with_data"))


@query("d03_distinct_beside_others", "select l_returnflag, count(distinct l_suppkey) as n_suppliers, count(*) as n, max(l_quantity) as top from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("n_suppliers"), F.count("*").alias("n"), F.max("l_quantity").alias("top"))


@query("d04_basic_statistics", "select event_type, min(value) as lo, max(value) as hi, round(sum(value), 4) as total, round(avg(value), 6) as mean from events group by 1")
def _(t):
    return t.events.groupBy("event_type").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.round(F.sum("value"), 4).alias("total"), F.avg("value").alias("mean"))


@query("d05_exact_avg", "select l_partkey, round(avg(l_extendedprice::decimal(18,6)), 6) as price, round(avg(l_extendedprice::decimal(18,2)) filter (where l_returnflag = 'R'), 6) as returned from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(
        exact_avg("l_extendedprice").alias("price"),
        exact_avg("l_extendedprice", F.col("l_returnflag") == "R", scale=2).alias("returned"))


@query("d06_exact_sum", "select l_suppkey, round(sum(l_extendedprice::decimal(18,6))::double, 6) as total, round((sum(l_tax::decimal(18,6)) filter (where l_linestatus = 'F'))::double, 6) as tax from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        exact_sum("l_extendedprice").alias("total"), exact_sum("l_tax", F.col("l_linestatus") == "F").alias("tax"))


@query("d07_filtered_pivot", """select user_id, round(avg(value::decimal(18,6)) filter (where event_type = 'view'), 6) as views,
  round(avg(value::decimal(18,6)) filter (where event_type = 'click'), 6) as clicks from events group by 1""")
def _(t):
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        exact_avg("value", kind == "view").alias("views"), exact_avg("value", kind == "click").alias("clicks"))


@query("d08_two_level", """select event_type, round(avg(m::decimal(18,6)), 6) as mean_of_means, round(avg(s::decimal(18,6)), 6) as mean_of_sums, count(*) as n_users
  from (select event_type, user_id, avg(value::decimal(18,6)) as m, sum(value::decimal(18,6))::double as s from events group by all) group by 1""")
def _(t):
    users = t.events.groupBy("event_type", "user_id").agg(exact_avg("value").alias("m"), exact_sum("value").alias("s"))
    return users.groupBy("event_type").agg(
        exact_avg("m").alias("mean_of_means"), exact_avg("s").alias("mean_of_sums"), F.count("*").alias("n_users"))


@query("d09_every_row", "select l_orderkey, sum(l_quantity) as qty from lineitem group by 1 having bool_and(l_quantity > 10)")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.bool_and(F.col("l_quantity") > 10).alias("ok")).filter("ok").drop("ok")


@query("d10_distinct", "select distinct p_brand, p_type from part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("d11_global", "select strftime(min(o_orderdate), '%Y-%m-%d') as lo, strftime(max(o_orderdate), '%Y-%m-%d') as hi, count(*) as n from orders")
def _(t):
    return t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"), F.count("*").alias("n"))


@query("d12_representative_name", "select p_brand, min(p_name) as name from part group by 1")
def _(t):
    return t.part.groupBy("p_brand").agg(F.min("p_name").alias("name"))


@query("d13_hourly_resample", """select event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour_start_ts_utc, round(avg(value::decimal(18,6)), 6) as value,
  min(value) as min_value, max(value) as max_value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as loaded, count(*) as n_intervals from events group by 1, 2""")
def _(t):
    rows = t.events.withColumn("loaded", F.col("ts"))
    return hourly_statistics(rows, ["event_type"], "ts", "value", "loaded")


_SHIFTED = "o_orderdate + to_minutes((o_orderkey % 288) * 5)"


@query("d14_local_day_rollup", f"""select o_orderstatus, strftime(d, '%Y-%m-%d') as local_date, sum(k)::bigint as bikes, count(*) as n_slots,
  datediff('minute', timezone('Europe/Prague', d::timestamp), timezone('Europe/Prague', (d + interval 1 day)::timestamp)) // 720 as expected_slots,
  count(*) >= datediff('minute', timezone('Europe/Prague', d::timestamp), timezone('Europe/Prague', (d + interval 1 day)::timestamp)) // 720 as is_complete_day
  from (select o_orderstatus, ({local(_SHIFTED)})::date as d, o_custkey as k from orders) group by 1, d""")
def _(t):
    rows = t.orders.withColumn("slot", F.col("o_orderdate").cast("timestamp") + F.expr("make_dt_interval(0, 0, cast((o_orderkey % 288) * 5 as int))"))
    return rollup_local_day(rows, ["o_orderstatus"], "slot", [F.sum("o_custkey").alias("bikes")], MARKET_ZONE, 720)


@query("d15_correlation", """select l_returnflag, u.d as driver, round(corr(l_quantity, u.v), 2) as r, count(*) as n_rows
  from (select l_returnflag, l_quantity, unnest([{'d': 'price', 'v': l_extendedprice}, {'d': 'tax', 'v': case when l_linenumber < 4 then l_tax end}, {'d': 'flat', 'v': 1.0::double}]) as u from lineitem)
  where u.v is not null group by 1, 2 having count(*) >= 14 and min(u.v) < max(u.v)""")
def _(t):
    rows = t.lineitem.select(
        "l_returnflag", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") < 4, F.col("l_tax")).alias("tax"), F.lit(1.0).alias("flat"))
    return stats.correlations(rows, ["l_returnflag"], "l_quantity", {"l_extendedprice": "price", "tax": "tax", "flat": "flat"})


@query("d16_quantiles", """select event_type, p as probability, round(case when p = 0.05 then quantile_cont(value, 0.05) else quantile_cont(value, 0.95) end, 6) as quantile
  from events, (values (0.05::double), (0.95::double)) v(p) group by 1, 2""")
def _(t):
    return stats.exact_quantiles(t.events, "value", [0.05, 0.95], "event_type")


@query("d16_quantiles_whole_table", """select p as probability, round(case when p = 0.05 then quantile_cont(l_extendedprice, 0.05) when p = 0.5 then quantile_cont(l_extendedprice, 0.5) else quantile_cont(l_extendedprice, 0.95) end, 6) as quantile
  from lineitem, (values (0.05::double), (0.5::double), (0.95::double)) v(p) group by 1""")
def _(t):
    return stats.exact_quantiles(t.lineitem, "l_extendedprice", [0.05, 0.5, 0.95])


@query("d17_pivot", """select event_type, max(n) filter (where k = 0) as "0", max(n) filter (where k = 1) as "1", max(n) filter (where k = 2) as "2"
  from (select event_type, user_id % 3 as k, count(*) as n from events group by all) group by 1""")
def _(t):
    long = t.events.groupBy("event_type", F.expr("user_id % 3").alias("k")).agg(F.count("*").alias("n"))
    return stats.pivot_wide(long, "event_type", "k", [0, 1, 2], "n")


@query("d18_null_share", """select 'c_name' as "column", round(avg((c_nationkey < 8)::int) * 100, 2) as null_pct from customer union all select 'c_custkey', 0.0::double""")
def _(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_nationkey") >= 8, F.col("c_name")).alias("c_name"))
    return stats.null_share(rows)


@query("d18_duplicate_rows", "select (select count(*) from lineitem) - (select count(*) from (select distinct l_partkey, l_linenumber from lineitem)) as duplicate_rows")
def _(t):
    return stats.duplicate_rows(t.lineitem.select("l_partkey", "l_linenumber"))
