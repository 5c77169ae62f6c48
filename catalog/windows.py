"""Row-order operators (E). Raw series are cut into even slices, so a hot key never fills one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import feeds
from catalog.registry import pick, query
from citylake.operators import ordered, scd2
from citylake.operators.dedup import latest_value, latest_version, latest_wins
from citylake.operators.fill import dense_forward_fill
from citylake.operators.stats import growth

SLICE = ordered.SLICE


@query("e01_latest_wins", "select user_id, event_type, event_id, round(value, 6) as value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def _(t):
    return latest_wins(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("e02_latest_version", """select 'S' || s_suppkey as id, s_name || case when s_suppkey % 7 = 0 then ' new' else '' end as name, '2024-01-01' as first_seen_date,
  case when s_suppkey % 10 = 3 then '2024-01-11' else '2024-01-21' end as last_listed_date, s_suppkey % 10 <> 3 as is_listed from supplier""")
def _(t):
    return latest_version(feeds.air_stations(t), "id").select("id", "name", "first_seen_date", "last_listed_date", "is_listed")


@query("e03_forward_fill", """select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over w as known, last_value(case when event_type = 'error' then event_id end ignore nulls) over w as last_error
  from events window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)""")
def _(t):
    rows = t.events.select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("known"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("last_error"))
    cut = ordered.cut_long_groups(rows, "user_id", ["ts", "event_id"])
    return ordered.forward_fill(cut, "user_id", ["ts", "event_id"], ["known", "last_error"], SLICE).select(
        "event_id", "known", "last_error")


@query("e03_daily_fill", """with v as (select ts::date as d, user_id, count(*) as n from events group by all)
  select strftime(g.d, '%Y-%m-%d') as day, g.user_id, v.n, v.d is distinct from g.d as is_forward_filled
  from (select d, user_id from (select unnest(generate_series(min(d), max(d), interval 1 day))::date as d from v), (select distinct user_id from v)) g
  asof left join v on v.user_id = g.user_id and g.d >= v.d""")
def _(t):
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count("*").alias("n"))
    return dense_forward_fill(daily, "user_id", "day")


_STATUS = """select o_custkey, o_orderkey, o_orderstatus, coalesce(o_orderstatus <> lag(o_orderstatus) over w, true) as starts_version
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)"""


def _status_rows(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("at"))
    return ordered.cut_long_groups(rows, "o_custkey", "at")


@query("e04_change_detection", _STATUS)
def _(t):
    marked = scd2.mark_versions(_status_rows(t), "o_custkey", "at", ["o_orderstatus"], SLICE)
    return marked.select("o_custkey", "o_orderkey", "o_orderstatus", "starts_version")


@query("e05_version_numbers", f"""select o_custkey, o_orderkey, sum(starts_version::int) over (partition by o_custkey order by o_orderdate, o_orderkey)::bigint as version_number
  from (select s.*, o.o_orderdate from ({_STATUS}) s join orders o using (o_orderkey))""")
def _(t):
    marked = scd2.mark_versions(_status_rows(t), "o_custkey", "at", ["o_orderstatus"], SLICE)
    return marked.select("o_custkey", "o_orderkey", F.col("version_number").cast("bigint").alias("version_number"))


_VERSIONS = """with d as (select o_custkey, o_orderdate::date as day, arg_max(o_orderstatus, o_orderkey) as m from orders group by all),
  f as (select o_custkey, day, m as status, coalesce(m <> lag(m) over (partition by o_custkey order by day), true) as starts from d)
  select o_custkey, status, strftime(case when row_number() over w = 1 then date '1900-01-01' else day end, '%Y-%m-%d') as valid_from,
    strftime(coalesce(lead(day) over w, date '9999-12-31'), '%Y-%m-%d') as valid_to, lead(day) over w is null as is_current
  from f where starts window w as (partition by o_custkey order by day)"""


@query("e06_validity_intervals", _VERSIONS)
def _(t):
    """One state per customer and day, merged into versions."""
    days = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").cast("timestamp").alias("scd_valid_from")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.max("o_orderkey").alias("scd_id"))
    versions = scd2.scd2_dimension(days, "o_custkey", ["status"])
    return versions.select(
        "o_custkey", "status", F.col("valid_from_ts_utc").cast("date").alias("valid_from"),
        F.col("valid_to_ts_utc").cast("date").alias("valid_to"), "is_current")


@query("e07_is_current", "select o_custkey, strftime(d, '%Y-%m-%d') as day, d = max(d) over (partition by o_custkey) as is_current from (select distinct o_custkey, o_orderdate::date as d from orders)")
def _(t):
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day")).distinct()
    newest = days.groupBy("o_custkey").agg(F.max("day").alias("newest"))
    return days.join(newest, "o_custkey").select("o_custkey", "day", (F.col("day") == F.col("newest")).alias("is_current"))


@query("e08_latest_overall", "select event_id, round(value, 6) as value from events order by ts desc, event_id desc limit 1")
def _(t):
    newest = latest_value(t.events, F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return t.spark.range(1).select(newest.alias("e")).select("e.event_id", "e.value")


@query("e09_rolling_mean", """select event_id, case when count(value) over w = 7 then round(avg(value) over w, 6) end as value_rolling
  from events window w as (partition by user_id order by ts, event_id rows between 6 preceding and current row)""")
def _(t):
    cut = ordered.cut_long_groups(t.events.select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"])
    return ordered.rolling_mean(cut, "user_id", ["ts", "event_id"], "value", 7, slices=SLICE).select("event_id", "value_rolling")


@query("e10_first_last_rows", """with r as (select c_nationkey, o_orderdate::date as d, count(*) as n from orders join customer on o_custkey = c_custkey group by all),
  k as (select *, row_number() over (partition by c_nationkey order by d) as a, row_number() over (partition by c_nationkey order by d desc) as z, count(*) over (partition by c_nationkey) as c from r)
  select c_nationkey::bigint as c_nationkey, round(avg(n) filter (where a <= 28), 1) as first_window_mean, round(avg(n) filter (where z <= 28), 1) as last_window_mean,
    round((avg(n) filter (where z <= 28) / avg(n) filter (where a <= 28) - 1) * 100, 1) as growth_pct from k where c >= 56 group by 1""")
def _(t):
    daily = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        "c_nationkey", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return growth(daily, ["c_nationkey"], "day", "n", 28)


@query("e11_time_gaps", f"""with p as (select distinct user_id, date_trunc('hour', ts) as ts from events), n as (select *, lead(ts) over (partition by user_id order by ts) as next_ts from p)
  select user_id, {pick('t ts, t next_ts')} from n where next_ts > ts + interval 1 hour""")
def _(t):
    return ordered.time_gaps(t.events.withColumn("ts", F.date_trunc("hour", "ts")), "ts", ["user_id"])


@query("e11_time_gaps_whole_series", f"""with n as (select ts, lead(ts) over (order by ts) as next_ts from (select distinct ts from events))
  select {pick('t ts, t next_ts')} from n where next_ts > ts + interval 1 minute""")
def _(t):
    return ordered.time_gaps(t.events, "ts", unit="minute")
