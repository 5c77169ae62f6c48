from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from citylake.functions.columns import in_list, rounded_int
from citylake.functions.exact import exact_avg, exact_sum
from citylake.functions.geo import contains, edges_contain, polygon_rings, ring_edges
from citylake.functions.keys import surrogate_key
from citylake.functions.time import date_key, date_spine, expected_slots, local_date, local_day_bounds, local_ts


def test_switch_days_have_23_and_25_hours(spark):
    days = spark.createDataFrame([(date(2026, 3, 29),), (date(2026, 7, 1),), (date(2026, 10, 25),)], "d date")
    start, end = local_day_bounds("d")
    got = days.select(
        F.timestamp_diff("HOUR", start, end).alias("hours"), expected_slots("d").alias("slots")
    ).collect()
    assert [tuple(r) for r in got] == [(23, 276), (24, 288), (25, 300)]


def test_local_wall_clock_repeats_in_autumn(spark):
    hours = spark.createDataFrame([(datetime(2026, 10, 25, 0),), (datetime(2026, 10, 25, 1),)], "ts timestamp_ntz")
    local = hours.select(local_ts(F.col("ts").cast("timestamp")).alias("l")).collect()
    assert [r.l for r in local] == [datetime(2026, 10, 25, 2), datetime(2026, 10, 25, 2)]


def test_local_wall_clock_takes_the_zone_once(spark):
    starts = datetime(1890, 5, 1), datetime(1945, 4, 2), datetime(2026, 3, 28, 12), datetime(2026, 10, 24, 12), datetime(2090, 7, 1)
    instants = [start + timedelta(minutes=20 * k) for start in starts for k in range(120)]
    rows = spark.createDataFrame([(t,) for t in instants] + [(None,)], "t timestamp_ntz").select(F.col("t").cast("timestamp").alias("ts"))
    local = rows.select("ts", local_ts("ts").alias("l"), local_date("ts").alias("d"))
    got = local.select(F.col("ts").cast("timestamp_ntz"), "l", "d").collect()
    zone = ZoneInfo("Europe/Prague")
    wanted = {t: t.replace(tzinfo=timezone.utc).astimezone(zone).replace(tzinfo=None) for t in instants}
    assert {(r[0], r.l, r.d) for r in got} == {(t, w, w.date()) for t, w in wanted.items()} | {(None, None, None)}
    assert dict(local.dtypes)["l"] == "timestamp_ntz"
    assert "convert_timezone" not in local._jdf.queryExecution().optimizedPlan().toString()


def test_local_date_and_key(spark):
    late = spark.range(1).select(F.lit("2026-10-02T22:00:00Z").cast("timestamp").alias("ts"))
    row = late.select(local_date("ts").alias("d"), date_key(local_date("ts")).alias("k")).first()
    assert (row.d, row.k) == (date(2026, 10, 3), 20261003)


def test_spine_is_half_open(spark):
    assert date_spine(spark, date(2026, 1, 1), date(2026, 1, 4)).count() == 3
    with pytest.raises(ValueError):
        date_spine(spark, date(2026, 1, 1), date(2026, 1, 1))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 7)), min_size=1, max_size=60), st.randoms())
def test_exact_aggregates_do_not_depend_on_the_order(spark, values, random):
    shuffled = list(values)
    random.shuffle(shuffled)
    results = []
    for order, parts in ((values, 1), (shuffled, 4)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(parts)
        results.append(tuple(df.agg(exact_avg("v"), exact_sum("v")).first()))
    assert results[0] == results[1]


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert tuple(df.agg(exact_avg("v"), exact_sum("v")).first()) == (None, None)


def test_exact_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (2.5,), (-2.5,), (4503599627370497.0,)], "v double")
    got = [r[0] for r in df.select("v").groupBy("v").agg(exact_sum("v", scale=0).alias("s")).orderBy("v").select("s").collect()]
    assert got == [-3.0, -1.0, 1.0, 3.0, 4503599627370497.0]


def test_exact_refuses_values_that_do_not_fit(spark):
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(1e13,)], "v double").agg(exact_sum("v")).collect()


def test_rounded_int_is_half_even(spark):
    df = spark.createDataFrame([(2.9,), (2.5,), (3.5,), (-2.5,)], "v double")
    assert [r[0] for r in df.select(rounded_int("v")).collect()] == [3, 2, 4, -2]


def test_empty_list_keeps_all_rows(spark):
    df = spark.range(4)
    assert df.filter(in_list("id", [])).count() == 4
    assert df.filter(in_list("id", [1, 2])).count() == 2


def test_null_and_text_give_different_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == 2


SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}'
TWO = '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,6]]]]}'


@pytest.mark.parametrize(
    ("shape", "x", "y", "inside"),
    [
        (SQUARE, 3.0, 3.0, True),
        (SQUARE, 1.5, 1.5, False),
        (SQUARE, 0.0, 2.0, False),
        (SQUARE, 4.0, 2.0, False),
        (SQUARE, 4.0, 4.0, False),
        (SQUARE, 1.0, 1.5, False),
        (SQUARE, 0.5, 1.0, True),
        (SQUARE, 5.0, 2.0, False),
        (TWO, 0.5, 0.5, True),
        (TWO, 5.5, 5.5, True),
        (TWO, 3.0, 3.0, False),
    ],
)
def test_point_in_polygon(spark, shape, x, y, inside):
    point = f'{{"type":"Point","coordinates":[{x},{y}]}}'
    row = spark.range(1).select(
        contains(F.lit(shape), F.lit(point)).alias("a"),
        edges_contain(ring_edges(polygon_rings(F.lit(shape))), F.lit(x), F.lit(y)).alias("b"),
    ).first()
    assert (row.a, row.b) == (inside, inside)


def test_scratch_goes_with_its_application(tmp_path):
    import os
    import subprocess
    import sys

    from tests.conftest import ROOT

    code = (
        "from citylake.session import build_session, fresh_dir\n"
        f"spark = build_session('scratch', 'local[1]', spark__checkpoint__dir={str(tmp_path)!r})\n"
        "path = fresh_dir(spark, 'rows')\n"
        "spark.range(3).write.parquet(path)\n"
        "print(spark.read.parquet(path).count(), path)\n"
        "spark.stop()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[0] == "3" and done.stdout.split()[1].startswith(str(tmp_path))
    assert not [d for d in os.listdir(tmp_path) if d.startswith("citylake-")]
