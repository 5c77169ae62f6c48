from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from citylake import profiling
from citylake.plans import analytics

START = date(2026, 7, 1)
BIKES = "district_slug string, district_name string, date_day date, bikes double, n_counters int"


def bikes(spark, slug, values):
    return spark.createDataFrame(
        [(slug, slug.title(), START + timedelta(days=i), float(v), 2 + i % 2) for i, v in enumerate(values)], BIKES)


def test_growth_compares_first_and_last_window(spark, rows):
    df = bikes(spark, "up", [100] * 28 + [150] * 28).union(bikes(spark, "down", [200] * 28 + [100] * 30)).union(
        bikes(spark, "short", [100] * 40)).union(bikes(spark, "none", [0] * 56))
    got = analytics.bike_growth(df).collect()
    assert [(r.district_slug, r.first_window_mean, r.last_window_mean, r.growth_pct, r.n_counters) for r in got] == [
        ("up", 100.0, 150.0, 50.0, 3), ("down", 200.0, 100.0, -50.0, 3)]
    assert [r.district_slug for r in analytics.top_growing(analytics.bike_growth(df), 1).collect()] == ["up"]


def test_growth_with_own_grouping(spark):
    df = bikes(spark, "a", [10] * 56).withColumnRenamed("district_slug", "counter_id").drop("n_counters")
    row = analytics.bike_growth(df, group_cols=("counter_id",)).first()
    assert row.asDict() == {"counter_id": "a", "first_window_mean": 10.0, "last_window_mean": 10.0, "growth_pct": 0.0}


def test_rolling_traffic(spark):
    got = analytics.rolling_bike_traffic(bikes(spark, "a", [1, 2, 3, 4]), window=3).orderBy("date_day").collect()
    assert [r.bikes_rolling for r in got] == [None, None, 2.0, 3.0]


MART = ("district_slug string, district_name string, date_day date, avg_pm10_ugm3 double, avg_no2_ugm3 double, avg_pm2_5_ugm3 double, "
        "avg_price_eur_mwh double, avg_load_mw double, avg_wind_speed_ms double, avg_temperature_c double, precipitation_mm double")


def mart(spark, days):
    return spark.createDataFrame(
        [("d", "D", START + timedelta(days=i), float(i), 1.0, None, float(2 * i), 5.0, float(-i), float(i % 2), None) for i in range(days)], MART)


def test_correlations_skip_constant_and_missing_drivers(spark):
    got = {r.driver: (r.r, r.n_days) for r in analytics.district_correlations(mart(spark, 20), "PM10").collect()}
    assert got["Day-ahead price"] == (1.0, 20) and got["Wind speed"] == (-1.0, 20)
    assert set(got) == {"Day-ahead price", "Wind speed", "Temperature"}


def test_correlations_need_enough_days_and_a_varying_pollutant(spark):
    assert analytics.district_correlations(mart(spark, 13), "PM10").count() == 0
    assert analytics.district_correlations(mart(spark, 20), "NO2").count() == 0


def test_heat_table_has_a_column_per_driver(spark):
    table = analytics.correlation_heat_table(analytics.district_correlations(mart(spark, 20), "PM10"))
    assert table.columns == ["district_name", *analytics.DRIVERS.values()]


def test_daily_pollution_ignores_districts_without_data(spark):
    df = spark.createDataFrame([("a", START, 10.0), ("b", START, 20.0), ("c", START, None)], "district_slug string, date_day date, avg_pm10_ugm3 double")
    assert tuple(analytics.daily_pollution(df, "PM10").first()) == (START, 15.0, 2)


POLLUTION, PRICE = "date_day date, value_ugm3 double", "date_day date, price_eur_mwh double, price_czk_mwh double, min_price_eur_mwh double"


def test_kpis(spark):
    pollution = spark.createDataFrame([(START, 10.0), (START + timedelta(days=1), 30.0)], POLLUTION)
    price = spark.createDataFrame([(START, 50.0, 1250.0, -5.0), (START + timedelta(days=1), 100.0, 2500.0, 10.0)], PRICE)
    traffic = bikes(spark, "a", [100, 200]).union(bikes(spark, "b", [50, 50]))
    assert analytics.kpis(pollution, price, traffic).first().asDict() == {
        "pollutant_mean": 20.0, "pollutant_max_day": 30.0, "price_mean_eur": 75.0, "price_mean_czk": 1875.0,
        "negative_price_days": 1, "bikes_per_day": 200.0}


def test_kpis_of_nothing(spark):
    empty = analytics.kpis(spark.createDataFrame([], POLLUTION), spark.createDataFrame([], PRICE), spark.createDataFrame([], BIKES)).first()
    assert empty.negative_price_days == 0 and [v for k, v in empty.asDict().items() if k != "negative_price_days"] == [None] * 5


def test_outer_merge_keeps_days_of_both(spark):
    pollution = spark.createDataFrame([(START, 1.0)], POLLUTION)
    price = spark.createDataFrame([(START + timedelta(days=1), 2.0, 3.0, 4.0)], PRICE)
    assert analytics.pollution_and_price(pollution, price).count() == 2


def test_missing_shares(spark, rows):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "a", "x"), (4, "b", "x")], "i int, half string, quarter string")
    assert [tuple(r) for r in profiling.missing(df).collect()] == [("half", 50.0), ("quarter", 25.0)]
    assert [r.column for r in profiling.top_missing(df, 1).collect()] == ["half"]


@pytest.mark.parametrize("size", [300, 60_000])
def test_profile_covers_the_whole_table(spark, size):
    df = spark.range(size).withColumn("v", F.col("id") * 2.0).withColumn("at", F.lit("2026-01-01T00:00:00Z").cast("timestamp"))
    parts = profiling.profile(df)
    assert set(parts) == {"overview", "missing", "columns", "correlations"}
    assert parts["overview"].first().asDict() == {"total_rows": size, "n_columns": 3, "duplicate_rows": 0}
    pair = parts["correlations"].filter("column_a = 'id' and column_b = 'v'").first()
    assert (pair.pearson, pair.spearman) == (pytest.approx(1.0), pytest.approx(1.0))
    v = parts["columns"].filter("column = 'v'").first()
    assert (v.n, v.n_null, float(v.min), float(v.max)) == (size, 0, 0.0, 2.0 * (size - 1))
    assert profiling.naive_utc(df).schema["at"].dataType.simpleString() == "timestamp_ntz"


def test_duplicates_are_counted(spark):
    assert profiling.overview(spark.createDataFrame([(1,), (1,), (1,), (2,)], "a int")).first().duplicate_rows == 2


def test_catalogue(spark, rows):
    assert rows(profiling.catalogue({"b": spark.range(2), "a": spark.range(3)})) == [("a", 3, 1), ("b", 2, 1)]


def test_merged_profiles_are_those_of_the_rows(spark):
    rng = random.Random(11)
    data = [(i % 9 if i % 50 else None, float(rng.lognormvariate(0, 2)) if i % 7 else None, rng.randrange(3000), f"w{rng.randrange(400)}", None) for i in range(12_000)]
    df = spark.createDataFrame(data, "day int, x double, n int, w string, none double")
    daily = profiling.daily_profile(df, "day")
    assert daily.count() == 10 * 4
    for some in ("true", "day in (2, 3, 7)", "day is null"):
        rows = df.where(some)
        merged = {r["column"]: r for r in profiling.merged_profile(daily.where(some)).collect()}
        for r in profiling.column_statistics(rows.drop("day")).collect():
            m = merged[r["column"]]
            assert (m["n"], m["n_null"]) == (r["n"], r["n_null"])
            assert [str(v) for v in (m["first"], m["last"])] == [str(r["min"]), str(r["max"])] if r["column"] == "w" else (m["first"], m["last"]) == (None, None)
            if r["column"] in ("x", "n"):
                assert (m["low"], m["high"]) == (float(r["min"]), float(r["max"]))
                assert m["mean"] == pytest.approx(r["mean"]) and m["stddev"] == pytest.approx(r["stddev"])
            values = sorted(v[r["column"]] for v in rows.collect() if v[r["column"]] is not None)
            # Three standard errors of a sketch of 2^12 registers; ranks within 1.65 % of the rows.
            assert abs(m["n_distinct_approx"] - len(set(values))) <= max(2, 0.05 * len(set(values)))
            if r["column"] in ("x", "n"):
                for q, found in zip(profiling.QUANTILES, m["quantiles_approx"], strict=True):
                    low, high = (sum(v < found for v in values), sum(v <= found for v in values))
                    assert low - 0.0165 * len(values) - 1 <= q * len(values) <= high + 0.0165 * len(values) + 1
        assert merged["none"]["n"] == 0 and merged["none"]["mean"] is None and merged["none"]["quantiles_approx"] is None


def test_correlations_of_many_columns_with_gaps(spark):
    rng = random.Random(5)
    names = [f"c {i}" for i in range(30)]
    data = []
    for _ in range(400):
        base = rng.gauss(0, 1)
        row = [round(base * (i % 5) + rng.gauss(0, 1), 1 if i % 2 else 6) for i in range(30)]
        for i in (3, 4, 11):
            if rng.random() < 0.3:
                row[i] = None
        row[20], row[21] = 7.0, None
        data.append(tuple(row))
    df = spark.createDataFrame(data, ", ".join(f"`{n}` double" for n in names))
    got = {(r.column_a, r.column_b): (r.pearson, r.spearman) for r in profiling.correlation_matrix(df).collect()}
    frame = pd.DataFrame(data, columns=names)
    for at, method in enumerate(("pearson", "spearman")):
        expected = frame.astype(float).corr(method)
        for i, a in enumerate(names):
            for b in names[i:]:
                value = expected.loc[a, b]
                if 20 in (names.index(a), names.index(b)) or math.isnan(value):
                    assert got[a, b][at] is None
                else:
                    assert got[a, b][at] == pytest.approx(value, abs=1e-9)
    assert len(got) == 30 * 31 // 2


def test_ranks_read_each_cell_once(spark):
    rows = spark.range(100).selectExpr("id as row", *(f"cast((id * {i + 3}) % 17 as double) as x{i}" for i in range(6)))
    ranked = profiling.average_ranks(rows, [f"x{i}" for i in range(6)], [])
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "Expand" in plan
    assert ranked.count() == 100


def test_correlations_without_numbers(spark):
    assert profiling.correlation_matrix(spark.createDataFrame([("a",)], "a string")).collect() == []
