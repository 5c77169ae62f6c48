from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from citylake.operators import incremental
from citylake.plans import analytics, snapshots, warehouse
from citylake.plans.contracts import FRESHNESS, all_checks
from citylake.quality import QualityError, enforce, freshness, report
from citylake.sources.schemas import BRONZE
from tests import city

AS_OF = date(2026, 10, 27)
FACTS = ("fact_air_quality_hourly", "fact_weather_hourly", "fact_energy_price_hourly", "fact_bike_traffic_daily")


def content(df):
    columns = sorted(df.columns)
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Two incremental runs; the second one with a new day, corrections, a moved and a removed station."""
    root, out = (str(tmp_path_factory.mktemp(n)) for n in ("bronze", "lake"))
    loaded = datetime(2026, 10, 26, 3)
    city.land_snapshots(spark, root, date(2026, 10, 24), loaded)
    for day in city.DAYS[:3]:
        city.land_series(spark, root, day, loaded, eur=None if day == date(2026, 10, 25) else 25.0)
    first = warehouse.build(spark, root, out, AS_OF, datetime(2026, 10, 26, 4))
    state = {name: content(first[name]) for name in (*FACTS, "dim_station", "mart_air_vs_energy_daily")}
    report_rows = {(r.table_name, r.check_name): r for r in warehouse.check(first, AS_OF).collect()}
    loaded = datetime(2026, 10, 27, 3)
    city.land_snapshots(spark, root, date(2026, 10, 27), loaded, ids=("A1",), district="east")
    city.land_series(spark, root, city.DAYS[2], loaded, bump=1.0)
    city.land_series(spark, root, city.DAYS[3], loaded, eur=None)
    second = warehouse.build(spark, root, out, AS_OF, datetime(2026, 10, 27, 4), bronze_since=city.DAYS[2])
    return {"root": root, "out": out, "state": state, "report": report_rows, "tables": second}


def test_declared_checks():
    kinds = Counter(c.name.split("(")[0] for c in all_checks(AS_OF))
    assert sum(kinds.values()) == 189
    assert (kinds["not_null"], kinds["relationship"], kinds["unique"], kinds["unique_together"]) == (112, 20, 16, 9)


def test_first_run_meets_its_contracts(built):
    rows = built["report"]
    assert len(rows) == 189 + len(FRESHNESS)
    assert [k for k, r in rows.items() if r.status == "fail"] == []
    assert rows["silver_air_stations", "no_inferred_members"].failures == 2


def test_autumn_switch_day_is_complete_with_300_slots(built, rows):
    bikes = built["tables"]["fact_bike_traffic_daily"].filter("local_date = date'2026-10-25'")
    got = rows(bikes, "counter_id", "direction_id", "n_slots", "expected_slots", "is_complete_day", "direction_name", "is_direction_inferred", "bike_count")
    assert got == [
        ("C1", "D1", 300, 300, True, "in", False, 598), ("C1", "D2", 300, 300, True, "out", False, 598),
        ("C2", "D1", 300, 300, True, "in", True, 598), ("X9", "D2", 300, 300, True, "out", True, 598)]


def test_correction_wins_and_hours_are_shifted(built):
    air = built["tables"]["fact_air_quality_hourly"]
    row = air.filter("station_id = 'A1' and pollutant = 'PM10' and hour_start_ts_utc = timestamp'2026-10-24 05:00:00'").first()
    assert row.value_ugm3 == pytest.approx(120.6) and row.hour_start_local == datetime(2026, 10, 24, 7)


def test_prices_are_converted_and_estimated(built):
    energy = built["tables"]["fact_energy_price_hourly"]
    assert energy.filter("n_price_intervals <> 4").count() == 0
    per_day = {r.date_key: (r.n, r.estimated, r.rate) for r in energy.groupBy("date_key").agg(
        F.count("*").alias("n"), F.bool_or("is_eur_rate_estimated").alias("estimated"), F.max("eur_czk_rate").alias("rate")).collect()}
    assert per_day[20261024] == (24, False, 25.0)
    assert per_day[20261025] == (25, False, 25.0), "a day without a rate table repeats the day before"
    assert per_day[20261027] == (24, True, 25.0), "no rate yet: the latest one, flagged"


def test_station_history_after_move_and_removal(built, rows):
    versions = rows(built["tables"]["dim_station"], "station_id", "district_slug", "is_listed", "is_inferred", "valid_from_ts_utc", "is_current")
    begin, change = datetime(1900, 1, 1), datetime(2026, 10, 27, 4)
    assert versions == [
        ("A1", "east", True, False, change, True), ("A1", "west", True, False, begin, False),
        ("A2", "east", False, False, change, True), ("A2", "east", True, False, begin, False),
        ("GHOST", None, False, True, begin, True)]


def test_every_fact_hour_finds_one_version(built):
    air = built["tables"]["fact_air_quality_hourly"]
    assert air.filter("station_key is null").count() == 0
    assert air.count() == air.select("station_id", "hour_start_ts_utc", "pollutant").distinct().count()
    assert air.filter("station_id = 'GHOST'").select("district_key").distinct().collect()[0][0] == "-1"


@pytest.mark.parametrize("name", FACTS)
def test_incremental_equals_full_refresh(spark, built, tmp_path, name):
    full = built.get("full") or warehouse.build(
        spark, built["root"], built["out"] + "-full", AS_OF, datetime(2026, 10, 27, 4), full_refresh=True)
    built["full"] = full
    drop = ["station_key", "district_key"]  # the full build starts its own station history
    assert content(built["tables"][name].drop(*drop)) == content(full[name].drop(*drop))


def test_rerun_changes_nothing(spark, built):
    names = (*FACTS, "dim_station", "mart_air_vs_energy_daily")
    before = {name: content(built["tables"][name]) for name in names}
    again = warehouse.build(spark, built["root"], built["out"], AS_OF, datetime(2026, 10, 27, 5), bronze_since=city.DAYS[2])
    built["tables"] = again  # the rerun replaced the files behind the earlier frames
    assert {name: content(again[name]) for name in names} == before


def test_mart_day(built):
    mart = built["tables"]["mart_air_vs_energy_daily"]
    row = mart.filter("district_slug = 'west' and date_key = 20261025").first()
    assert row.n_aq_stations == 1 and row.aq_averaging_hours == 1 and row.is_weekend and row.n_price_hours == 25
    assert row.avg_wind_speed_ms == pytest.approx(sum(1 + h % 3 for h in [22, 23, *range(23)]) / 25)
    assert row.precipitation_mm == pytest.approx(2.5)
    assert mart.filter("district_slug = 'unknown'").count() > 0


def test_broken_contract_raises(built):
    tables = dict(built["tables"])
    tables["dim_district"] = tables["dim_district"].union(tables["dim_district"])
    checks = [c for c in all_checks(AS_OF) if c.table == "dim_district"]
    with pytest.raises(QualityError, match="unique\\(district_key\\): 3"):
        enforce(report(tables, checks))


def test_every_failed_contract_is_named(spark):
    result = spark.createDataFrame([("t", f"check{i:02}", "error", 1, "fail") for i in range(25)], "table_name string, check_name string, severity string, failures long, status string")
    with pytest.raises(QualityError) as raised:
        enforce(result)
    assert all(f"check{i:02}" in str(raised.value) for i in range(25))


def test_every_source_has_freshness_limits(built):
    assert set(FRESHNESS) == set(BRONZE)
    newest = built["tables"]["air_history"]
    for hours, status in ((2, "pass"), (7, "warn"), (25, "error")):
        now = datetime(2026, 10, 27, 3) + timedelta(hours=hours)
        assert freshness(newest, "_loaded_at", now, *FRESHNESS["air_history"]).first().status == status


def test_analytics_on_the_built_lake(built, rows):
    t = built["tables"]
    start, end = date(2026, 10, 24), date(2026, 10, 27)
    districts = rows(analytics.districts_with_data(t["dim_district"], t["mart_air_vs_energy_daily"], t["fact_bike_traffic_daily"]), "district_slug")
    assert districts == [("east",), ("unknown",), ("west",)]
    daily = analytics.bike_daily(t["fact_bike_traffic_daily"], t["dim_district"], start, end)
    assert ("west", date(2026, 10, 25), 1196, 1) in rows(daily, "district_slug", "date_day", "bikes", "n_counters")
    assert not [r for r in rows(daily, "date_day") if r[0] == date(2026, 10, 24)], "the first local day is not complete"
    hourly = analytics.hourly_pollutant_wind(
        t["fact_air_quality_hourly"], t["dim_station"], t["fact_weather_hourly"], t["fact_energy_price_hourly"], start, end, "PM10", ["east"])
    assert hourly.count() > 0 and hourly.filter("wind_speed_ms is null or price_eur_mwh is null").count() == 0
    coverage = analytics.station_coverage(analytics.station_pollution(t["fact_air_quality_hourly"], t["dim_station"], start, end, "PM10")).first()
    assert tuple(coverage) == (2, 2)
    assert analytics.freshness(*[t[f] for f in ("fact_air_quality_hourly", "fact_energy_price_hourly", "fact_weather_hourly", "fact_bike_traffic_daily")]).count() == 4


def test_upsert_reads_the_days_of_the_batch_only(spark, tmp_path):
    from citylake.operators.incremental import delete_insert
    from citylake.plans.warehouse import upsert_partitions

    path = str(tmp_path / "fact")
    rows = spark.range(300).selectExpr("id", "cast(20260101 + id % 30 as int) as date_key", "'old' as v")
    upsert_partitions(spark, path, rows, ("id",))
    seen = []

    def merge(target, batch, keys):
        seen.append(target._jdf.queryExecution().toString())
        return delete_insert(target, batch, keys)

    batch = rows.filter("date_key in (20260103, 20260107, 20260111) and id < 100").selectExpr("id", "date_key", "'new' as v")
    table = upsert_partitions(spark, path, batch, ("id",), merge=merge)
    assert "date_key" in seen[0] and all(str(day) in seen[0].split("PartitionFilters:")[1] for day in (20260103, 20260107, 20260111))
    assert table.count() == 300
    assert {r.date_key for r in table.filter("v = 'new'").collect()} == {20260103, 20260107, 20260111}
    assert table.filter("v = 'new'").count() == batch.count()


@pytest.mark.parametrize("most", [5000, 1])
def test_upsert_keeps_rows_without_a_day(spark, rows, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warehouse, "MOST_LITERALS", most)
    path, schema = str(tmp_path / "fact"), "id int, date_key int, v string"
    warehouse.upsert_partitions(spark, path, spark.createDataFrame([(1, None, "a"), (2, 20240101, "b"), (5, None, "c")], schema), ("id",))
    batch = spark.createDataFrame([(3, None, "d"), (4, 20240102, "e"), (5, None, "f")], schema)
    table = warehouse.upsert_partitions(spark, path, batch, ("id",))
    want = [(1, None, "a"), (2, 20240101, "b"), (3, None, "d"), (4, 20240102, "e"), (5, None, "f")]
    assert rows(table, "id", "date_key", "v") == want
    late = warehouse.upsert_partitions(spark, path, spark.createDataFrame([(2, 20240101, "g")], schema), ("id",))
    assert rows(late, "id", "date_key", "v") == [want[0], (2, 20240101, "g"), *want[2:]]


def test_check_reports_the_age_of_every_source(built):
    rows = warehouse.check(built["tables"], AS_OF, strict=False, now=datetime(2026, 10, 27, 4)).filter("check_name like 'freshness%'").collect()
    assert {r.table_name for r in rows} == set(FRESHNESS) and {r.severity for r in rows} == {"warn"}
    late = warehouse.check(built["tables"], AS_OF, strict=False, now=datetime(2027, 1, 1)).filter("check_name like 'freshness%'").collect()
    assert {(r.check_name, r.status, r.failures) for r in late} == {("freshness: error", "warn", 1)}


VERSIONS = "id int, name string, v string, scd_id string, scd_valid_from timestamp, scd_valid_to timestamp"


def test_snapshot_log_holds_changes_only(spark, tmp_path):
    import os
    import random

    from citylake.operators.scd2 import snapshot_changes, snapshot_check

    path, rng, state = str(tmp_path / "snapshot"), random.Random(4), None
    current = {i: [f"name{i}", None] for i in range(40)}

    def parts():
        return sorted(d for d in os.listdir(path) if "=" in d)

    assert snapshots.read_snapshot(spark, path) is None
    for day in range(1, 13):
        touched = rng.sample(sorted(current), 2) if day not in (1, 4) else []
        for i in touched:
            current[i][1] = f"v{day}"
        if day == 6:
            del current[touched[0]]
            current[100] = ["new", None]
        df = spark.createDataFrame([(i, *v) for i, v in current.items()], "id int, name string, v string")
        stamp = datetime(2026, 1, day)
        changes = snapshot_changes(snapshots.read_snapshot(spark, path, before=stamp), df, "id", ["name", "v"], stamp).cache()
        # The written rows follow the changes: a new version and a closing for each.
        assert changes.count() == (40 if day == 1 else 0 if day == 4 else 4 if day != 6 else 3)
        state = spark.createDataFrame(snapshot_check(state, df, "id", ["name", "v"], stamp).collect(), VERSIONS)
        table = snapshots.append_changes(spark, path, changes, stamp, compact_after=5)
        assert content(table) == content(state)
        if day in (3, 6):  # a repeated run changes nothing
            again = snapshot_changes(snapshots.read_snapshot(spark, path, before=stamp), df, "id", ["name", "v"], stamp)
            assert content(snapshots.append_changes(spark, path, again, stamp, compact_after=5)) == content(state)
    bases = [p for p in parts() if p.startswith("base=")]
    assert len(bases) == 2 and len(parts()) <= 2 + 5 + 4
    # Changes that were written without their log row, as after a failure, do not count.
    spark.range(9).selectExpr("cast(id as int) as id", "false as scd_closes").write.parquet(f"{path}/delta=20270101T000000000000")
    assert content(snapshots.read_snapshot(spark, path)) == content(state)
    assert snapshots.read_snapshot(spark, path, before=datetime(2026, 1, 12)).count() == state.count() - 2


def test_references_of_a_table_share_one_scan(spark, tmp_path):
    from citylake.quality import bind, relationship

    spark.range(100).selectExpr("id", "id % 7 as a", "cast(id % 5 as string) as b", "if(id < 3, null, id % 50) as c").write.parquet(str(tmp_path / "fact"))
    spark.range(6).selectExpr("id as k").write.parquet(str(tmp_path / "dim"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("fact", "dim")}
    checks = bind("fact", relationship("a", "dim", "k"), relationship("b", "dim", "k"), relationship("c", "dim", "k"))
    result = report(tables, checks)
    expected = {"a": sum(i % 7 > 5 for i in range(100)), "b": 0, "c": sum(i % 50 > 5 for i in range(3, 100))}
    assert {r.check_name.split("(")[1][0]: r.failures for r in result.collect()} == expected
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1


def test_late_rows_of_any_age_arrive_without_a_full_refresh(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "lake")
    loaded = datetime(2026, 10, 28, 3)
    city.land_snapshots(spark, root, date(2026, 10, 24), loaded)
    for day in city.DAYS:
        city.land_series(spark, root, day, loaded)
    first = warehouse.build(spark, root, out, AS_OF, datetime(2026, 10, 28, 4))
    before = content(first["fact_air_quality_hourly"])
    files = {name: stored(out, name) for name in LAYERS}
    held, written, now = str(tmp_path / "ledger"), {}, datetime(2026, 10, 28, 4)
    assert content(warehouse.check(first, AS_OF, False, now, held)) == content(warehouse.check(first, AS_OF, False, now))
    noted = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "ledger" / "table_name=fact_air_quality_hourly").iterdir()}
    # The oldest day comes again with other values, after the facts have moved on.
    city.land_series(spark, root, city.DAYS[0], datetime(2026, 11, 8, 3), bump=5.0)
    late = warehouse.build(spark, root, out, AS_OF, datetime(2026, 11, 8, 4), changed_since=datetime(2026, 10, 28, 4), written=written)
    # The checks read the written days only and report what the full ones do.
    assert set(written) == {*FACTS, "mart_air_vs_energy_daily"}
    assert content(warehouse.check(late, AS_OF, False, now, held, written)) == content(warehouse.check(late, AS_OF, False, now))
    again = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "ledger" / "table_name=fact_air_quality_hourly").iterdir()}
    assert {d for d in again if d.startswith("day=") and again[d] != noted[d]} <= {"day=20261024", "day=20261025"}
    names = (*FACTS, "mart_air_vs_energy_daily")
    got = {name: content(late[name]) for name in names}
    assert got["fact_air_quality_hourly"] != before
    # Only the late day, and the local day after it that its last hours belong to, were written.
    for name in LAYERS:
        days = {day for day, held in stored(out, name).items() if held != files[name].get(day)}
        assert days and days <= {"2026-10-24", "20261024", "20261025"}, name
    # The same instant of the first snapshot, since station keys are made from it.
    full = warehouse.build(spark, root, str(tmp_path / "anew"), AS_OF, datetime(2026, 10, 28, 4), full_refresh=True)
    for name in names:
        assert got[name] == content(full[name]), name
    files = {name: stored(out, name) for name in LAYERS}
    warehouse.build(spark, root, out, AS_OF, datetime(2026, 11, 9, 4), changed_since=datetime(2026, 11, 8, 4))
    assert {name: stored(out, name) for name in LAYERS} == files, "nothing landed, nothing is written"


LAYERS = ("silver/air_measurements", "silver/prices_hourly", *(f"gold/{name}" for name in (*FACTS, "mart_air_vs_energy_daily")))


def stored(out, name):
    """Files of each day of a table."""
    from pathlib import Path

    folders = [f for f in (Path(out) / name).iterdir() if "=" in f.name]
    return {f.name.split("=")[1]: sorted(p.name for p in f.glob("*.parquet")) for f in folders}


def test_a_late_rate_reaches_the_days_that_repeat_or_estimate_it(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "lake")
    city.land_snapshots(spark, root, date(2026, 10, 24), datetime(2026, 10, 28, 3))
    for day in city.DAYS:
        city.land_series(spark, root, day, datetime(2026, 10, 28, 3), eur=25.0 if day in (city.DAYS[0], city.DAYS[2]) else None)
    built = warehouse.build(spark, root, out, AS_OF, datetime(2026, 10, 28, 4))
    expected = {20261024: (25.0, False), 20261025: (25.0, False), 20261026: (25.0, False), 20261027: (25.0, True)}

    def rates(tables):
        found = tables["fact_energy_price_hourly"].groupBy("date_key").agg(F.max("eur_czk_rate"), F.max("is_eur_rate_estimated"))
        return {r[0]: (r[1], r[2]) for r in found.collect()}

    def land(day, eur, hour):
        payload = city.texts(spark, city.rates(day.isoformat(), eur)).withColumn("requested_day", F.lit(day))
        city.source_feeds.land(payload, root, "fx_daily", datetime(2026, 11, 8, hour))

    assert rates(built) == expected
    # The first rate changes: its day and the one that repeats it follow, no other.
    files = stored(out, "gold/fact_energy_price_hourly")
    land(city.DAYS[0], 26.0, 1)
    late = warehouse.build(spark, root, out, AS_OF, datetime(2026, 11, 8, 2), changed_since=datetime(2026, 10, 28, 4))
    assert rates(late) == {**expected, 20261024: (26.0, False), 20261025: (26.0, False)}
    now = stored(out, "gold/fact_energy_price_hourly")
    assert {d for d in now if now[d] != files[d]} == {"20261024", "20261025"}
    # The last rate changes: the day that takes the latest one follows too.
    land(city.DAYS[2], 27.0, 3)
    late = warehouse.build(spark, root, out, AS_OF, datetime(2026, 11, 8, 4), changed_since=datetime(2026, 11, 8, 2))
    assert rates(late) == {20261024: (26.0, False), 20261025: (26.0, False), 20261026: (27.0, False), 20261027: (27.0, True)}
    full = warehouse.build(spark, root, str(tmp_path / "anew"), AS_OF, datetime(2026, 10, 28, 4), full_refresh=True)
    for name in ("fact_energy_price_hourly", "mart_air_vs_energy_daily"):
        assert content(late[name]) == content(full[name])


@pytest.mark.parametrize("few", [5000, 1])
def test_days_as_literals_and_as_a_relation(spark, rows, monkeypatch, few):
    monkeypatch.setattr(incremental, "FEW_DAYS", few)
    table = spark.sql("select id, date_add(date'2026-01-01', cast(id as int)) as day, cast(20260101 + id as int) as key from range(20)")
    days = incremental.Days(table.where("id in (3, 4, 9)").select("day")).also(incremental.Days(table.where("id = 15").select("day")))
    assert (days.few is None) == (few == 1) and not days.empty
    assert [r[0] for r in rows(days.of(table, "day"), "id")] == [3, 4, 9, 15]
    assert [r[0] for r in rows(days.of(table, "day", reach=1), "id")] == [2, 3, 4, 5, 8, 9, 10, 14, 15, 16]
    assert [r[0] for r in rows(days.of_keys(table, "key"), "id")] == [3, 4, 9, 15]
    none = incremental.Days(table.where("id > 50").select("day"))
    assert none.empty and none.of(table, "day").isEmpty() and none.of_keys(table, "key").isEmpty()


def test_ledger_follows_every_kind_of_failure(spark, tmp_path, monkeypatch):
    from citylake.plans import ledger
    from citylake.quality import WARN, accepted_range, bind, no_time_gaps, not_null, relationship, unique

    table = "fact_energy_price_hourly"
    checks = bind(table, not_null("v"), accepted_range("v", high=50, severity=WARN), unique("hour_start_ts_utc"), relationship("k", "dim", "k"), no_time_gaps("hour_start_ts_utc"))
    hours = spark.range(240).selectExpr("id", "timestamp_seconds(1767225600 + id * 3600) as hour_start_ts_utc", "cast(id as double) % 60 as v", "id % 5 as k")
    day = F.date_format("hour_start_ts_utc", "yyyyMMdd").cast("int")
    dim = spark.sql("select id as k from range(1, 5)")

    def rows(where, extra=0):
        kept = hours.filter(where).withColumn("v", F.when(F.col("id") % 37 != 5, F.col("v")))
        return kept.unionByName(kept.filter(f"id < {extra}")).withColumn("date_key", day)

    seen = []
    summarise = ledger.summarise
    monkeypatch.setattr(ledger, "summarise", lambda df, own: seen.append(df.select("date_key").distinct().count()) or summarise(df, own))
    states = [(rows("true"), None), (rows("id not in (30, 31, 47, 48)", 3), "date'2026-01-01'"), (rows("id not between 72 and 95"), "date'2026-01-01', date'2026-01-04'"), (rows("true"), None)]
    path = str(tmp_path / "ledger")
    for state, only in states:
        changed = None if only is None else {table: incremental.Days(spark.sql(f"select explode(array({only}, date'2026-01-02', date'2026-01-03')) as d"))}
        tables = {table: state, "dim": dim}
        assert content(ledger.ledger_report(path, tables, checks, changed)) == content(report(tables, checks)), only
    assert seen == [10, 3, 3, 10], "the changed days, of which one is empty now"
    quiet = {table: incremental.Days(spark.sql("select date'2026-01-01' as d where false"))}
    ledger.ledger_report(path, {table: states[0][0], "dim": dim}, checks, quiet)
    assert len(seen) == 4, "without a changed day the table is not read"
