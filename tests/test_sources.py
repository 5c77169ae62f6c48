from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from citylake.sources import feeds as source_feeds, landing, payloads, schemas
from citylake.sources.seed import HOLIDAYS_FILE, holidays
from tests import city


def test_features_keep_nested_values_as_json(spark):
    df = payloads.explode_features(city.texts(spark, city.COUNTERS), schemas.COUNTER_PROPERTIES)
    assert df.columns == ["id", "name", "route", "updated_at", "directions", "geometry"]
    first = df.orderBy("id").first()
    assert json.loads(first.directions) == [{"id": "D1", "name": "in"}, {"id": "D2", "name": "out"}]
    assert json.loads(first.geometry) == {"type": "Point", "coordinates": [14.02, 50.02]}


def test_non_ascii_text_survives(spark, rows):
    df = payloads.explode_features(city.texts(spark, city.DISTRICTS), schemas.DISTRICT_PROPERTIES)
    assert rows(df, "id", "name") == [(1, "Západ"), (2, "Východ")]


def test_no_features_no_rows(spark):
    df = city.texts(spark, '{"type":"FeatureCollection","features":[]}', '{"type":"FeatureCollection"}')
    assert payloads.explode_features(df, schemas.STATION_PROPERTIES).count() == 0


def test_records_and_missing_rates(spark):
    df = city.texts(spark, city.rates("2026-10-02", 24.5), '{"errorCode":"VALIDATION"}')
    got = payloads.explode_records(df, schemas.RATE_RECORD, "rates")
    assert got.columns == ["validFor", "order", "country", "currency", "amount", "currencyCode", "rate"]
    assert sorted((r.currencyCode, r.amount, r.rate) for r in got.collect()) == [("EUR", 1, 24.5), ("JPY", 100, 15.5)]


def test_null_counts_stay_null_doubles(spark):
    df = payloads.explode_records(city.texts(spark, city.detections("2026-10-24")), schemas.DETECTION_RECORD)
    assert df.schema["value"].dataType.simpleString() == "double"
    assert df.filter("value is null").count() == 4 and df.count() == 4 * 288


def request(*ids):
    return F.array(*[F.struct(F.lit(i).alias("station_id"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude")) for i in ids])


def test_locations_follow_the_request_order(spark):
    df = payloads.unzip_columnar(city.texts(spark, city.weather("2026-10-24")).withColumn("stations", request("A1", "A2")))
    got = {(r.station_id, r.time): r.temperature_2m for r in df.collect()}
    assert len(got) == 48
    assert got["A1", "2026-10-24T05:00"] == 5.0 and got["A2", "2026-10-24T05:00"] == 15.0
    assert json.loads(df.first().hourly_units) == {"time": "iso8601"}


def test_single_location_without_list(spark):
    single = json.dumps(json.loads(city.weather("2026-10-24"))[0])
    assert payloads.unzip_columnar(city.texts(spark, single).withColumn("stations", request("A1"))).count() == 24


def test_location_count_mismatch_is_an_error(spark):
    df = city.texts(spark, city.weather("2026-10-24")).withColumn("stations", request("A1"))
    with pytest.raises(Exception, match="expected 1 locations, got 2"):
        payloads.unzip_columnar(df).collect()


def prices(spark, *documents):
    return payloads.xml_points(city.texts(spark, *documents), "price.amount", "EUR/MWh", "area")


def test_xml_points_duplicates_and_clip(spark):
    document = city.market("2026-10-02T22:00Z", "2026-10-03T22:00Z", "price.amount", [(p, p / 10) for p in range(1, 97)], copies=2)
    points = prices(spark, document)
    assert points.count() == 192
    single = payloads.collapse_series(points)
    assert single.count() == 96
    clipped = payloads.clip_half_open(single, "ts_utc", F.lit("2026-10-02T22:00:00Z").cast("timestamp"), F.lit("2026-10-03T22:00:00Z").cast("timestamp"))
    assert clipped.count() == 96
    assert clipped.agg(F.date_format(F.max("ts_utc"), "HH:mm")).first()[0] == "21:45"
    assert payloads.clip_half_open(single, "ts_utc", F.lit("2026-10-03T00:00:00Z").cast("timestamp"), F.lit("2026-10-03T01:00:00Z").cast("timestamp")).count() == 4


def test_left_out_positions_repeat_the_previous_value(spark):
    points = prices(spark, city.market("2026-10-02T22:00Z", "2026-10-03T00:00Z", "price.amount", [(1, 1.0), (3, 3.0), (6, 6.0)]))
    assert [r.value for r in points.orderBy("ts_utc").collect()] == [1.0, 1.0, 3.0, 3.0, 3.0, 6.0, 6.0, 6.0]


def test_acknowledgement_means_no_rows(spark):
    assert prices(spark, city.ACKNOWLEDGEMENT).count() == 0


def test_payload_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(json.loads(city.rates("2026-10-02", 24.5)), indent=2))
    files = payloads.read_payloads(spark, str(tmp_path))
    assert files.count() == 2
    assert payloads.explode_records(files, schemas.RATE_RECORD, "rates").select("file_path").distinct().count() == 2


def test_latest_coordinates_of_moved_and_removed(spark, rows):
    def row(i, x, day):
        return (i, json.dumps(city.point(x, 50.0)), day)

    df = spark.createDataFrame([row("a", 1.0, date(2026, 1, 1)), row("a", 2.0, date(2026, 1, 2)), row("b", 3.0, date(2026, 1, 1))],
                               "id string, geometry string, load_date date")
    assert rows(payloads.latest_coordinates(df)) == [("a", 50.0, 2.0), ("b", 50.0, 3.0)]


def test_holiday_seed(spark, tmp_path):
    packaged = holidays(spark)
    assert packaged.count() == 39 and packaged.filter("holiday_date is null or holiday_name is null").count() == 0
    copy = tmp_path / "h.csv"
    copy.write_text(HOLIDAYS_FILE.read_text(encoding="utf-8"), encoding="utf-8")
    assert sorted(holidays(spark, str(copy)).collect()) == sorted(packaged.collect())


STAMP = datetime(2026, 10, 27, 1)


def test_landing_is_idempotent_and_keeps_other_days(spark, tmp_path, rows):
    root = str(tmp_path)
    df = spark.createDataFrame([("x", "2026-10-24T01:00Z"), ("y", "2026-10-25T01:00Z")], "id string, updated_at string").withColumn("measurement", F.lit("{}"))
    day = landing.day_of_text("updated_at")
    assert landing.land(df, root, "air_history", day, STAMP) == 2
    assert landing.last_loaded(spark, root, "air_history") == date(2026, 10, 25)
    later = datetime(2026, 10, 28)
    assert landing.land(df.filter("id = 'x'").withColumn("id", F.lit("z")), root, "air_history", day, later) == 1
    assert rows(landing.read_bronze(spark, root, "air_history"), "id", "_loaded_at") == [("y", STAMP), ("z", later)]
    assert landing.last_loaded(spark, root, "air_history") == date(2026, 10, 25), "a backfill never moves the mark back"
    assert landing.land(df.filter("id = 'none'"), root, "air_history", day, later) == 0
    assert landing.read_bronze(spark, root, "air_history").count() == 2
    assert landing.read_bronze(spark, root, "air_history", first=date(2026, 10, 25)).count() == 1


def test_an_empty_first_batch_leaves_no_mark(spark, tmp_path):
    empty = spark.createDataFrame([], "id string, updated_at string, measurement string")
    assert landing.land(empty, str(tmp_path), "air_history", landing.day_of_text("updated_at"), STAMP) == 0
    assert landing.last_loaded(spark, str(tmp_path), "air_history") is None


TODAY = date(2026, 10, 7)


@pytest.mark.parametrize(
    ("last", "options", "expected"),
    [
        (None, {"start": date(2026, 1, 5)}, (date(2026, 1, 5), TODAY)),
        (date(2026, 10, 5), {}, (date(2026, 10, 5), TODAY)),
        (date(2026, 10, 5), {"reload_days": 3}, (date(2026, 10, 2), TODAY)),
        (date(2026, 10, 5), {"start": date(2026, 9, 1), "end": date(2026, 9, 2)}, (date(2026, 9, 1), date(2026, 9, 2))),
        (date(2026, 10, 5), {"end": date(2026, 12, 1), "clamp_future": True}, (date(2026, 10, 5), TODAY)),
        (date(2026, 10, 5), {"end": date(2026, 10, 8)}, (date(2026, 10, 5), date(2026, 10, 8))),
    ],
)
def test_load_window(last, options, expected):
    assert landing.resolve_window(last, TODAY, **options) == expected


def test_load_window_rejects_start_after_end():
    with pytest.raises(ValueError):
        landing.resolve_window(None, TODAY, start=date(2026, 10, 9))


def test_a_first_load_window_needs_a_start():
    with pytest.raises(ValueError, match="start"):
        landing.resolve_window(None, TODAY)


RECORD = "id string, value double"


@pytest.mark.parametrize("text", ['[{"id": "a", "value": 1.0}, {"id": "b"', "no json", '{"id": [1'])
def test_an_unreadable_payload_is_an_error_that_names_its_file(spark, text):
    df = spark.createDataFrame([('[{"id": "a", "value": 1.0}]', "good.json"), (text, "dir/bad.json")], "payload string, file_path string")
    with pytest.raises(Exception, match="dir/bad.json"):
        payloads.explode_records(df, RECORD).collect()
    with pytest.raises(Exception, match="dir/bad.json"):
        features = spark.createDataFrame([('{"features": []}', "good.json"), (text.replace("[{", '{"features": [{'), "dir/bad.json")], df.schema)
        payloads.explode_features(features, "id string").collect()


@pytest.mark.parametrize(("text", "root"), [("[]", None), (None, None), ("", None), ("null", None), ('{"other": 1}', "rates"), ('{"rates": []}', "rates"), ("{}", "rates")])
def test_empty_and_missing_lists_give_no_rows(spark, text, root):
    df = spark.createDataFrame([(text, "f")], "payload string, file_path string")
    assert payloads.explode_records(df, RECORD, root).collect() == []


def curve(kind, resolution, positions, end="2026-01-01T01:00Z"):
    points = "".join(f"<Point><position>{p}</position><quantity>{10 * p}</quantity></Point>" for p in positions)
    declared = f"<curveType>{kind}</curveType>" if kind else ""
    return (
        f"<doc><TimeSeries>{declared}<Period><timeInterval><start>2026-01-01T00:00Z</start><end>{end}</end></timeInterval>"
        f"<resolution>{resolution}</resolution>{points}</Period></TimeSeries></doc>"
    )


@pytest.mark.parametrize(
    ("kind", "resolution", "end", "expected"),
    [
        ("A01", "PT15M", "2026-01-01T01:00Z", [("00:00", 10.0), ("00:30", 30.0)]),
        (None, "PT15M", "2026-01-01T01:00Z", [("00:00", 10.0), ("00:30", 30.0)]),
        ("A03", "PT15M", "2026-01-01T01:00Z", [("00:00", 10.0), ("00:15", 10.0), ("00:30", 30.0), ("00:45", 30.0)]),
        ("A03", "P1D", "2026-01-04T00:00Z", [("01 00:00", 10.0), ("02 00:00", 10.0), ("03 00:00", 30.0)]),
    ],
)
def test_curve_type_and_resolution(spark, kind, resolution, end, expected):
    df = spark.createDataFrame([(curve(kind, resolution, (1, 3), end),)], "payload string")
    rows = payloads.xml_points(df, "quantity", "MW", "area").orderBy("ts_utc").collect()
    form = "%d %H:%M" if resolution == "P1D" else "%H:%M"
    assert [(r.ts_utc.strftime(form), r.value) for r in rows] == expected


@pytest.mark.parametrize(("kind", "resolution"), [("A03", "P1Y"), ("A03", "soon"), ("A77", "PT15M")])
def test_what_a_market_document_does_not_say_is_an_error(spark, kind, resolution):
    df = spark.createDataFrame([(curve(kind, resolution, (1,)), "m.xml")], "payload string, file_path string")
    with pytest.raises(Exception, match="m.xml"):
        payloads.xml_points(df, "quantity", "MW", "area").collect()


def test_last_days_and_day_range(spark):
    assert landing.last_days(7, TODAY) == (date(2026, 10, 1), TODAY)
    with pytest.raises(ValueError):
        landing.last_days(0, TODAY)
    assert landing.day_range(spark, date(2026, 2, 27), date(2026, 3, 1)).count() == 3
    with pytest.raises(ValueError):
        landing.day_range(spark, date(2026, 3, 1), date(2026, 2, 27))


def test_every_source_has_a_feed_and_its_window(spark, tmp_path):
    assert set(source_feeds.FEEDS) == set(schemas.BRONZE)
    root, today = str(tmp_path), date(2026, 10, 28)
    with pytest.raises(ValueError, match="start"):
        source_feeds.window(spark, root, "bike_detections", today)
    city.land_series(spark, root, date(2026, 10, 26), STAMP)
    assert source_feeds.window(spark, root, "bike_detections", today) == (date(2026, 10, 23), today)
    assert source_feeds.window(spark, root, "air_history", today) == (date(2026, 10, 26), today)
    assert source_feeds.window(spark, root, "fx_daily", today, end=date(2026, 11, 3)) == (date(2026, 10, 26), today)
    assert source_feeds.window(spark, root, "energy_prices", today, end=date(2026, 10, 29)) == (date(2026, 10, 26), date(2026, 10, 29))


def test_a_feed_keeps_to_its_days(spark, tmp_path):
    root = str(tmp_path)
    text = json.dumps([{"id": "A", "updated_at": f"2026-10-{d}T01:00:00Z", "measurement": {}} for d in (20, 21, 22)])
    rows = spark.createDataFrame([(text, "x.json")], "payload string, file_path string")
    assert source_feeds.land(rows, root, "air_history", STAMP, (date(2026, 10, 21), date(2026, 10, 22))) == 2
    assert landing.last_loaded(spark, root, "air_history") == date(2026, 10, 22)
