"""A small made-up city: raw payloads of every source, landed through the public functions."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from citylake.sources import feeds as source_feeds


def square(x, y):
    return {"type": "Polygon", "coordinates": [[[x, y], [x + 0.1, y], [x + 0.1, y + 0.1], [x, y + 0.1], [x, y]]]}


def point(x, y):
    return {"type": "Point", "coordinates": [x, y]}


def features(*items):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": geometry, "properties": properties} for geometry, properties in items]}, ensure_ascii=False)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "payload string")


DISTRICTS = features(
    (square(14.0, 50.0), {"id": 1, "name": "Západ", "slug": "west", "updated_at": "2026-01-01T00:00:00.000Z"}),
    (square(14.1, 50.0), {"id": 2, "name": "Východ", "slug": "east", "updated_at": "2026-01-01T00:00:00.000Z"}))


def stations(*ids, district="west"):
    known = {"A1": (14.05, 50.05, "west"), "A2": (14.15, 50.05, "east")}
    return features(*[
        (point(*known[i][:2]), {"id": i, "name": f"Station {i}", "district": known[i][2] if i != "A1" else district,
                                "updated_at": "2026-10-01T00:00:00.000Z", "measurement": {"AQ_hourly_index": "1A"}})
        for i in ids])


COUNTERS = features(
    (point(14.02, 50.02), {"id": "C1", "name": "Most", "route": "A1", "updated_at": "2026-10-01T00:00:00Z", "directions": [{"id": "D1", "name": "in"}, {"id": "D2", "name": "out"}]}),
    (point(14.12, 50.02), {"id": "C2", "name": "Park", "route": None, "updated_at": "2026-10-01T00:00:00Z", "directions": [{"id": None, "name": None}]}))


def history(day, ids=("A1", "A2", "GHOST"), bump=0.0):
    """One publication per hour, and a later correction of the hour from five to six."""
    records = []
    for station in ids:
        for hour in range(24):
            for minute, extra in ((10, 0.0), (40, 100.0)) if hour == 6 else ((10, 0.0),):
                records.append({
                    "id": station, "updated_at": f"{day}T{hour:02d}:{minute}:00.000Z",
                    "measurement": {"AQ_hourly_index": "1A", "components": [
                        {"type": code, "averaged_time": {"averaged_hours": "1", "value": base + hour / 10 + extra + bump}}
                        for code, base in (("PM10", 20.0), ("NO2", 10.0))]}})
    return json.dumps(records)


def detections(day):
    start = datetime.fromisoformat(f"{day}T00:00:00")
    records = []
    for counter, direction in (("C1", "D1"), ("C1", "D2"), ("C2", "D1"), ("X9", "D2")):
        for slot in range(288):
            at = start + timedelta(minutes=5 * slot)
            records.append({
                "locations_id": counter, "id": direction, "measured_from": f"{at.isoformat()}.000Z",
                "measured_to": f"{(at + timedelta(minutes=5)).isoformat()}.000Z", "value": None if slot == 7 else 2,
                "value_pedestrians": None, "measurement_count": 1})
    return json.dumps(records)


def market(start, end, field, values, copies=1):
    def series():
        body = "".join(f"<Point><position>{p}</position><{field}>{v}</{field}></Point>" for p, v in values)
        return ("<TimeSeries><curveType>A03</curveType><Period><timeInterval>"
                f"<start>{start}</start><end>{end}</end></timeInterval><resolution>PT15M</resolution>{body}</Period></TimeSeries>")

    return f'<?xml version="1.0"?><Publication_MarketDocument xmlns="urn:x"><mRID>1</mRID>{series() * copies}</Publication_MarketDocument>'


ACKNOWLEDGEMENT = '<?xml version="1.0"?><Acknowledgement_MarketDocument xmlns="urn:y"><Reason><code>999</code><text>none</text></Reason></Acknowledgement_MarketDocument>'


def rates(valid_for, eur):
    row = {"order": 1, "country": "x", "currency": "y", "validFor": valid_for}
    return json.dumps({"rates": [{**row, "currencyCode": "EUR", "amount": 1, "rate": eur}, {**row, "currencyCode": "JPY", "amount": 100, "rate": 15.5}]})


def weather(day, shift=0.0):
    hours = [f"{day}T{h:02d}:00" for h in range(24)]

    def location(offset):
        return {"latitude": 50.0, "longitude": 14.0, "elevation": 200.0, "timezone": "GMT", "hourly_units": {"time": "iso8601"},
                "hourly": {"time": hours, "temperature_2m": [offset + h for h in range(24)], "relative_humidity_2m": [60] * 24,
                           "precipitation": [0.1] * 24, "wind_speed_10m": [3.6 * (1 + h % 3) + shift for h in range(24)],
                           "wind_direction_10m": [90] * 24}}

    return json.dumps([location(0.0), location(10.0)])


def utc(text):
    return datetime.fromisoformat(text)


def delivery(day, zone_start, zone_end, eur):
    """Two identical price series and one load series of a local delivery day."""
    quarters = int((zone_end - zone_start).total_seconds() // 900)
    form = "%Y-%m-%dT%H:%MZ"
    prices = market(zone_start.strftime(form), zone_end.strftime(form), "price.amount", [(p, eur + p % 4) for p in range(1, quarters + 1)], 2)
    load = market(zone_start.strftime(form), zone_end.strftime(form), "quantity", [(p, 7000 + p % 4) for p in range(1, quarters + 1)])
    return prices, load


MIDNIGHT = {
    "2026-10-24": utc("2026-10-23T22:00:00"), "2026-10-25": utc("2026-10-24T22:00:00"), "2026-10-26": utc("2026-10-25T23:00:00"),
    "2026-10-27": utc("2026-10-26T23:00:00"), "2026-10-28": utc("2026-10-27T23:00:00"), "2026-10-29": utc("2026-10-28T23:00:00"),
}


def land_snapshots(spark, root, day, loaded_at, ids=("A1", "A2"), district="west"):
    for table, text in (("city_districts", DISTRICTS), ("air_stations", stations(*ids, district=district)), ("bike_counters", COUNTERS)):
        source_feeds.land(texts(spark, text).withColumn("requested_day", F.lit(day)), root, table, loaded_at)


def land_series(spark, root, day, loaded_at, eur=25.0, bump=0.0):
    """All time series of one day; `eur` None leaves the exchange rates out."""
    text = day.isoformat()

    def land(table, payload, **columns):
        source_feeds.land(texts(spark, payload).withColumns(columns), root, table, loaded_at)

    land("air_history", history(text, bump=bump))
    land("bike_detections", detections(text))
    prices, load = delivery(text, MIDNIGHT[text], MIDNIGHT[(day + timedelta(days=1)).isoformat()], -2.0)
    land("energy_prices", prices, requested_day=F.lit(day))
    land("energy_load", load, requested_day=F.lit(day))
    if eur is not None:
        land("fx_daily", rates(text, eur), requested_day=F.lit(day))
    request = F.array(*[F.struct(F.lit(i).alias("station_id"), F.lit(50.0).alias("latitude"), F.lit(14.0).alias("longitude")) for i in ("A1", "A2")])
    land("weather_hourly", weather(text, shift=bump), stations=request)


DAYS = [date(2026, 10, 24) + timedelta(days=i) for i in range(4)]
