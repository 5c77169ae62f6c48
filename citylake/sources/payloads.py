"""Landed payload text to raw rows. Every function takes one payload per row and explodes it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citylake.functions.columns import ColumnOrName, as_col
from citylake.functions.json import strict_json
from citylake.sources.schemas import WEATHER_VARIABLES


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: (payload, file_path)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file_path")
    )


def _others(df: DataFrame, *dropped: str) -> list[Column]:
    return [F.col(c) for c in df.columns if c not in dropped]


def _place(df: DataFrame) -> Column | None:
    """Where a payload came from, if the rows say so."""
    return F.col("file_path") if "file_path" in df.columns else None


def explode_features(df: DataFrame, properties: str, payload: str = "payload") -> DataFrame:
    """GeoJSON FeatureCollection to one row per feature: its properties and the geometry as JSON text.

    A payload that cannot be read is an error that names its file.
    """
    shape = f"struct<features:array<struct<properties:struct<{_colon(properties)}>,geometry:string>>>"
    features = strict_json(payload, shape, _place(df))["features"]
    rows = df.select(*_others(df, payload), F.explode(features).alias("f"))
    return rows.select(*_others(rows, "f"), "f.properties.*", F.col("f.geometry").alias("geometry"))


def explode_records(df: DataFrame, fields: str, root: str | None = None, payload: str = "payload") -> DataFrame:
    """JSON record list, top level or under `root`; a missing or empty list gives no rows.

    A payload that cannot be read is an error that names its file.
    """
    records = f"array<struct<{_colon(fields)}>>"
    where = _place(df)
    parsed = strict_json(payload, f"struct<{root}:{records}>", where)[root] if root else strict_json(payload, records, where)
    rows = df.select(*_others(df, payload), F.explode(parsed).alias("r"))
    return rows.select(*_others(rows, "r"), "r.*")


def _colon(fields: str) -> str:
    """Column list to struct field list."""
    return ",".join(":".join(part.strip().rsplit(" ", 1)) for part in fields.split(", "))


def unzip_columnar(
    df: DataFrame,
    variables: Sequence[str] = WEATHER_VARIABLES,
    payload: str = "payload",
    stations: str = "stations",
) -> DataFrame:
    """Column-wise hourly arrays to one row per station and hour.

    The answer holds no ids: its i-th location belongs to the i-th entry of `stations`
    (array<struct<station_id, latitude, longitude>>, the request order). A different count is an error; a
    single location may come without a list around it. Values are doubles whatever the payload holds.
    """
    arrays = ",".join(f"{v}:array<double>" for v in variables)
    location = (
        "latitude:double,longitude:double,elevation:double,timezone:string,"
        f"hourly_units:string,hourly:struct<time:array<string>,{arrays}>"
    )
    parsed = F.from_json(payload, f"array<struct<{location}>>")
    found, wanted = F.size("_locations"), F.size(stations)
    message = F.format_string("expected %d locations, got %d", wanted, found)
    checked = F.when(found == wanted, F.arrays_zip(F.col(stations).alias("s"), F.col("_locations").alias("l"))).otherwise(
        F.raise_error(message)
    )
    pairs = df.withColumn("_locations", parsed).select(*_others(df, payload, stations), F.explode(checked).alias("p"))
    kept = _others(pairs, "p")
    series = F.arrays_zip(
        F.col("p.l.hourly.time").alias("time"),
        *[F.col(f"p.l.hourly.{v}").alias(v) for v in variables],
    )
    return pairs.select(*kept, "p", F.explode(series).alias("h")).select(
        *kept,
        F.col(f"p.s.station_id").alias("station_id"),
        F.col(f"p.s.latitude").alias("requested_latitude"),
        F.col(f"p.s.longitude").alias("requested_longitude"),
        F.col("p.l.latitude").alias("latitude"),
        F.col("p.l.longitude").alias("longitude"),
        F.col("p.l.elevation").alias("elevation"),
        F.col("p.l.timezone").alias("timezone"),
        "h.*",
        F.coalesce(F.col("p.l.hourly_units"), F.lit("{}")).alias("hourly_units"),
    )


# Time format of a market document, its fixed-interval and compressed curve types.
INTERVAL_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss]XXX"
FIXED, COMPRESSED = "A01", "A03"
DURATION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?)?$"


def _minutes(resolution: Column) -> Column:
    """Length of an ISO duration of days, hours and minutes; null for any other."""
    parts = [F.regexp_extract(resolution, DURATION, i).try_cast("int") for i in (1, 2, 3)]
    days, hours, minutes = (F.coalesce(p, F.lit(0)) for p in parts)
    total = days * 1440 + hours * 60 + minutes
    return F.when(resolution.rlike(DURATION) & (total > 0), total)


def xml_points(df: DataFrame, value_field: str, unit: str, area_code: str, payload: str = "payload") -> DataFrame:
    """XML market document to (ts_utc, value, unit, area_code).

    In a compressed curve a point also stands for all following intervals up to the next point or the period end; in
    a curve of fixed intervals a position that is left out has no value. A resolution that is no duration, a period
    without instants, another curve type or a document that cannot be read is an error. Acknowledgement documents
    hold no series and give no rows.
    """
    period = (
        "struct<timeInterval:struct<start:string,`end`:string>,resolution:string,"
        f"Point:array<struct<position:int,`{value_field}`:double>>>"
    )
    document = F.from_xml(
        payload,
        f"TimeSeries array<struct<curveType:string,Period:array<{period}>>>, unreadable string",
        {"columnNameOfCorruptRecord": "unreadable"},
    )
    named = F.concat(F.coalesce(_place(df) if _place(df) is not None else F.lit(None), F.lit("document")), F.lit(": "))
    text = F.col(payload)
    bad = text.isNotNull() & (F.trim(text) != "") & (document.isNull() | document["unreadable"].isNotNull())
    series = F.when(bad, F.raise_error(F.concat(named, F.lit("unreadable XML: "), F.left(text, F.lit(200))))).otherwise(
        document["TimeSeries"]
    )
    others = _others(df, payload)
    periods = df.select(*others, named.alias("_named"), F.explode(series).alias("t")).select(
        *others, "_named", F.coalesce("t.curveType", F.lit(FIXED)).alias("_curve"), F.explode("t.Period").alias("d")
    )

    def required(value: Column, what: str) -> Column:
        return F.coalesce(value, F.raise_error(F.concat(F.col("_named"), F.lit(what))))

    minutes = required(_minutes(F.col("d.resolution")), "no resolution that is a duration")
    start = required(F.to_timestamp("d.timeInterval.start", INTERVAL_FORMAT), "no start")
    end = required(F.to_timestamp("d.timeInterval.end", INTERVAL_FORMAT), "no end")
    curve = F.when(F.col("_curve").isin(FIXED, COMPRESSED), F.col("_curve")).otherwise(
        F.raise_error(F.concat(F.col("_named"), F.lit("curve type "), F.col("_curve")))
    )
    points = F.sort_array(
        F.transform("d.Point", lambda p: F.struct(p["position"].alias("position"), p[value_field].alias("value")))
    )
    typed = periods.select(
        *others, start.alias("_start"), end.alias("_end"), minutes.alias("_minutes"), curve.alias("_curve"), points.alias("_points")
    ).withColumn("_count", F.floor(F.timestamp_diff("MINUTE", F.col("_start"), F.col("_end")) / F.col("_minutes")).cast("int"))
    runs = F.transform(
        "_points",
        lambda p, i: F.struct(
            p["position"].alias("first"),
            F.when(F.col("_curve") == FIXED, p["position"])
            .otherwise(F.coalesce(F.get(F.col("_points"), i + 1)["position"] - 1, F.greatest("_count", p["position"])))
            .alias("last"),
            p["value"].alias("value"),
        ),
    )
    rows = typed.withColumn("_run", F.explode(runs)).withColumn(
        "_position", F.explode(F.sequence(F.col("_run.first"), F.greatest(F.col("_run.last"), F.col("_run.first"))))
    )
    shift = F.make_dt_interval(mins=(F.col("_position") - 1) * F.col("_minutes"))
    return rows.select(
        *others,
        (F.col("_start") + shift).alias("ts_utc"),
        F.col("_run.value").alias("value"),
        F.lit(unit).alias("unit"),
        F.lit(area_code).alias("area_code"),
    )


def collapse_series(df: DataFrame, keys: Sequence[str] = ("area_code", "ts_utc")) -> DataFrame:
    """One row per instant when the same series is delivered more than once."""
    from citylake.operators.dedup import latest_wins

    return latest_wins(df, list(keys), [])


def clip_half_open(df: DataFrame, ts: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> DataFrame:
    """Rows with start <= ts < end."""
    ts = as_col(ts)
    return df.filter((ts >= as_col(start)) & (ts < as_col(end)))


def latest_coordinates(stations: DataFrame, id_col: str = "id", geometry: str = "geometry", snapshot: str = "load_date"):
    """(station_id, latitude, longitude) of every station ever listed, from its latest snapshot."""
    from citylake.functions.geo import point_lon_lat

    lon, lat = point_lon_lat("_geometry")
    latest = stations.groupBy(F.col(id_col).alias("station_id")).agg(
        F.max_by(geometry, F.struct(snapshot, geometry)).alias("_geometry")
    )
    return latest.select("station_id", lat.alias("latitude"), lon.alias("longitude")).orderBy("station_id")
