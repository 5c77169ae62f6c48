"""Ordered build of all layers as Parquet directories."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citylake.functions.time import local_date
from citylake.operators.incremental import Days, changed_days, delete_insert, differing_days
from citylake.operators.scd2 import snapshot_changes
from citylake.plans import gold, silver
from citylake.plans.contracts import FRESHNESS, all_checks
from citylake.plans.ledger import ledger_report
from citylake.plans.snapshots import append_changes, read_snapshot
from citylake.quality import as_report, enforce, freshness_report, report
from citylake.session import cut_lineage
from citylake.sources.landing import read_bronze, read_if_exists, write_partitions
from citylake.sources.schemas import BRONZE
from citylake.sources.seed import holidays

SILVER_DAY = gold.SILVER_DAY
MOST_LITERALS = 5000


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replaces a whole table that does not read itself, and reads it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str = "date_key",
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = delete_insert,
) -> DataFrame:
    """Upsert into a partitioned table; only partitions of the batch are read and rewritten.

    `merge` combines the touched partitions with the batch: delete+insert unless told otherwise.

    The partitions of the batch reach the scans of the target as literals, so that other directories are not even
    listed for reading; a batch of more than MOST_LITERALS partitions finds them by a join instead. Rows without a
    partition value form a partition of their own. The partition column must be a function of the key, so a key never
    leaves its partition. The merged rows are checkpointed before the overwrite: it must not read the files it replaces.
    """
    target = read_if_exists(spark, path)
    if target is None:
        write_partitions(batch, path, partition)
    else:
        batch = cut_lineage(batch)
        days = [r[0] for r in batch.select(partition).distinct().limit(MOST_LITERALS + 1).collect()]
        if len(days) > MOST_LITERALS:
            asked = batch.select(F.col(partition).alias("_asked")).distinct()
            touched = target.join(asked, F.col(partition).eqNullSafe(F.col("_asked")), "left_semi")
        else:
            known = F.col(partition).isin([d for d in days if d is not None])
            touched = target.filter(known | F.col(partition).isNull() if None in days else known)
        write_partitions(cut_lineage(merge(touched, batch, keys)), path, partition)
    return spark.read.option("mergeSchema", True).parquet(path)


def build(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    as_of: date,
    run_ts: datetime,
    full_refresh: bool = False,
    calendar_start: date = gold.CALENDAR_START,
    spatial_cell: float = 0.01,
    holidays_path: str | None = None,
    bronze_since: date | None = None,
    changed_since: datetime | None = None,
    written: dict[str, Days] | None = None,
) -> dict[str, DataFrame]:
    """Seed, silver, snapshot, dimensions, facts, mart. Returns every table by name.

    A full refresh rebuilds the facts from all of silver; otherwise they re-process the lookback window.

    Silver series are stored by the day of their bronze partition, facts and the mart by local day. With
    `changed_since`, the instant of the last run, the days landed since then travel through all layers as a set: a
    series rewrites these days, a fact the local days its changed silver rows fall on, the mart the days of its three
    facts. An exchange rate also reaches the days that repeat it and those that take the latest one; a changed calendar
    day rewrites that day of the mart, changed districts the whole mart. However old a late day is, only what it reaches is
    read and written.

    With `bronze_since`, only bronze days from there on are read and only their silver days replaced. Changes older than
    the lookback window then reach facts through a full refresh, as do changed counters and stations in both cases.
    Without either every series is rebuilt. `written` receives the days of the facts and the mart that a run with
    `changed_since` has written, for `check`.
    """
    tables: dict[str, DataFrame] = {name: read_bronze(spark, bronze_root, name) for name in BRONZE}

    def keep(layer: str, name: str, df: DataFrame, prefix: str = "") -> DataFrame:
        tables[prefix + name] = write_table(df, f"{out_root}/{layer}/{name}")
        return tables[prefix + name]

    seed = keep("seeds", "holidays", holidays(spark, holidays_path), "seed_")

    def silver_table(name: str, df: DataFrame) -> DataFrame:
        return keep("silver", name, df, "silver_")

    landed: dict[str, Days] = {}

    def days_of(source: str) -> Days:
        """Bronze days of a source that landed since the last run."""
        if source not in landed:
            landed[source] = changed_days(tables[source], "load_date", "_loaded_at", changed_since)
        return landed[source]

    def series(name: str, source: str, plan: Callable[[DataFrame], DataFrame], day: Column) -> DataFrame:
        """The key of a series determines its bronze day, so de-duplication never crosses a day."""
        path = f"{out_root}/silver/{name}"
        partial = (bronze_since or changed_since) is not None and read_if_exists(spark, path) is not None
        bronze = read_bronze(spark, bronze_root, source, first=bronze_since if partial and changed_since is None else None)
        if partial and changed_since is not None:
            bronze = days_of(source).of(bronze, "load_date")
        rows = plan(bronze).withColumn(SILVER_DAY, day)
        if not partial:
            rows.hint("rebalance", F.col(SILVER_DAY)).write.mode("overwrite").partitionBy(SILVER_DAY).parquet(path)
        elif changed_since is None or not days_of(source).empty:
            write_partitions(rows, path, SILVER_DAY)
        tables[f"silver_{name}"] = spark.read.parquet(path)
        return tables[f"silver_{name}"]

    def local_days(rows: DataFrame, source: str, ts: str) -> Days:
        """Local days that the changed silver rows of a series fall on."""
        return Days(days_of(source).of(rows, SILVER_DAY).select(local_date(ts)))

    districts = silver_table("city_districts", silver.city_districts(tables["city_districts"]))
    stations = silver_table("air_stations", silver.air_stations(tables["air_stations"], tables["air_history"]))
    measurements = series("air_measurements", "air_history", silver.air_measurements, F.to_date("published_ts_utc"))
    counters = silver_table(
        "bike_counters",
        silver.bike_counters(tables["bike_counters"], tables["bike_detections"], districts, spatial_cell),
    )
    directions = silver_table("bike_directions", silver.bike_directions(tables["bike_counters"]))
    start = F.to_date("interval_start_ts_utc")
    detections = series("bike_detections", "bike_detections", silver.bike_detections, start)
    delivery = local_date("hour_start_ts_utc")
    prices = series("prices_hourly", "energy_prices", silver.prices_hourly, delivery)
    load = series("load_hourly", "energy_load", silver.load_hourly, delivery)
    known = read_if_exists(spark, f"{out_root}/silver/fx_rates_daily") if changed_since is not None else None
    rates_before = cut_lineage(gold.home_rates(known)) if known is not None else None
    fx = silver_table("fx_rates_daily", silver.fx_rates_daily(tables["fx_daily"]))
    weather = series("weather_hourly", "weather_hourly", silver.weather_hourly, F.to_date("hour_start_ts_utc"))

    snapshot_path = f"{out_root}/snapshots/air_stations"
    history = read_snapshot(spark, snapshot_path, before=run_ts)
    changes = snapshot_changes(history, stations, "station_id", gold.STATION_CHECKED, run_ts)
    tables["snapshot_air_stations"] = append_changes(spark, snapshot_path, changes, run_ts)

    def before(name: str, columns: Sequence[str]) -> DataFrame | None:
        """What the mart took from a dimension in the last run."""
        held = read_if_exists(spark, f"{out_root}/gold/{name}") if changed_since is not None else None
        return cut_lineage(held.select(*columns)) if held is not None else None

    dates_before, districts_before = before("dim_date", gold.MART_DATE), before("dim_district", gold.MART_DISTRICT)
    dim_date = keep("gold", "dim_date", gold.dim_date(spark, seed, as_of, calendar_start))
    dim_district = keep("gold", "dim_district", gold.dim_district(districts))
    dim_station = keep("gold", "dim_station", gold.dim_station(tables["snapshot_air_stations"], dim_district))
    dim_counter = keep("gold", "dim_bike_counter", gold.dim_bike_counter(counters, dim_district))

    touched: dict[str, Days] = {}

    def by_day(path: str, rows: DataFrame) -> DataFrame:
        rows.hint("rebalance", F.col("date_key")).write.mode("overwrite").partitionBy("date_key").parquet(path)
        return spark.read.parquet(path)

    def fact(name: str, plan: Callable[[DataFrame | None, Days | None], DataFrame], changed: Callable[[DataFrame], Days]) -> DataFrame:
        path = f"{out_root}/gold/{name}"
        target = None if full_refresh else read_if_exists(spark, path)
        if target is None:
            tables[name] = by_day(path, plan(None, None))
        elif changed_since is None:
            tables[name] = upsert_partitions(spark, path, plan(target, None), gold.FACT_KEYS[name])
        else:
            touched[name] = changed(target)
            if not touched[name].empty:
                upsert_partitions(spark, path, plan(None, touched[name]), gold.FACT_KEYS[name])
            tables[name] = spark.read.option("mergeSchema", True).parquet(path)
        return tables[name]

    def rate_days(target: DataFrame) -> Days:
        """Days whose rate is another one than before, and if the latest rate is, those that take it."""
        rates = gold.home_rates(fx)
        if rates_before is None:
            return Days(target.select(F.to_date("hour_start_local")))
        days = differing_days(rates_before, rates, "calendar_date", ["rate"])
        newest = [rows.agg(F.max_by("rate", "calendar_date")).first()[0] for rows in (rates_before, rates)]
        if newest[0] != newest[1]:
            days = days.also(Days(target.filter("is_eur_rate_estimated").select(F.to_date("hour_start_local"))))
        return days

    def energy_days(target: DataFrame) -> Days:
        days = local_days(prices, "energy_prices", "hour_start_ts_utc").also(local_days(load, "energy_load", "hour_start_ts_utc"))
        return days.also(rate_days(target))

    air_fact = fact(
        "fact_air_quality_hourly",
        lambda t, c: gold.fact_air_quality_hourly(measurements, dim_station, t, changed=c),
        lambda t: local_days(measurements, "air_history", "measured_hour_start_ts_utc"),
    )
    weather_fact = fact(
        "fact_weather_hourly",
        lambda t, c: gold.fact_weather_hourly(weather, dim_station, t, changed=c),
        lambda t: local_days(weather, "weather_hourly", "hour_start_ts_utc"),
    )
    energy_fact = fact("fact_energy_price_hourly", lambda t, c: gold.fact_energy_price_hourly(prices, load, fx, t, changed=c), energy_days)
    fact(
        "fact_bike_traffic_daily",
        lambda t, c: gold.fact_bike_traffic_daily(detections, directions, dim_counter, t, changed=c),
        lambda t: local_days(detections, "bike_detections", "interval_start_ts_utc"),
    )

    def mart_days() -> Days | None:
        """Days of the mart that a run has to write; None for all of them."""
        parts = [touched.get(n) for n in ("fact_air_quality_hourly", "fact_weather_hourly", "fact_energy_price_hourly")]
        if None in parts or dates_before is None or districts_before is None:
            return None
        districts_now = dim_district.select(*gold.MART_DISTRICT)
        if not (districts_now.exceptAll(districts_before).isEmpty() and districts_before.exceptAll(districts_now).isEmpty()):
            return None
        days = differing_days(dates_before, dim_date, "date_day", gold.MART_DATE)
        for part in parts:
            days = days.also(part)
        return days

    path = f"{out_root}/gold/mart_air_vs_energy_daily"
    days = mart_days() if read_if_exists(spark, path) is not None else None
    mart = gold.mart_air_vs_energy_daily(air_fact, weather_fact, energy_fact, dim_district, dim_date, days)
    if days is None:
        tables["mart_air_vs_energy_daily"] = by_day(path, mart)
    else:
        write_partitions(mart, path, "date_key")
        tables["mart_air_vs_energy_daily"] = spark.read.parquet(path)
        touched["mart_air_vs_energy_daily"] = days
    if written is not None:
        written.update(touched)
    return tables


def check(
    tables: dict[str, DataFrame],
    as_of: date,
    strict: bool = True,
    now: datetime | None = None,
    ledger: str | None = None,
    written: dict[str, Days] | None = None,
) -> DataFrame:
    """Report of all declared data tests and of the age of every source; raises on a failed contract unless `strict`
    is off. `now` is the instant that ages are taken at, the current one unless given.

    With `ledger`, a folder that keeps what the tests found per day, facts and mart are read only on the days that
    `written` names for them, wholly where it does not name the table.
    """
    fresh = as_report(freshness_report(tables, FRESHNESS, now or datetime.now(timezone.utc).replace(tzinfo=None)))
    checks = all_checks(as_of)
    found = report(tables, checks) if ledger is None else ledger_report(ledger, tables, checks, written)
    result = cut_lineage(found.unionByName(fresh))
    return enforce(result) if strict else result
