"""Bronze layer: daily partitions, load marks and extraction windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from citylake.functions.columns import ColumnOrName, as_col
from citylake.sources.schemas import BRONZE

# Days that sources with late uploads or revisions load again.
RELOAD_DAYS = {"bike_detections": 3, "weather_hourly": 3}
STATE = "_load_state"
STATE_SCHEMA = "source string, last_loaded_date date, updated_at timestamp"


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_bronze(
    spark: SparkSession, root: str, table: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Scan of all daily partitions; bounds on `load_date` prune directories."""
    rows = spark.read.schema(BRONZE[table]).parquet(f"{root}/{table}")
    if first is not None:
        rows = rows.filter(F.col("load_date") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("load_date") <= F.lit(last))
    return rows


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nullable numbers stay double, so the Parquet schema does not flip between days."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns if c in df.columns})


def write_partitions(df: DataFrame, path: str, partition: str = "load_date") -> None:
    """Replaces exactly the partitions present in `df`; an empty frame leaves everything as it is.

    The rebalance hint writes few files per partition and still splits a partition that holds most rows.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def land(
    df: DataFrame, root: str, table: str, day: ColumnOrName, loaded_at: datetime | Column, doubles: Sequence[str] = ()
) -> int:
    """Writes one batch of raw rows to their daily partitions and returns the number of rows.

    Repeating a load never duplicates rows. The load mark advances only when rows were written; row count and
    newest day are observed during the write itself, not by a second pass.
    """
    spark = df.sparkSession
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    batch = as_doubles(df, doubles).withColumn("_loaded_at", stamp).withColumn("load_date", as_col(day).cast("date"))
    if batch.isEmpty():
        return 0
    seen = Observation()
    batch = batch.observe(
        seen, F.count(F.lit(1)).alias("n"), F.max("load_date").alias("newest"), F.max("_loaded_at").alias("stamp")
    )
    write_partitions(batch, f"{root}/{table}")
    record_load(spark, root, table, seen.get["newest"], seen.get["stamp"])
    return seen.get["n"]


def day_of_text(column: ColumnOrName) -> Column:
    """Calendar day at the front of an ISO text time."""
    return F.to_date(F.substring(as_col(column), 1, 10))


def record_load(spark: SparkSession, root: str, source: str, newest: date, updated_at: datetime) -> None:
    """Appends a load mark. Marks are only ever added, so a reader never sees a half-written state."""
    spark.createDataFrame([(source, newest, updated_at)], STATE_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/{STATE}"
    )


def high_water_marks(state: DataFrame) -> DataFrame:
    """Newest loaded day per source: a backfill of older days cannot move it back."""
    return state.groupBy("source").agg(
        F.max("last_loaded_date").alias("last_loaded_date"), F.max("updated_at").alias("updated_at")
    )


def last_loaded(spark: SparkSession, root: str, source: str) -> date | None:
    state = read_if_exists(spark, f"{root}/{STATE}", STATE_SCHEMA)
    if state is None:
        return None
    return state.filter(F.col("source") == source).agg(F.max("last_loaded_date")).first()[0]


def resolve_window(
    last: date | None,
    today: date,
    start: date | None = None,
    end: date | None = None,
    reload_days: int = 0,
    clamp_future: bool = False,
) -> tuple[date, date]:
    """Days to load, both ends included.

    An explicit start wins. Otherwise the last loaded day is loaded again, `reload_days` earlier for sources
    that revise. A first run needs a start: nothing says how far back its files reach. `clamp_future` is for
    sources that invent or reject future days.
    """
    if clamp_future and end is not None:
        end = min(end, today)
    end = end or today
    if start is None:
        if last is None:
            raise ValueError("a first run needs a start day")
        start = last - timedelta(days=reload_days)
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start, end


def last_days(days: int, today: date, end: date | None = None) -> tuple[date, date]:
    """The `days` days that end at `end` or today."""
    if days < 1:
        raise ValueError("days must be positive")
    end = end or today
    return end - timedelta(days=days - 1), end


def day_range(spark: SparkSession, first: date, last: date, name: str = "load_date") -> DataFrame:
    """One row per day, both ends included."""
    if last < first:
        raise ValueError(f"end {last} is before start {first}")
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))
