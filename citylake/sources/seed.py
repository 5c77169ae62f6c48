"""CSV seeds with declared types."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from citylake.sources.schemas import HOLIDAY_SEED

HOLIDAYS_FILE = Path(__file__).resolve().parent.parent / "data" / "public_holidays.csv"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def holidays(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(holiday_date, holiday_name). Without a path the packaged seed is used.

    The packaged file lives with the code on the driver; its few dozen rows are shipped with the plan.
    """
    if path:
        return read_seed(spark, path, HOLIDAY_SEED)
    lines = HOLIDAYS_FILE.read_text(encoding="utf-8").splitlines()
    text = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    from pyspark.sql import functions as F

    body = text.filter(~F.col("value").startswith("#") & ~F.col("value").startswith("holiday_date"))
    return body.select(F.from_csv("value", HOLIDAY_SEED).alias("h")).select("h.*")
