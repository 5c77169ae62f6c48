"""Daily series as runs: a known value stands for the days up to the next one.

A table of runs has as many rows as there are known values, however long the gaps between them. Days meet their run by
an interval join (`value_on`); rows for days without a value are made only for the days somebody asks for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import as_list
from citylake.functions.time import days_between
from citylake.operators.joins import interval_join

UNTIL, FIRST = "valid_until", "is_first"
OPEN_END = date(9999, 12, 31)


def value_runs(df: DataFrame, keys: str | Sequence[str], day: str, fill: bool = True) -> DataFrame:
    """The known rows with `valid_until`, the day before the next known day of the key, null for its last row, and
    `is_first`. With `fill`, nulls take the last known value of their column.

    Of rows that share key and day the last stands for the days that follow. Rows without a day are left out. A key has
    about one row per day, so its window is bounded by the calendar.
    """
    keys = as_list(keys)
    in_order = Window.partitionBy(*keys).orderBy(day)
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead(day).over(in_order)
    values = [c for c in df.columns if c not in (*keys, day)] if fill else []
    return df.filter(F.col(day).isNotNull()).withColumns(
        {
            **{c: F.last(c, ignorenulls=True).over(upto) for c in values},
            UNTIL: F.when(following.isNotNull(), F.greatest(F.col(day), F.date_sub(following, 1))),
            FIRST: F.lag(F.lit(True), 1, False).over(in_order) == F.lit(False),
        }
    )


def value_on(asked: DataFrame, runs: DataFrame, key: str, day: str, run_day: str, values: Sequence[str], how: str = "left") -> DataFrame:
    """The asked rows (key, day, ...) with the values that stand on their day, and `known_day`, the day these are from.

    Before the first known day, and without a key or a day, all of it is null. `runs` come from `value_runs`; the join is
    linear in rows and runs, and no row is made for a day that nobody asks for.
    """
    ended = F.coalesce(F.date_add(F.col(UNTIL), 1), F.lit(OPEN_END))
    versions = runs.select(key, F.col(run_day).alias("_from"), ended.alias("_to"), F.col(run_day).alias("known_day"), *values)
    # Of rows that share key and day all but the last stand for a day on which the last stands too.
    latest = versions.groupBy(key, "_from").agg(F.max_by(F.struct("_to", "known_day", *values), "_to").alias("v")).select(key, "_from", "v.*")
    return interval_join(asked, latest, key, day, "_from", "_to", how).drop("_from", "_to")


def densify(df: DataFrame, keys: str | Sequence[str], day: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Every key on every calendar day between the first and the last day of the whole table, or between the days given.

    Days without a row have null values; `is_forward_filled` marks them.
    """
    return _on_days(df, as_list(keys), day, first, last, fill=False)


def dense_forward_fill(
    df: DataFrame, keys: str | Sequence[str], day: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Dense daily rows; values of missing days repeat the last known ones, also those from before `first`."""
    return _on_days(df, as_list(keys), day, first, last, fill=True)


def _on_days(df: DataFrame, keys: list[str], day: str, first: date | None, last: date | None, fill: bool) -> DataFrame:
    """Each run gives its own days: one exchange, no grid of keys and days to join with."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    lo = F.lit(first) if first else bounds.select("lo").scalar()
    hi = F.lit(last) if last else bounds.select("hi").scalar()
    start = F.when(F.col(FIRST), lo).otherwise(F.greatest(F.col(day), lo))
    days = days_between(start, F.least(F.coalesce(F.col(UNTIL), hi), hi))
    spread = value_runs(df, keys, day, fill).withColumn("_day", F.explode(days))
    stands = F.col("_day") >= F.col(day) if fill else F.col("_day") == F.col(day)

    def value(name: str) -> Column:
        return F.when(stands, F.col(f"`{name}`")).alias(name)

    values = [value(c) for c in df.columns if c not in (*keys, day)]
    return spread.select(*keys, F.col("_day").alias(day), *values, (F.col("_day") != F.col(day)).alias("is_forward_filled"))
