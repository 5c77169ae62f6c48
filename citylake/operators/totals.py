"""Sums over any period from running totals: the difference of two rows per group, however long the period.

Totals are exact whole numbers, so that differences are exact too. A total stands from its day to the day before the
next one (see `fill`), cut at the end of each month: a look-up reads the rows of one month and finds one per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import as_list
from citylake.functions.exact import SCALE, exact_parts, exact_ratio, exact_total

ROWS, MONTH, UNTIL = "n_rows", "month", "valid_until"


def _parts(values: Sequence[str]) -> list[str]:
    return [ROWS, *(f"{v}_{part}" for v in values for part in ("whole", "units", "n"))]


def daily_sums(df: DataFrame, keys: str | Sequence[str], day: str, values: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Per key and day the number of rows and, of each value, its count and exact sum in two whole numbers.

    Rows without a day belong to no period and are left out; a null key is a key.
    """
    sums = [F.count("*").alias(ROWS)]
    for v in values:
        parts = exact_parts(f"`{v}`", scale=scale)
        none = F.lit(0).cast("bigint")
        sums += [
            F.coalesce(F.sum(parts.whole), none).alias(f"{v}_whole"),
            F.coalesce(F.sum(parts.units), none).alias(f"{v}_units"),
            F.count(parts.whole).alias(f"{v}_n"),
        ]
    known = df.filter(F.col(day).isNotNull())
    return known.groupBy(*as_list(keys), F.to_date(day).alias(day)).agg(*sums)


def running_totals(daily: DataFrame, keys: str | Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """Totals of each key from its first day on: rows (keys, day, totals, `valid_until`, `month`), at least one per month
    up to the last month of the table. To be written by `month`.

    `daily` has one row per key and day, so a window over a key is bounded by the calendar.
    """
    keys = as_list(keys)
    in_order = Window.partitionBy(*keys).orderBy(day)
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = daily.agg(F.last_day(F.max(day)).alias("hi")).scalar()
    runs = daily.withColumns(
        {
            **{p: F.sum(p).over(upto) for p in _parts(values)},
            UNTIL: F.coalesce(F.date_sub(F.lead(day).over(in_order), 1), end),
        }
    )
    months = F.sequence(F.trunc(day, "month"), F.trunc(UNTIL, "month"), F.expr("interval 1 month"))
    monthly = runs.withColumn(MONTH, F.explode(months))
    return monthly.withColumns(
        {day: F.greatest(F.col(day), F.col(MONTH)), UNTIL: F.least(F.col(UNTIL), F.last_day(MONTH))}
    )


def write_totals(daily: DataFrame, keys: str | Sequence[str], day: str, values: Sequence[str], path: str) -> None:
    """Running totals as a table by month, one file per month, replacing what is there."""
    running = running_totals(daily, keys, day, values)
    running.repartition(MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def totals_on(totals: DataFrame, day: str, at: date) -> DataFrame:
    """The totals up to and including a day: one row per key that has any. Only the month of the day is read."""
    month = at.replace(day=1)
    return totals.filter((F.col(MONTH) == F.lit(month)) & (F.col(day) <= F.lit(at)) & (F.col(UNTIL) >= F.lit(at)))


def period_sums(
    totals: DataFrame,
    keys: str | Sequence[str],
    day: str,
    values: Sequence[str],
    periods: Sequence[tuple[date, date]],
    late: DataFrame | None = None,
    scale: int = SCALE,
) -> DataFrame:
    """Per period, both ends included, and key with rows in it: period_start, period_end, keys, `n_rows`, and of each
    value `<value>_sum`, `<value>_mean` (null without values) and `<value>_n`.

    Two rows per key and period are read. `late` holds daily sums that arrived after the totals were written; they are
    added to the periods they fall into, so a late day need not rewrite the totals of all days after it.
    """
    keys, parts = as_list(keys), _parts(values)
    spark = totals.sparkSession
    schema = ", ".join(["period_start date", "period_end date", *(f"`{f.name}` {f.dataType.simpleString()}" for f in totals.schema if f.name in keys)])
    months = totals.agg(F.min(MONTH).alias("lo"), F.max(MONTH).alias("hi")).first()  # partition values only
    found = []

    def signed(rows: DataFrame, start: date, end: date, sign: int) -> None:
        labels = (F.lit(start).alias("period_start"), F.lit(end).alias("period_end"))
        found.append(rows.select(*labels, *keys, *((F.col(p) * sign).alias(p) for p in parts)))

    for start, end in periods:
        if end < start:
            raise ValueError(f"period ends on {end}, before its start {start}")
        if months["lo"] is not None:
            latest = (months["hi"].replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
            for at, sign in ((end, 1), (start - timedelta(days=1), -1)):
                if at >= months["lo"]:
                    signed(totals_on(totals, day, min(at, latest)), start, end, sign)
        if late is not None:
            signed(late.filter(F.col(day).between(F.lit(start), F.lit(end))), start, end, 1)
    if not found:
        found.append(spark.createDataFrame([], ", ".join([schema, *(f"`{p}` long" for p in parts)])))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    summed = rows.groupBy("period_start", "period_end", *keys).agg(*(F.sum(p).alias(p) for p in parts)).filter(F.col(ROWS) > 0)

    def results(v: str) -> list[Column]:
        whole, units, n = F.col(f"{v}_whole"), F.col(f"{v}_units"), F.col(f"{v}_n")
        total = F.when(n > 0, exact_total(whole, units, scale))
        return [total.alias(f"{v}_sum"), exact_ratio(whole, units, n, scale).alias(f"{v}_mean"), n]

    return summed.select("period_start", "period_end", *keys, ROWS, *(c for v in values for c in results(v)))
