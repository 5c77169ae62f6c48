"""Incremental windows and delete+insert upserts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.columns import ColumnOrName, as_col, as_list
from citylake.functions.time import date_key
from citylake.session import cut_lineage

LOOKBACK_DAYS = 3
# Days that are handed to scans as literals; more are met by a join.
FEW_DAYS = 5000


class Days:
    """A set of calendar days that changes travel in, from the rows that landed to the tables they reach.

    The days are a relation; while there are no more than FEW_DAYS they are literals as well, so that only their
    partitions are listed and read.
    """

    def __init__(self, days: DataFrame) -> None:
        self.rows = cut_lineage(days.select(F.col(days.columns[0]).cast("date").alias("day")).where("day is not null").distinct())
        few = [r["day"] for r in self.rows.limit(FEW_DAYS + 1).collect()]
        self.few = sorted(few) if len(few) <= FEW_DAYS else None
        self.empty = not few

    def also(self, other: Days) -> Days:
        return Days(self.rows.union(other.rows))

    def _around(self, reach: int) -> tuple[DataFrame, list[date] | None]:
        steps = range(-reach, reach + 1)
        rows = self.rows.select(F.explode(F.array(*(F.date_add("day", n) for n in steps))).alias("day")).distinct()
        return rows, self.few and sorted({d + timedelta(days=n) for d in self.few for n in steps})

    def of(self, df: DataFrame, day: ColumnOrName, reach: int = 0) -> DataFrame:
        """The rows whose day is in the set, or at most `reach` days from one that is."""
        rows, few = (self.rows, self.few) if not reach else self._around(reach)
        if few is not None:
            return df.filter(as_col(day).isin(few) if few else F.lit(False))
        return df.join(rows.select(F.col("day").alias("_changed")), as_col(day) == F.col("_changed"), "left_semi")

    def of_keys(self, df: DataFrame, key: str) -> DataFrame:
        """The same for a column YYYYMMDD."""
        if self.few is not None:
            return df.filter(F.col(key).isin([d.year * 10000 + d.month * 100 + d.day for d in self.few]) if self.few else F.lit(False))
        keys = self.rows.select(date_key("day").alias("_changed"))
        return df.join(keys, F.col(key) == F.col("_changed"), "left_semi")


def changed_days(rows: DataFrame, day: str, loaded: str, since: datetime) -> Days:
    """The days of a source of which something landed at `since` or later."""
    return Days(rows.filter(F.col(loaded) >= F.lit(since)).select(day))


def differing_days(before: DataFrame, after: DataFrame, day: str, values: Sequence[str]) -> Days:
    """Days on which two versions of a small table of one row per day are not alike."""
    old = before.select(F.col(day).alias("_day"), F.struct(*values).alias("_old"))
    new = after.select(F.col(day).alias("_day"), F.struct(*values).alias("_new"))
    return Days(old.join(new, "_day", "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("_day"))


def lookback_start(target: DataFrame, column: str, days: int = LOOKBACK_DAYS) -> Column:
    """Scalar subquery: the newest value of the target minus `days`."""
    bound = F.max(column) - F.expr(f"interval {int(days)} days")
    return target.agg(bound.alias("bound")).scalar()


def newest_partition(target: DataFrame, partition: str) -> DataFrame:
    """The rows of the highest partition, found by a scan of the partition column alone, which reads no data pages."""
    newest = target.agg(F.max(partition)).first()[0]
    return target if newest is None else target.filter(F.col(partition) == F.lit(newest))


def lookback_bound(
    target: DataFrame | None, column: str, days: int = LOOKBACK_DAYS, partition: str | None = None
) -> date | datetime | None:
    """The same bound as a value for the driver; None when there is no target row yet.

    A value, unlike a subquery, reaches the Parquet filters of the source. When `partition` grows with
    `column`, only the newest partition of the target is read.
    """
    if target is None:
        return None
    rows = newest_partition(target, partition) if partition else target
    return rows.agg((F.max(column) - F.expr(f"interval {int(days)} days")).alias("bound")).first()["bound"]


def lookback(
    df: DataFrame,
    source: ColumnOrName,
    target: DataFrame | None,
    target_column: str,
    days: int = LOOKBACK_DAYS,
    partition: str | None = None,
) -> DataFrame:
    """Rows at most `days` older than the newest target row; all rows when there is none yet."""
    bound = lookback_bound(target, target_column, days, partition)
    return df if bound is None else df.filter(as_col(source) >= F.lit(bound))


def delete_insert(target: DataFrame | None, batch: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Target after the batch replaced the rows it has keys for; columns new in the batch are appended."""
    if target is None:
        return batch
    keys = as_list(keys)
    untouched = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return untouched.unionByName(batch, allowMissingColumns=True)


def touched_partitions(target: DataFrame, batch: DataFrame, keys: str | Sequence[str], partition: str) -> DataFrame:
    """Partition values an upsert has to rewrite: those of the batch and those its keys leave."""
    keys = as_list(keys)
    moved = target.join(batch.select(*keys).distinct(), keys, "left_semi").select(partition)
    return moved.union(batch.select(partition)).distinct()
