"""Latest-wins rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import ColumnOrName, as_col, as_list, row_hash


def latest_wins(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[ColumnOrName]) -> DataFrame:
    """One row per key: the one with the highest `order_by`, ties settled by a hash of the whole row.

    Spark prunes each task to one row per key before the exchange (WindowGroupLimit), so a key that holds
    a large share of the rows costs one row per task, not one huge group.
    """
    order = [as_col(c).desc_nulls_last() for c in order_by] + [row_hash(df.columns).desc()]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*as_list(keys)).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_version(df: DataFrame, id_col: str, snapshot_col: str = "load_date") -> DataFrame:
    """Latest row of every id ever listed.

    Adds `first_seen_date`, `last_listed_date` and `is_listed` (seen in the newest snapshot of the whole
    table). Minimum and latest row come out of one map-side combined aggregate; the newest snapshot is a
    scalar subquery, so no window spans the table.
    """
    rest = [c for c in df.columns if c not in (id_col, snapshot_col)]
    newest = df.agg(F.max(snapshot_col)).scalar()
    row = F.struct(F.col(snapshot_col), row_hash(df.columns).alias("_tie"))
    picked = df.groupBy(id_col).agg(
        F.min(snapshot_col).alias("first_seen_date"),
        F.max(snapshot_col).alias("last_listed_date"),
        F.max_by(F.struct(*rest), row).alias("_row"),
    )
    return picked.select(
        id_col,
        *[F.col(f"_row.`{c}`").alias(c) for c in rest],
        "first_seen_date",
        "last_listed_date",
        (F.col("last_listed_date") == newest).alias("is_listed"),
    )


def latest_value(df: DataFrame, value: ColumnOrName, order: ColumnOrName) -> Column:
    """Scalar: the value of the globally latest row, without sorting the table."""
    return df.agg(F.max_by(as_col(value), as_col(order))).scalar()
