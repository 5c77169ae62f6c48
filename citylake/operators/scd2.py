"""Slowly changing dimensions with validity intervals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import as_col, as_list, typed_null
from citylake.functions.keys import surrogate_key, version_key
from citylake.operators.joins import anti
from citylake.operators.ordered import previous, running_sum

# The bounds of an open history.
BEGINNING = "1900-01-01"
OPEN_END = "9999-12-31"


def first_snapshot(current: DataFrame, key: str, run_ts: Column | datetime) -> DataFrame:
    """Snapshot table after its first run: every row is an open version."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return current.select(
        "*",
        version_key(key, stamp).alias("scd_id"),
        stamp.alias("scd_valid_from"),
        typed_null("timestamp").alias("scd_valid_to"),
    )


def snapshot_check(
    history: DataFrame | None, current: DataFrame, key: str, check: Sequence[str], run_ts: Column | datetime
) -> DataFrame:
    """Next state of a snapshot table (check strategy).

    New keys and keys whose checked columns changed get a new open version; the changed version is closed at
    `run_ts`; keys missing from `current` stay open. Only open versions take part in the join.
    """
    opened = first_snapshot(current, key, run_ts)
    if history is None:
        return opened
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    is_open = F.col("scd_valid_to").isNull()
    incoming = current.select(F.col(key), F.struct(*check).alias("_new"), F.lit(True).alias("_incoming"))
    compared = history.filter(is_open).join(incoming, key, "left")
    same = F.lit(True)
    for c in check:
        same = same & F.col(c).eqNullSafe(F.col(f"_new.`{c}`"))
    changed = F.col("_incoming").isNotNull() & ~same
    carried = compared.withColumn("scd_valid_to", F.when(changed, stamp)).drop("_new", "_incoming")
    kept = carried.filter(is_open).select(key)
    added = opened.join(kept, key, "left_anti")
    return (
        history.filter(~is_open)
        .unionByName(carried, allowMissingColumns=True)
        .unionByName(added, allowMissingColumns=True)
    )


def snapshot_changes(
    history: DataFrame | None, current: DataFrame, key: str, check: Sequence[str], run_ts: Column | datetime
) -> DataFrame:
    """What a run adds to the log of a snapshot table (check strategy): new open versions, and closings of open ones.

    A row with `scd_closes` ends the version of its `scd_id` at `scd_valid_to` and holds nothing else. Only open versions
    take part in the join; a key without a change gives no row, a key missing from `current` stays open.
    """
    opened = first_snapshot(current, key, run_ts).withColumn("scd_closes", F.lit(False))
    if history is None:
        return opened
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    held = history.filter(F.col("scd_valid_to").isNull())
    known = held.select(F.col(key), "scd_id", F.struct(*[c if c in held.columns else F.lit(None).alias(c) for c in check]).alias("_old"))
    compared = opened.select(F.col(key), F.struct(*check).alias("_new")).join(known.withColumnRenamed("scd_id", "_open"), key, "left")
    same = F.col("_open").isNotNull()
    for c in check:
        same = same & F.col(f"_new.`{c}`").eqNullSafe(F.col(f"_old.`{c}`"))
    differing = compared.filter(~same)
    closings = differing.filter("_open is not null").select(key, F.col("_open").alias("scd_id"), stamp.alias("scd_valid_to"), F.lit(True).alias("scd_closes"))
    return opened.join(differing.select(key), key, "left_semi").unionByName(closings, allowMissingColumns=True)


def fold_changes(log: DataFrame) -> DataFrame:
    """The versions of a log of changes, each with the end its closing gives it."""
    ends = log.filter("scd_closes").select(F.col("scd_id").alias("_closed"), F.col("scd_valid_to").alias("_end"))
    versions = log.filter("not scd_closes").drop("scd_closes")
    joined = versions.join(ends, F.col("scd_id") == F.col("_closed"), "left")
    return joined.withColumn("scd_valid_to", F.coalesce("scd_valid_to", "_end")).select(*versions.columns)


def mark_versions(df: DataFrame, key: str, order: str, attributes: Sequence[str], slices: str | None = None):
    """Adds `attributes_hash`, `starts_version` and `version_number` (runs of equal attributes)."""
    hashed = df.withColumn("attributes_hash", surrogate_key(*attributes))
    compared = previous(hashed, key, order, {"_before": "attributes_hash"}, slices)
    flagged = compared.withColumn(
        "starts_version", F.coalesce(F.col("attributes_hash") != F.col("_before"), F.lit(True))
    ).drop("_before")
    return running_sum(flagged, key, order, F.col("starts_version").cast("int"), "version_number", slices)


def close_versions(df: DataFrame, key: str, start: str, number: str) -> DataFrame:
    """Half-open validity per version: first from the beginning of time, last one open."""
    by_start = Window.partitionBy(key).orderBy(number)
    following = F.lead(start).over(by_start)
    first = F.when(F.col(number) == 1, F.lit(BEGINNING).cast("timestamp")).otherwise(F.col(start))
    return df.select(
        "*",
        first.alias("valid_from_ts_utc"),
        F.coalesce(following, F.lit(OPEN_END).cast("timestamp")).alias("valid_to_ts_utc"),
        following.isNull().alias("is_current"),
    )


def scd2_dimension(
    snapshot: DataFrame,
    key: str,
    attributes: Sequence[str],
    version_id: str = "scd_id",
    valid_from: str = "scd_valid_from",
    slices: str | None = None,
) -> DataFrame:
    """Gap-free dimension versions from snapshot rows.

    Consecutive rows with equal attributes merge into one version that keeps the id and attributes of its
    first row. That row is the one that starts the version, so no self join is needed and all windows share
    one exchange on the key. A snapshot holds one row per key and run; pass `slices` for longer histories.
    """
    marked = mark_versions(snapshot, key, valid_from, attributes, slices)
    starts = marked.filter("starts_version").drop("starts_version", "attributes_hash")
    closed = close_versions(starts, key, valid_from, "version_number")
    return closed.select(
        F.col(version_id), key, *attributes, "version_number", "valid_from_ts_utc", "valid_to_ts_utc", "is_current"
    )


def add_inferred(reference: DataFrame, facts: DataFrame, key: str, fact_key: str, flags: dict[str, Column]):
    """Appends a row for every key that only the facts know; other attributes stay null.

    `flags` gives the non-null columns of an inferred row.
    """
    keys = facts.select(F.col(fact_key).alias(key)).distinct()
    missing = anti(keys, reference, key)
    types = {f.name: f.dataType for f in reference.schema.fields}
    columns = [
        F.col(key).cast(types[key]).alias(key)
        if name == key
        else (as_col(flags[name]) if name in flags else F.lit(None)).cast(kind).alias(name)
        for name, kind in types.items()
    ]
    return reference.unionByName(missing.select(*columns))


def add_unknown(dimension: DataFrame, values: dict[str, object]) -> DataFrame:
    """Appends the unknown member; columns not given are null."""
    row = dimension.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dimension.schema.fields]
    )
    return dimension.unionByName(row)


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str], columns: Sequence[str], default: dict):
    """Left join to a dimension with default values for rows that find no member."""
    on = as_list(on)
    joined = df.join(dimension.select(*on, *columns), on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})
