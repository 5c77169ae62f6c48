"""Joins with validity intervals, reference checks and set membership.

Spark broadcasts a side only when its measured size is below the threshold, and splits hot keys of a sort-merge join at
run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.columns import as_list
from citylake.operators.ordered import SLICE, cut_long_groups, forward_fill, running_max

# A fact may be held against this many versions of its key; of keys with more the versions and facts are merged in order.
MOST_VERSIONS = 64
# Months in a period of the join by month.
MOST_MONTHS = 12


def _month(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def _period(month: Column, width: Column) -> Column:
    return F.floor(month / width).cast("int")


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    valid_from: str = "valid_from_ts_utc",
    valid_to: str = "valid_to_ts_utc",
    how: str = "left",
    by_month: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Attaches the version valid at `ts` (valid_from <= ts < valid_to); `how` is left or inner.

    The versions per key are counted first. While no key has more than MOST_VERSIONS, the key is an equality and the
    interval a residual condition. Beyond that facts and versions are merged in the order of time (`merged_versions`),
    in work linear in their number; only versions that overlap, of which a fact may have several, stay with the plain
    join. `slices` is the number of runs the merged rows are cut into.

    `by_month` is for large version tables that overlap: versions are repeated for the periods they cover within the
    range of the facts, so period joins the key as an equality and a fact meets only the versions of its period. A period
    has as many months as the median version, MOST_MONTHS at most: versions of years are not repeated month by month.
    """
    if how not in ("left", "inner"):
        raise ValueError("an interval join is left or inner")
    right = versions.withColumnRenamed(key, "_version_of")
    matches = (F.col("_version_of") == F.col(key)) & (F.col(ts) >= F.col(valid_from)) & (F.col(ts) < F.col(valid_to))
    if by_month:
        left, right = in_periods(facts, right, ts, valid_from, valid_to)
        joined = left.join(right, (F.col("_period") == F.col("_version_period")) & matches, how)
        return joined.drop("_version_of", "_period", "_version_period")
    most = versions.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if most > MOST_VERSIONS and not versions_overlap(versions, key, valid_from, valid_to):
        return merged_versions(facts, versions, key, ts, valid_from, valid_to, how, slices)
    return facts.join(right, matches, how).drop("_version_of")


def in_periods(facts: DataFrame, versions: DataFrame, ts: str, valid_from: str, valid_to: str) -> tuple[DataFrame, DataFrame]:
    """Facts with the `_period` of their instant, versions once for every `_version_period` that they cover within the
    range of the facts. Half of the versions are as long as a period or longer, so most are repeated once or twice.
    """
    bounds = facts.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    first = _month(F.greatest(F.col(valid_from), bounds.select("lo").scalar()))
    last = _month(F.least(F.col(valid_to), bounds.select("hi").scalar()))
    lengths = versions.select((last - first).alias("months")).filter("months >= 0")
    usual = F.least(F.greatest(F.percentile_approx("months", 0.5), F.lit(1)), F.lit(MOST_MONTHS))
    width = lengths.agg(F.coalesce(usual, F.lit(1)).alias("width")).scalar()
    periods = F.when(first <= last, F.sequence(_period(first, width), _period(last, width)))
    return (
        facts.withColumn("_period", _period(_month(F.col(ts)), width)),
        versions.withColumn("_version_period", F.explode(periods)),
    )


def versions_overlap(versions: DataFrame, key: str, valid_from: str, valid_to: str) -> bool:
    """Whether two versions of one key are valid at the same instant."""
    numbered = versions.select(key, valid_from, valid_to, F.xxhash64(key, valid_from, valid_to).alias("_number"))
    slices = int(versions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return not overlapping_versions(numbered, key, "_number", valid_from, valid_to, slices).isEmpty()


def merged_versions(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    valid_from: str,
    valid_to: str,
    how: str = "left",
    slices: int | None = None,
) -> DataFrame:
    """The interval join of versions that do not overlap, as one pass over facts and versions in the order of time.

    Both become rows of one sequence, a version before the facts of its first instant. The sequence is cut into runs of
    even size whatever the keys; inside a run each fact takes the last version before it, and the version open at the
    end of a run is carried to the next. No fact is compared with more than one version, and a key with most of the
    facts or versions is spread over many tasks. Facts without a key or an instant have no version; a version that ends
    before it starts, or without a bound, is valid never.
    """
    kept = [c for c in versions.columns if c != key]
    fact = F.struct(*(F.col(f"`{c}`") for c in facts.columns))
    version = F.struct(*(F.col(f"`{c}`") for c in kept), F.col(valid_to).alias("_until"))
    started = versions.where(F.col(key).isNotNull() & (F.col(valid_from) < F.col(valid_to)))
    started = started.select(F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    asked = facts.select(F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"), fact.alias("_fact"))
    sequence = started.unionByName(asked, allowMissingColumns=True)
    order = ["_at", "_kind"]
    carried = forward_fill(cut_long_groups(sequence, "_key", order, slices), "_key", order, ["_version"], SLICE)
    valid = F.coalesce(F.col("_at") < F.col("_version._until"), F.lit(False))
    found = carried.where(F.col("_kind") == 1)
    found = found.where(valid) if how == "inner" else found.withColumn("_version", F.when(valid, F.col("_version")))
    return found.select("_fact.*", *(F.col(f"_version.`{c}`").alias(c) for c in kept))


def anti(df: DataFrame, other: DataFrame, on: str | Sequence[str], other_on: str | Sequence[str] | None = None):
    """Rows whose key is known and absent from `other`; a null key is never reported."""
    on, other_on = as_list(on), as_list(other_on or on)
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    keys = other.select(*[F.col(o).alias(c) for c, o in zip(on, other_on, strict=True)]).distinct()
    return df.filter(known).join(keys, on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str], other_on: str | Sequence[str] | None = None):
    on, other_on = as_list(on), as_list(other_on or on)
    keys = other.select(*[F.col(o).alias(c) for c, o in zip(on, other_on, strict=True)]).distinct()
    return df.join(keys, on, "left_semi")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL `NOT IN`: one null in `other` empties the result, null keys are dropped.

    Written as an ordinary anti join plus one flag, so it does not depend on broadcasting `other`.
    """
    has_null = other.agg(F.coalesce(F.bool_or(F.col(other_column).isNull()), F.lit(False))).scalar()
    return anti(df, other, column, other_column).filter(~has_null)


def overlapping_versions(
    df: DataFrame,
    key: str,
    version: str,
    valid_from: str = "valid_from_ts_utc",
    valid_to: str = "valid_to_ts_utc",
    slices: int | None = None,
) -> DataFrame:
    """Versions that start before an earlier version of the same key has ended.

    One row per offending version, with the earlier version that reaches furthest: empty exactly when no two
    versions overlap, and linear in the number of versions where a list of all pairs would be quadratic.
    `slices` cuts keys with very many versions.
    """
    until = F.struct(F.col(valid_to).alias("until"), F.col(version).alias("version"))
    rows = df.filter(F.col(valid_from) < F.col(valid_to)).select(key, version, valid_from, until.alias("_until"))
    order = [valid_from, version]
    if slices:
        reached = running_max(cut_long_groups(rows, key, order, slices), key, order, "_until", "_reach", SLICE)
    else:
        reached = running_max(rows, key, order, "_until", "_reach")
    return reached.filter(F.col("_reach.until") > F.col(valid_from)).select(
        key, version, F.col("_reach.version").alias(f"overlapping_{version}")
    )


def outer_merge(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Full outer join with one merged key column each."""
    return left.join(right, as_list(on), "full")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of rows that carry them. Null keys pass.

    Child rows are counted per key before the join, so a hot key travels as one row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("failures"))
    return anti(keys, parent, column, parent_column)


def with_scalar(df: DataFrame, name: str, scalar: Column) -> DataFrame:
    """Attaches a one-row relation as a scalar subquery (no cross join, and no row is lost if it is empty)."""
    return df.withColumn(name, scalar)
