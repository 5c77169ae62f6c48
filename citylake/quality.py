"""Data-quality checks: each returns the rows that fail it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.columns import as_col, as_list
from citylake.operators.joins import orphans
from citylake.operators.ordered import time_gaps

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """`predicate` (row-level failure condition) or `failing` (tables -> failing rows)."""

    table: str
    name: str
    severity: str = ERROR
    predicate: Callable[[], Column] | None = None
    failing: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None

    def on(self, table: str) -> Check:
        return replace(self, table=table)

    def warn(self) -> Check:
        return replace(self, severity=WARN)

    def rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        if self.predicate is not None:
            return tables[self.table].filter(self.predicate())
        return self.failing(tables)


# ---------------------------------------------------------------- failing rows


def null_rows(column: str, where: str | None = None) -> Column:
    missing = F.col(column).isNull()
    return missing & F.expr(where) if where else missing


def duplicated(df: DataFrame, columns: str | Sequence[str], ignore_nulls: bool = True) -> DataFrame:
    columns = as_list(columns)
    if ignore_nulls:
        df = df.dropna(subset=columns)
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def outside_values(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def outside_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    value, failed = as_col(column), F.lit(False)
    if low is not None:
        failed = failed | (value < low if inclusive else value <= low)
    if high is not None:
        failed = failed | (value > high if inclusive else value >= high)
    return value.isNotNull() & failed


def days_without(df: DataFrame, day: str, present: Column) -> DataFrame:
    """Calendar days of the table on which no row satisfies `present`."""
    per_day = df.groupBy(day).agg(F.coalesce(F.bool_or(present), F.lit(False)).alias("_ok"))
    return per_day.filter(~F.col("_ok")).select(day)


def short_horizon(df: DataFrame, day: str, as_of, days: int = 365) -> DataFrame:
    """The last day of the table if it lies less than `days` ahead."""
    last = df.agg(F.max(day).alias("last_day"))
    return last.filter(F.col("last_day") < F.date_add(F.lit(as_of).cast("date"), days))


def freshness(df: DataFrame, loaded_at: str, as_of: datetime | Column, warn: timedelta, error: timedelta) -> DataFrame:
    """One row: newest load, age in hours and pass / warn / error. Informs; it never blocks a run."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    status = (
        F.when(age.isNull() | (age > int(error.total_seconds())), "error")
        .when(age > int(warn.total_seconds()), "warn")
        .otherwise("pass")
    )
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    return newest.select("max_loaded_at", F.round(age / 3600, 2).alias("age_hours"), status.alias("status"))


def freshness_report(
    tables: Mapping[str, DataFrame], limits: Mapping[str, tuple[timedelta, timedelta]], as_of: datetime, loaded_at: str = "_loaded_at"
) -> DataFrame:
    """`freshness` of every table that has limits: (table_name, max_loaded_at, age_hours, status)."""
    parts = [freshness(tables[t], loaded_at, as_of, *limits[t]).select(F.lit(t).alias("table_name"), "*") for t in sorted(limits)]
    return reduce(DataFrame.unionByName, parts)


def as_report(fresh: DataFrame) -> DataFrame:
    """Freshness rows in the form of `report`; a late source warns and never fails a run."""
    late = F.col("status") != "pass"
    return fresh.select(
        "table_name",
        F.concat(F.lit("freshness: "), "status").alias("check_name"),
        F.lit(WARN).alias("severity"),
        late.cast("bigint").alias("failures"),
        F.when(late, "warn").otherwise("pass").alias("status"),
    )


# ---------------------------------------------------------------- declarations


def not_null(*columns: str, where: str | None = None) -> list[Check]:
    return [Check("", f"not_null({c})", predicate=lambda c=c: null_rows(c, where)) for c in columns]


def unique(*columns: str) -> list[Check]:
    return [_keyed([c], f"unique({c})", True) for c in columns]


def unique_together(*columns: str) -> list[Check]:
    return [_keyed(list(columns), f"unique_together({', '.join(columns)})", False)]


def _keyed(columns: list[str], name: str, ignore_nulls: bool) -> Check:
    return Check("", name, failing=_Duplicates(columns, ignore_nulls))


@dataclass(frozen=True)
class _Duplicates:
    columns: list[str]
    ignore_nulls: bool
    table: str = ""

    def __call__(self, tables):
        return duplicated(tables[self.table], self.columns, self.ignore_nulls)


@dataclass(frozen=True)
class _Orphans:
    column: str
    parent: str
    parent_column: str
    table: str = ""

    def __call__(self, tables):
        return orphans(tables[self.table], self.column, tables[self.parent], self.parent_column)


@dataclass(frozen=True)
class _Gaps:
    column: str
    keys: tuple[str, ...]
    unit: str
    table: str = ""

    def __call__(self, tables):
        return time_gaps(tables[self.table], self.column, self.keys, self.unit)


def relationship(column: str, parent: str, parent_column: str) -> list[Check]:
    return [Check("", f"relationship({column} -> {parent}.{parent_column})", failing=_Orphans(column, parent, parent_column))]


def accepted_values(column: str, values: Sequence, severity: str = ERROR) -> list[Check]:
    return [Check("", f"accepted_values({column})", severity, predicate=lambda: outside_values(column, values))]


def accepted_range(column: str, low=None, high=None, inclusive: bool = True, severity: str = ERROR) -> list[Check]:
    return [Check("", f"accepted_range({column})", severity, predicate=lambda: outside_range(column, low, high, inclusive))]


def non_negative(*columns: str) -> list[Check]:
    return [Check("", f"non_negative({c})", WARN, predicate=lambda c=c: F.col(c) < 0) for c in columns]


def no_time_gaps(column: str, *keys: str, unit: str = "hour") -> list[Check]:
    return [Check("", f"no_time_gaps({column})", WARN, failing=_Gaps(column, keys, unit))]


def bind(table: str, *groups: list[Check]) -> list[Check]:
    """Ties declarations to a table."""
    bound = []
    for check in (c for group in groups for c in group):
        failing = replace(check.failing, table=table) if check.failing is not None else None
        bound.append(replace(check, table=table, failing=failing))
    return bound


# ---------------------------------------------------------------- report

REPORT = ("table_name", "check_name", "severity", "failures", "status")


def _missing_references(tables: Mapping[str, DataFrame], table: str, checks: Sequence[Check]) -> DataFrame:
    """Rows of a table whose keys have no parent, per reference check: the keys of all its references are counted in one
    pass, so that a hot key meets the parents as one row."""
    refs = [c.failing for c in checks]
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(r.column).cast("string").alias("v")) for i, r in enumerate(refs)])
    keys = tables[table].select(F.explode(pairs).alias("p")).select("p.*").filter("v is not null")
    counted = keys.groupBy("i", "v").agg(F.count("*").alias("n"))
    parents = reduce(
        DataFrame.unionByName,
        [tables[r.parent].select(F.lit(i).alias("i"), F.col(r.parent_column).cast("string").alias("v")) for i, r in enumerate(refs)],
    )
    missing = counted.join(parents, ["i", "v"], "left_anti")
    sums = F.array(*[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)) for i in range(len(refs))])
    named = F.array(
        *[F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity")) for c in checks]
    )
    rows = missing.agg(sums.alias("s")).select(F.explode(F.arrays_zip(named.alias("c"), F.col("s").alias("s"))).alias("r"))
    return rows.select("r.c.*", F.col("r.s").alias("failures"))


def report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(table_name, check_name, severity, failures, status).

    All row-level checks of a table share one scan and one aggregate row, all its references one scan and one
    aggregate by key. Unique and gap checks need an exchange each and contribute one count each.
    """
    parts = []
    references: dict[str, list[Check]] = {}
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.predicate is not None:
            by_table.setdefault(check.table, []).append(check)
    for table, row_checks in by_table.items():
        counts = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.severity).alias("severity"),
                    F.count_if(c.predicate()).alias("failures"),
                )
                for c in row_checks
            ]
        )
        parts.append(tables[table].agg(counts.alias("c")).select(F.explode("c").alias("c")).select("c.*"))
    for check in checks:
        if isinstance(check.failing, _Orphans):
            references.setdefault(check.table, []).append(check)
        elif check.failing is not None:
            rows = check.failing(tables)
            parts.append(
                rows.agg(F.count("*").alias("failures")).select(
                    F.lit(check.table).alias("table_name"),
                    F.lit(check.name).alias("check_name"),
                    F.lit(check.severity).alias("severity"),
                    "failures",
                )
            )
    parts += [_missing_references(tables, table, own) for table, own in references.items()]
    combined = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
    return combined.withColumn("status", status).select(*REPORT)


class QualityError(RuntimeError):
    """At least one contract check failed."""


def enforce(result: DataFrame) -> DataFrame:
    """Raises when a check of severity error failed and names every one of them; drift checks only report."""
    failed = result.filter("status = 'fail'").select("table_name", "check_name", "failures").collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.check_name}: {r.failures}" for r in failed))
    return result

