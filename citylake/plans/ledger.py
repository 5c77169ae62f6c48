"""A ledger of checks: what each check found per day, so that a run looks at the changed days only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.operators.incremental import Days
from citylake.plans.gold import FACT_KEYS, PARTITION
from citylake.quality import REPORT, WARN, Check, _Duplicates, _Gaps, _Orphans, report
from citylake.sources.landing import read_if_exists, write_partitions

# Tables kept by day, and the columns that determine the day of a row.
DAY_TABLES = {**FACT_KEYS, "mart_air_vs_energy_daily": ("district_key", PARTITION)}
LEDGER = "table_name string, check_name string, key string, n long, first timestamp, last timestamp, day int"
NOTHING = {"key": "string", "n": "long", "first": "timestamp", "last": "timestamp"}


def adds_up(check: Check) -> bool:
    """Whether the failures of a check follow from those of single days."""
    if check.table not in DAY_TABLES:
        return False
    if isinstance(check.failing, _Duplicates):
        # Rows that repeat a key stand on one day only if the key determines the day.
        columns = set(check.failing.columns)
        return PARTITION in columns or set(DAY_TABLES[check.table]) <= columns
    return check.predicate is not None or isinstance(check.failing, (_Orphans, _Gaps))


def _entries(rows: DataFrame, **columns: Column) -> DataFrame:
    values = {c: columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in NOTHING.items()}
    return rows.select(F.col("day"), columns["check_name"].alias("check_name"), *values.values())


def _counted(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failing rows per day of all row-level checks: one scan, one row per day."""
    counts = F.array(*(F.struct(F.lit(c.name).alias("name"), F.count_if(c.predicate()).alias("n")) for c in checks))
    rows = df.groupBy(F.col(PARTITION).alias("day")).agg(counts.alias("c")).select("day", F.explode("c").alias("c")).filter("c.n > 0")
    return _entries(rows, check_name=F.col("c.name"), n=F.col("c.n"))


def _keyed(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Keys of all unique checks and references: one scan and one exchange. Of the unique ones only their number of
    repeated keys stays, of references the rows per key, which add up over days before they meet the parents."""

    def pair(number: int, check: Check) -> Column:
        columns = check.failing.columns if isinstance(check.failing, _Duplicates) else [check.failing.column]
        key = F.to_json(F.array(*(F.col(c).cast("string") for c in columns)), {"ignoreNullFields": "false"})
        known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
        counts_nulls = isinstance(check.failing, _Duplicates) and not check.failing.ignore_nulls
        return F.struct(F.lit(number).alias("i"), (key if counts_nulls else F.when(known, key)).alias("v"))

    pairs = F.array(*(pair(i, c) for i, c in enumerate(checks)))
    keys = df.select(F.col(PARTITION).alias("day"), F.explode(pairs).alias("p")).select("day", "p.*").filter("v is not null")
    counted = keys.groupBy("day", "i", "v").agg(F.count(F.lit(1)).alias("n"))
    is_unique = F.col("i").isin([i for i, c in enumerate(checks) if isinstance(c.failing, _Duplicates)])
    kept = counted.filter(~is_unique | (F.col("n") > 1)).withColumn("k", F.when(~is_unique, F.get(F.from_json("v", "array<string>"), F.lit(0))))
    summed = kept.groupBy("day", "i", "k").agg(F.sum(F.when(is_unique, 1).otherwise(F.col("n"))).alias("n"))
    names = F.array(*(F.lit(c.name) for c in checks))
    return _entries(summed, check_name=F.get(names, F.col("i")), key=F.col("k"), n=F.col("n"))


def _gaps(df: DataFrame, check: Check) -> DataFrame:
    """Per day and key the gaps inside the day and its first and last instant; what lies between days shows when merged."""
    ts, keys = check.failing.column, list(check.failing.keys)
    key = F.to_json(F.array(*(F.col(c).cast("string") for c in keys)), {"ignoreNullFields": "false"}) if keys else F.lit("")
    points = df.filter(F.col(ts).isNotNull()).select(F.col(PARTITION).alias("day"), key.alias("k"), F.col(ts).alias("ts")).distinct()
    following = F.lead("ts").over(Window.partitionBy("day", "k").orderBy("ts"))
    late = points.withColumn("late", F.coalesce(following > F.col("ts") + F.expr(f"interval 1 {check.failing.unit}"), F.lit(False)))
    days = late.groupBy("day", "k").agg(F.count_if("late").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return _entries(days, check_name=F.lit(check.name), key=F.col("k"), n=F.col("n"), first=F.col("lo"), last=F.col("hi"))


def summarise(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """What the checks of one table find on each day of `df`. Every day also has a row without a check."""
    rows = [c for c in checks if c.predicate is not None]
    keyed = [c for c in checks if isinstance(c.failing, (_Duplicates, _Orphans))]
    parts = [_entries(df.select(F.col(PARTITION).alias("day")).distinct(), check_name=F.lit(""))]
    parts += [_counted(df, rows)] * bool(rows) + [_keyed(df, keyed)] * bool(keyed)
    parts += [_gaps(df, c) for c in checks if isinstance(c.failing, _Gaps)]
    return reduce(DataFrame.unionByName, parts)


def _failures(ledger: DataFrame, check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    found = ledger.filter((F.col("table_name") == check.table) & (F.col("check_name") == check.name))
    if isinstance(check.failing, _Orphans):
        parents = tables[check.failing.parent].select(F.col(check.failing.parent_column).cast("string").alias("key"))
        found = found.groupBy("key").agg(F.sum("n").alias("n")).join(parents, "key", "left_anti")
    elif isinstance(check.failing, _Gaps):
        # One row per key and day, so a window holds a key's calendar.
        following = F.lead("first").over(Window.partitionBy("key").orderBy("first"))
        between = F.coalesce(following > F.col("last") + F.expr(f"interval 1 {check.failing.unit}"), F.lit(False))
        found = found.withColumn("n", F.col("n") + between.cast("long"))
    named = [F.lit(check.table).alias("table_name"), F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity")]
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(*named, "failures")


def ledger_report(
    path: str, tables: Mapping[str, DataFrame], checks: Sequence[Check], changed: Mapping[str, Days | None] | None = None
) -> DataFrame:
    """The report of all checks, for which tables kept by day are read on their changed days only.

    `changed` gives the days of a table that were written since the last report; a table it does not name is taken as
    new and read whole, one with no changed day is not read at all. What the days say is kept in `path` and replaced day
    by day; a repeated run finds the same. Checks of other tables, and unique checks whose key does not determine the
    day, look at their whole tables as `report` does.
    """
    spark = next(iter(tables.values())).sparkSession
    daily = [c for c in checks if adds_up(c)]
    known = read_if_exists(spark, path, LEDGER)
    for table in dict.fromkeys(c.table for c in daily):
        days = (changed or {}).get(table) if known is not None else None
        if days is not None and days.empty:
            continue
        df = tables[table] if days is None else days.of_keys(tables[table], PARTITION)
        own = summarise(df.filter(F.col(PARTITION).isNotNull()), [c for c in daily if c.table == table])
        if days is not None:
            gone = days.rows.select(F.date_format("day", "yyyyMMdd").cast("int").alias("day"))
            own = own.unionByName(_entries(gone, check_name=F.lit("")))
        # Written by table and day; rows of a day that has gone are replaced by its empty row.
        write_partitions(own.select("check_name", *NOTHING, "day"), f"{path}/table_name={table}", "day")
    ledger = spark.read.schema(LEDGER).parquet(path)
    parts = [_failures(ledger, c, tables) for c in daily]
    combined = reduce(DataFrame.unionByName, parts) if parts else None
    rest = [c for c in checks if not adds_up(c)]
    if combined is not None:
        status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
        combined = combined.withColumn("status", status).select(*REPORT)
    if rest:
        combined = report(tables, rest) if combined is None else combined.unionByName(report(tables, rest))
    return combined
