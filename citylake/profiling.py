"""Table profiles as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, TimestampType

from citylake.operators.ordered import SLICE, cut_long_groups, running_sum
from citylake.operators.stats import duplicate_rows, null_share
from citylake.session import cut_lineage

TOP_MISSING = 5


def naive_utc(df: DataFrame) -> DataFrame:
    """Instants to wall clocks in UTC."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns(
        {c: F.convert_timezone(None, F.lit("UTC"), F.col(c).cast("timestamp_ntz")) for c in zoned}
    ) if zoned else df


def overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, duplicate rows."""
    counts = df.agg(F.count("*").alias("total_rows"))
    return counts.select(
        "total_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        duplicate_rows(df).scalar().alias("duplicate_rows"),
    )


def missing(df: DataFrame) -> DataFrame:
    """Columns that have nulls, highest share first."""
    return null_share(df).filter("null_pct > 0").orderBy(F.desc("null_pct"), "column")


def top_missing(df: DataFrame, n: int = TOP_MISSING) -> DataFrame:
    return missing(df).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def column_statistics(df: DataFrame) -> DataFrame:
    """One pass: count, nulls, approximate distinct count, minimum, maximum, mean and deviation of every column."""
    numeric = set(numeric_columns(df))

    def row(name: str) -> Column:
        value = F.col(f"`{name}`")
        number = value.cast("double") if name in numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("n"),
            F.count_if(value.isNull()).alias("n_null"),
            F.approx_count_distinct(value).alias("n_distinct_approx"),
            F.min(value).cast("string").alias("min"),
            F.max(value).cast("string").alias("max"),
            F.avg(number).alias("mean"),
            F.stddev_samp(number).alias("stddev"),
        )

    rows = F.array(*[row(c) for c in df.columns])
    return df.agg(rows.alias("s")).select(F.explode("s").alias("s")).select("s.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson and Spearman r of every pair of numeric columns: (column_a, column_b, pearson, spearman).

    Pairs use the rows in which both values are present; a pair without spread has null. One aggregate holds the
    co-moments of all pairs and reads each row once, whatever the number of pairs. The ranks of a column depend on its
    partner only where the partner has nulls, so there is one rank column per value column and one more for each
    partner with nulls. Without numeric columns the result is empty.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, pearson double, spearman double")
    values = [f"x{i}" for i in range(len(columns))]
    numbers = df.select(*(F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(columns, values, strict=True)))
    # Row numbers must not change when a task is run again.
    rows = cut_lineage(numbers.withColumn("row", F.monotonically_increasing_id()))
    gaps = rows.agg(*(F.count_if(F.col(x).isNull()).alias(x) for x in values)).first()
    partial = [x for x in values if gaps[x]]
    ranked = average_ranks(rows, values, partial)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))

    def shared(value: str, partner: str) -> Column:
        """The value where the partner is present too."""
        return F.when(F.col(partner).isNotNull(), F.col(value)) if partner in partial and partner != value else F.col(value)

    def rank(value: str, partner: str) -> Column:
        ranks = F.get(f"r_{value}", F.lit(partial.index(partner) + 1 if partner in partial and partner != value else 0))
        return F.when(F.col(partner).isNotNull(), ranks) if partner in partial else ranks

    def r(x: Column, y: Column) -> Column:
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    results = [
        F.struct(
            F.lit(columns[a]).alias("column_a"),
            F.lit(columns[b]).alias("column_b"),
            r(shared(values[a], values[b]), shared(values[b], values[a])).alias("pearson"),
            r(rank(values[a], values[b]), rank(values[b], values[a])).alias("spearman"),
        )
        for a, b in pairs
    ]
    return ranked.agg(F.array(*results).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def average_ranks(rows: DataFrame, values: Sequence[str], partial: Sequence[str]) -> DataFrame:
    """The rows (row, values) with an array `r_<value>` per value column: its average rank among all rows in which it is
    present, then among those in which each of the `partial` columns is present too.

    A rank comes from the counts of the distinct values, added up over even slices of the sorted values, so no task sees
    a whole column in order. Cells are unpivoted once: the work is linear in rows and columns.
    """
    among = [F.lit(True), *(F.col(p).isNotNull() for p in partial)]
    cells = rows.select("row", F.array(*among).alias("among"), *values).unpivot(["row", "among"], list(values), "column", "value")
    cells = cells.filter("value is not null")
    counts = cells.groupBy("column", "value").agg(
        F.array(*(F.count_if(F.get("among", F.lit(i))) for i in range(len(among)))).alias("n"))
    each = counts.select("column", "value", F.posexplode("n").alias("group", "n")).filter("n > 0")
    summed = running_sum(cut_long_groups(each, ["column", "group"], "value"), ["column", "group"], "value", F.col("n"), "upto", SLICE)
    rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / 2
    of_values = summed.groupBy("column", "value").agg(
        F.array(*(F.max(F.when(F.col("group") == i, rank)) for i in range(len(among)))).alias("ranks"))
    met = cells.drop("among").join(of_values, ["column", "value"])
    wide = met.groupBy("row").agg(*(f for x in values for f in (
        F.max(F.when(F.col("column") == x, F.col("value"))).alias(x),
        F.max(F.when(F.col("column") == x, F.col("ranks"))).alias(f"r_{x}"),
    )))
    return wide


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """All parts of a table profile, from all rows whatever their number."""
    rows = naive_utc(df)
    return {
        "overview": overview(rows),
        "missing": missing(rows),
        "columns": column_statistics(rows),
        "correlations": correlation_matrix(rows),
    }


def catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts of all tables of a layer."""
    parts = [
        df.agg(F.count("*").alias("total_rows")).select(
            F.lit(name).alias("table_name"), "total_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in sorted(tables.items())
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


# ---------------------------------------------------------------- profiles that merge

SKETCH_BITS = 12  # of a distinct-count sketch: about 1.6 % error
SKETCH_WIDTH = 200  # of a rank sketch: about 1.65 % of the rows
QUANTILES = (0.05, 0.5, 0.95)


def daily_profile(df: DataFrame, day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per day and column that merges with those of other days: counts, moments, bounds and two sketches.

    All columns share one scan and one aggregate per day. `low` and `high` are bounds of numbers, `first` and `last`
    those of everything else, as text. Sketches of numbers keep ranks, sketches of all columns their distinct values.
    Rows without a day form a day of their own; days that changed can be profiled again and replaced by themselves.
    """
    numeric = set(numeric_columns(df))
    nothing = F.lit(None)

    def row(name: str) -> Column:
        value, is_number = F.col(f"`{name}`"), name in numeric
        number = value.cast("double")
        n = F.count(value)
        return F.struct(
            F.lit(name).alias("column"),
            n.alias("n"),
            F.count_if(value.isNull()).alias("n_null"),
            (F.sum(number) if is_number else nothing.cast("double")).alias("total"),
            (F.var_pop(number) * n if is_number else nothing.cast("double")).alias("m2"),
            (F.min(number) if is_number else nothing.cast("double")).alias("low"),
            (F.max(number) if is_number else nothing.cast("double")).alias("high"),
            (nothing.cast("string") if is_number else F.min(value.cast("string"))).alias("first"),
            (nothing.cast("string") if is_number else F.max(value.cast("string"))).alias("last"),
            F.hll_sketch_agg(value.cast("string"), SKETCH_BITS).alias("distinct"),
            (F.kll_sketch_agg_double(number, SKETCH_WIDTH) if is_number else nothing.cast("binary")).alias("ranks"),
        )

    rows = F.array(*(row(c) for c in columns or [c for c in df.columns if c != day]))
    return df.groupBy(F.col(day).alias("day")).agg(rows.alias("p")).select("day", F.explode("p").alias("p")).select("day", "p.*")


def merged_profile(daily: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profile of all days given: counts, mean, deviation and bounds as over the rows themselves, distinct values
    and quantiles from the merged sketches. The rows of the table are not read."""
    of_numbers = F.sum(F.when(F.col("total").isNotNull(), F.col("n")))
    mean = F.try_divide(F.sum("total"), of_numbers)
    between = F.sum(F.try_divide(F.col("total") * F.col("total"), F.col("n"))) - F.sum("total") * mean
    merged = daily.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct_approx"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        mean.alias("mean"),
        F.sqrt(F.try_divide(F.sum("m2") + F.greatest(between, F.lit(0.0)), of_numbers - 1)).alias("stddev"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )
    some = F.array(*(F.lit(float(q)) for q in quantiles))
    at = F.when((F.col("n") > 0) & F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("ranks", some))
    return merged.withColumn("quantiles_approx", at).drop("ranks")
