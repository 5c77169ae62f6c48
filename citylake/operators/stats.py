"""Statistics the analytics layer needs: correlation, quantiles, growth, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import as_list
from citylake.operators.ordered import SLICE, cut_long_groups, running_sum


def correlations(
    df: DataFrame, keys: Sequence[str], target: str, drivers: Mapping[str, str], min_rows: int = 14
) -> DataFrame:
    """Pearson r of `target` with each driver per group, long format (keys, driver, r, n_rows).

    One aggregate computes the moments of every driver; a pair needs `min_rows` complete rows and two
    distinct values on both sides. `drivers` maps column to label.
    """
    keys = list(keys)

    def moments(driver: str) -> Column:
        both = F.col(target).isNotNull() & F.col(driver).isNotNull()
        x, y = F.when(both, F.col(target)), F.when(both, F.col(driver))
        return F.struct(
            F.count(x).alias("n"),
            (F.min(x) < F.max(x)).alias("x_varies"),
            (F.min(y) < F.max(y)).alias("y_varies"),
            F.covar_pop(x, y).alias("covariance"),
            (F.stddev_pop(x) * F.stddev_pop(y)).alias("spread"),
        )

    wide = df.groupBy(*keys).agg(*[moments(d).alias(d) for d in drivers])
    rows = F.array(*[F.struct(F.lit(label).alias("driver"), F.col(d).alias("m")) for d, label in drivers.items()])
    long = wide.select(*keys, F.explode(rows).alias("pair")).select(*keys, "pair.driver", "pair.m.*")
    return long.filter(f"n >= {int(min_rows)} and x_varies and y_varies").select(
        *keys,
        "driver",
        F.round(F.try_divide("covariance", "spread"), 2).alias("r"),
        F.col("n").alias("n_rows"),
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: str | Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Exact linear-interpolation quantiles: (keys, probability, quantile).

    Collecting all values of a group, as the built-in exact percentile does, puts a hot group into one
    aggregation buffer. Here a sketch brackets each quantile first; values outside the bracket are only counted,
    and just the distinct values inside it are ranked, in even slices. The nearest value on either side belongs to
    the bracket too. A rank that lies outside all the same, beyond two sketch errors, is an error.
    """
    keys = as_list(keys)
    source = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"))
    margin = 2.0 / accuracy

    def bracket(p: float) -> Column:
        return F.struct(
            F.lit(float(p)).alias("probability"),
            F.approx_percentile("v", max(0.0, p - margin), accuracy).alias("lo"),
            F.approx_percentile("v", min(1.0, p + margin), accuracy).alias("hi"),
        )

    brackets = source.groupBy(*keys).agg(
        F.struct(F.count("v").alias("n"), F.array(*[bracket(p) for p in probabilities]).alias("b")).alias("_bracket")
    )
    # Copies of a value travel as one row from here on.
    values = source.groupBy(*keys, "v").agg(F.count("*").alias("c"))
    placed = values.join(brackets, keys) if keys else values.withColumn("_bracket", brackets.scalar())
    placed = placed.select(*keys, "v", "c", "_bracket.n", F.explode("_bracket.b").alias("b"))
    placed = placed.select(*keys, "v", "c", "n", "b.*")
    group = [*keys, "probability"]
    under, over = F.col("v") < F.col("lo"), F.col("v") > F.col("hi")
    sides = placed.groupBy(*group).agg(
        F.max("n").alias("n"),
        F.coalesce(F.sum(F.when(under, F.col("c"))), F.lit(0)).alias("below"),
        F.max(F.when(under, F.col("v"))).alias("left"),
        F.min(F.when(over, F.col("v"))).alias("right"),
        F.coalesce(F.sum(F.when(~under & ~over, F.col("c"))), F.lit(0)).alias("inside"),
    )
    inside = placed.filter(~under & ~over).select(*group, "v", "c")
    ranked = running_sum(cut_long_groups(inside, group, "v"), group, "v", "c", "upto", SLICE).drop(SLICE)
    ranked = ranked.join(sides, group).withColumns(
        {"last_rank": F.col("upto") + F.col("below"), "position": F.col("probability") * (F.col("n") - 1)}
    )

    def at(index: Column) -> Column:
        """The value at a rank counted from 0."""
        first, end = F.max("below"), F.max(F.col("below") + F.col("inside"))
        within = F.min(F.when(F.col("last_rank") > index, F.col("v")))
        rank = F.max(index)
        # One value to either side is known; a rank further out was missed by the sketch.
        outside = F.when(rank == first - 1, F.max("left")).when(rank == end, F.min("right"))
        return F.when((rank >= first) & (rank < end), within).otherwise(
            F.coalesce(outside, F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy")).cast("double"))
        )

    lower, upper = at(F.floor("position")), at(F.ceil("position"))
    part = F.max(F.col("position") - F.floor("position"))
    return ranked.groupBy(*group).agg((lower + (upper - lower) * part).alias("quantile"))


def growth(
    df: DataFrame, group_cols: Sequence[str], order: str, value: str, window: int = 28, counter: str | None = None
) -> DataFrame:
    """Mean of the last `window` rows against the first `window` rows per group, in percent.

    Groups with fewer than two full windows, or nothing in the first one, are left out. Both ends come from
    ranked rows that are pruned per task before the exchange.
    """
    group_cols = list(group_cols)

    def end_mean(ordering: Column, name: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group_cols).orderBy(ordering))
        ends = df.select(*group_cols, order, value).withColumn("_rank", rank).filter(F.col("_rank") <= window)
        return ends.groupBy(*group_cols).agg(F.avg(value).alias(name))

    sizes = df.groupBy(*group_cols).agg(
        F.count("*").alias("_n"), *([F.max(counter).alias(counter)] if counter else [])
    )
    joined = (
        sizes.filter(F.col("_n") >= 2 * window)
        .join(end_mean(F.col(order).asc(), "_first"), group_cols)
        .join(end_mean(F.col(order).desc(), "_last"), group_cols)
        .filter("_first > 0")
    )
    return joined.select(
        *group_cols,
        *([counter] if counter else []),
        F.round("_first", 1).alias("first_window_mean"),
        F.round("_last", 1).alias("last_window_mean"),
        F.round((F.col("_last") / F.col("_first") - 1) * 100, 1).alias("growth_pct"),
    ).orderBy(F.desc("growth_pct"))


def pivot_wide(df: DataFrame, index: str, column: str, values: Sequence, value: str) -> DataFrame:
    """Long to wide; the wanted column values are given, so no extra pass looks for them."""
    return df.groupBy(index).pivot(column, list(values)).agg(F.first(value))


def null_share(df: DataFrame) -> DataFrame:
    """One pass: (column, null_pct) for every column, rounded to two digits."""
    shares = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.round(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100, 2).alias("null_pct"),
            )
            for c in df.columns
        ]
    )
    return df.agg(shares.alias("s")).select(F.explode("s").alias("s")).select("s.*")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical one."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
