"""Row-order operators that stay exact when one key holds a large share of the rows.

A plain window puts every row of a key into one task. Each operator here takes `slices`, a column that cuts
the rows of a key into consecutive runs. Windows then run per (key, slice), each slice is summarised in one
row, the summaries are scanned per key, and the carried values are joined back. `cut_long_groups` makes
slices of even size whatever the distribution; without `slices` a plain window is used, which is right when
the rows per key are bounded by a grid (one row per key and day, for instance).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citylake.functions.columns import ColumnOrName, as_col, as_list
from citylake.session import fresh_dir

SLICE = "_slice"
EARLIER = (Window.unboundedPreceding, -1)


def cut_long_groups(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], slices: int | None = None
) -> DataFrame:
    """Adds `_slice`: runs of near-equal size in (key, order) sequence.

    The range partitioning samples keys and order together, so a hot key is spread over many slices. The rows are
    written to the shared folder with their slice number: it cannot change when a task is run again, and the
    passes that follow read only the columns they need.
    """
    spark = df.sparkSession
    count = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *as_list(keys), *as_list(order))
    path = fresh_dir(spark, "slices")
    ranged.withColumn(SLICE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _windows(keys: list[str], order: list[str], slices: str | None):
    parts = keys + ([slices] if slices else [])
    return Window.partitionBy(*parts).orderBy(*order)


def _joined(local: DataFrame, summary: DataFrame, keys: list[str], slices: str, carry, step: int = -1) -> DataFrame:
    """Attaches what the slices on one side carry over, null-safe on the keys (they may be null, as in a window).

    `carry` maps names to expressions over the window of a key's slices. Only a key that goes on beyond the slice
    needs a row, and of a slice cut by `cut_long_groups` that is one key at each end: the carried rows are then no
    more than the slices, which is what makes it safe to broadcast them.
    """
    in_order = Window.partitionBy(*keys).orderBy(slices)
    beyond = F.lag(slices).over(in_order) if step < 0 else F.lead(slices).over(in_order)
    on = [*keys, slices]
    rows = summary.select(*on, *[e.alias(n) for n, e in carry(in_order).items()], beyond.alias("_beyond"))
    rows = rows.filter("_beyond is not null").drop("_beyond")
    right = rows.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in rows.columns if c not in on])
    if slices == SLICE:
        right = F.broadcast(right)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return local.join(right, condition, "left").drop(*[f"_r_{c}" for c in on])


def forward_fill(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    columns: Sequence[str],
    slices: str | None = None,
) -> DataFrame:
    """Replaces nulls by the last known value of the key."""
    keys, order = as_list(keys), as_list(order)
    upto = _windows(keys, order, slices).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.last(c, ignorenulls=True).over(upto) for c in columns}
    if slices is None:
        return df.withColumns(filled)
    position = F.struct(*order)
    ends = df.groupBy(*keys, slices).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_end_{c}") for c in columns]
    )

    def carry(in_order):
        before = in_order.rowsBetween(*EARLIER)
        return {f"_carry_{c}": F.last(f"_end_{c}", ignorenulls=True).over(before) for c in columns}

    joined = _joined(df.withColumns(filled), ends, keys, slices, carry)
    return joined.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in columns}).drop(
        *[f"_carry_{c}" for c in columns]
    )


def _neighbour(df, keys, order, columns: Mapping[str, ColumnOrName], slices, step: int) -> DataFrame:
    keys, order = as_list(keys), as_list(order)
    values = {name: as_col(value) for name, value in columns.items()}
    shift = F.lag if step < 0 else F.lead
    window = _windows(keys, order, slices)
    if slices is None:
        return df.withColumns({name: shift(value).over(window) for name, value in values.items()})
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    position = F.struct(*order)
    edge = F.max_by(packed, position) if step < 0 else F.min_by(packed, position)
    edges = df.groupBy(*keys, slices).agg(edge.alias("_edge"))
    local = df.withColumn("_inside", shift(packed).over(window))
    joined = _joined(local, edges, keys, slices, lambda in_order: {"_outside": shift("_edge").over(in_order)}, step)
    found = F.coalesce("_inside", "_outside")
    return joined.withColumns({n: found[n] for n in values}).drop("_inside", "_outside")


def previous(df, keys, order, columns: Mapping[str, ColumnOrName], slices: str | None = None) -> DataFrame:
    """Adds, under each new name, the value of the previous row of the key."""
    return _neighbour(df, keys, order, columns, slices, -1)


def following(df, keys, order, columns: Mapping[str, ColumnOrName], slices: str | None = None) -> DataFrame:
    """Adds, under each new name, the value of the next row of the key."""
    return _neighbour(df, keys, order, columns, slices, 1)


def running_sum(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: ColumnOrName,
    name: str,
    slices: str | None = None,
) -> DataFrame:
    """Adds the sum of `value` from the first row of the key up to this one."""
    keys, order = as_list(keys), as_list(order)
    upto = _windows(keys, order, slices).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn(name, F.sum(as_col(value)).over(upto))
    if slices is None:
        return local
    totals = df.groupBy(*keys, slices).agg(F.sum(as_col(value)).alias("_total"))

    def carry(in_order):
        return {"_base": F.sum("_total").over(in_order.rowsBetween(*EARLIER))}

    joined = _joined(local, totals, keys, slices, carry)
    return joined.withColumn(name, F.coalesce(F.col(name) + F.col("_base"), name, "_base")).drop("_base")


def running_max(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str,
    slices: str | None = None,
) -> DataFrame:
    """Adds the maximum of `value` over the rows of the key before this one."""
    keys, order = as_list(keys), as_list(order)
    local = df.withColumn(name, F.max(value).over(_windows(keys, order, slices).rowsBetween(*EARLIER)))
    if slices is None:
        return local
    tops = df.groupBy(*keys, slices).agg(F.max(value).alias("_top"))

    def carry(in_order):
        return {"_carry": F.max("_top").over(in_order.rowsBetween(*EARLIER))}

    joined = _joined(local, tops, keys, slices, carry)
    return joined.withColumn(name, F.greatest(name, "_carry")).drop("_carry")


def rolling_mean(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    rows: int = 7,
    name: str | None = None,
    slices: str | None = None,
) -> DataFrame:
    """Trailing mean over the last `rows` rows of the key; null until that many rows exist.

    The window counts rows, not days: a missing day stretches it. With `slices`, rows are numbered exactly
    and every block of numbers also receives the `rows - 1` rows before it.
    """
    keys, order = as_list(keys), as_list(order)
    name = name or f"{value}_rolling"

    def mean_over(window) -> Column:
        return F.when(F.count(value).over(window) == rows, F.avg(value).over(window))

    if slices is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1), Window.currentRow)
        return df.withColumn(name, mean_over(window))
    numbered = running_sum(df, keys, order, F.lit(1), "_number", slices).withColumn("_number", F.col("_number") - 1)
    block = max(rows, 4096)
    own = F.floor(F.col("_number") / block)
    is_tail = F.pmod(F.col("_number"), F.lit(block)) >= block - (rows - 1)
    copies = F.when(is_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(copies))
    window = Window.partitionBy(*keys, "_block").orderBy("_number").rowsBetween(-(rows - 1), Window.currentRow)
    rolled = spread.withColumn(name, mean_over(window)).filter("_block = _own")
    return rolled.drop("_number", "_own", "_block")


def time_gaps(
    df: DataFrame, ts: str, keys: Sequence[str] = (), unit: str = "hour", slices: int | None = None, bounded: bool = False
) -> DataFrame:
    """Rows (keys, ts, next_ts) where the next distinct instant is more than one `unit` away.

    Series are cut into slices, since one key may hold most instants; `bounded` says that each fits a task.
    """
    keys = list(keys)
    points = df.filter(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("ts")).distinct()
    if bounded and keys:
        linked = following(points, keys, "ts", {"next_ts": "ts"})
    else:
        if not keys:
            points = points.withColumn("_all", F.lit(0))
        scan_keys = keys or ["_all"]
        linked = following(cut_long_groups(points, scan_keys, "ts", slices), scan_keys, "ts", {"next_ts": "ts"}, SLICE)
    limit = F.col("ts") + F.expr(f"interval 1 {unit}")
    return linked.filter(F.col("next_ts") > limit).select(*keys, "ts", "next_ts")
