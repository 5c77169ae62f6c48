"""Order-independent averages and sums of doubles.

Double addition depends on the order of the rows, so two runs over differently split partitions can
differ in the last bit. Here every value is rounded once to a fixed number of digits, half away from zero,
and added as whole numbers, which is exact. A value travels as its integer part and the remaining units of
10^-scale: both sums are plain integers, so the aggregation keeps to fixed-width buffers, and neither
overflows before the total of the values passes 9e18. Only the finished group meets decimals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from citylake.functions.columns import ColumnOrName, as_col

SCALE = 6


@dataclass(frozen=True)
class Exact:
    """Row-level parts of a value. Sums of them can be summed again, on any number of levels."""

    whole: Column
    units: Column
    scale: int = SCALE


def exact_parts(value: ColumnOrName, where: Column | None = None, scale: int = SCALE) -> Exact:
    value = as_col(value).cast("double")
    if where is not None:
        value = F.when(where, value)
    scaled = value * F.lit(float(10**scale))
    # Adding one half before the floor would misround large values; the fraction itself is exact.
    below = F.floor(scaled)
    fraction = scaled - below
    rounded = below + F.when((fraction > 0.5) | ((fraction == 0.5) & (scaled >= 0)), 1).otherwise(0)
    fits = F.when(
        scaled.isNull() | (F.abs(scaled) < 1e18), rounded
    ).otherwise(F.raise_error(F.lit(f"value does not fit decimal(18,{scale})")))
    whole = F.floor(value)
    return Exact(whole, fits - whole * F.lit(10**scale), scale)


def exact_total(whole: Column, units: Column, scale: int = SCALE) -> Column:
    """Sums of the parts as one double."""
    return _in_units(whole, units, scale) / F.lit(float(10**scale))


def exact_ratio(whole: Column, units: Column, count: Column, scale: int = SCALE) -> Column:
    """Average from sums of the parts and a count."""
    # An all-null group has no average; nullif keeps ANSI division from raising.
    return _in_units(whole, units, scale) / F.nullif(count * F.lit(float(10**scale)), F.lit(0.0))


def _in_units(whole: Column, units: Column, scale: int) -> Column:
    return (whole.cast("decimal(20,0)") * F.lit(10**scale) + units.cast("decimal(20,0)")).cast("double")


def exact_sum(value: ColumnOrName, where: Column | None = None, scale: int = SCALE) -> Column:
    parts = exact_parts(value, where, scale)
    return exact_total(F.sum(parts.whole), F.sum(parts.units), scale)


def exact_avg(value: ColumnOrName, where: Column | None = None, scale: int = SCALE) -> Column:
    parts = exact_parts(value, where, scale)
    return exact_ratio(F.sum(parts.whole), F.sum(parts.units), F.count(parts.whole), scale)
