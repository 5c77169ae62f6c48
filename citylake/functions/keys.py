"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from citylake.functions.columns import ColumnOrName, as_col

# Existing warehouses hold keys built with this stand-in and this delimiter.
NULL_STAND_IN = "_dbt_utils_surrogate_key_null_"
DELIMITER = "-"


def surrogate_key(*values: ColumnOrName) -> Column:
    """MD5 over the delimited text of the values; nulls count as a value of their own."""
    parts = [F.coalesce(as_col(v).cast("string"), F.lit(NULL_STAND_IN)) for v in values]
    return F.md5(F.concat_ws(DELIMITER, *parts))


def version_key(entity: ColumnOrName, valid_from: ColumnOrName) -> Column:
    """Key of one version of an entity."""
    stamp = F.date_format(as_col(valid_from), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", as_col(entity).cast("string"), stamp))
