"""JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from citylake.functions.columns import ColumnOrName, as_col


def json_text(value: ColumnOrName, path: str) -> Column:
    return F.get_json_object(as_col(value), path)


def json_double(value: ColumnOrName, path: str) -> Column:
    return json_text(value, path).cast("double")


def json_int(value: ColumnOrName, path: str) -> Column:
    return json_text(value, path).cast("int")


def nested_to_json(schema: StructType, prefix: str = "") -> list[Column]:
    """One column per field: scalars pass through, nested values become JSON text."""
    columns = []
    for field in schema.fields:
        value = F.col(f"{prefix}`{field.name}`")
        if isinstance(field.dataType, StructType | ArrayType | MapType):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        columns.append(value.alias(field.name))
    return columns


def _held(text: Column, kind: str) -> Column:
    """The value as field `v`; an array cannot hold the mark of an unreadable text, an object around it can."""
    options = {"columnNameOfCorruptRecord": "unreadable"}
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {kind}, unreadable string", options)


def is_readable(value: ColumnOrName, kind: str) -> Column:
    """Whether JSON text is whole and of type `kind`; null and blank texts are not unreadable."""
    text = as_col(value)
    held = _held(text, kind)
    return F.coalesce((F.trim(text) == "") | (held.isNotNull() & held["unreadable"].isNull()), F.lit(True))


def strict_json(value: ColumnOrName, kind: str, where: ColumnOrName | None = None) -> Column:
    """JSON text as a value of type `kind`; text that is cut off, no JSON or of another type is an error.

    Null and blank texts give null. `where` is named in the error, such as the path of the file.
    """
    text = as_col(value)
    place = F.lit("") if where is None else F.concat(F.lit(" in "), F.coalesce(as_col(where), F.lit("?")))
    message = F.concat(F.lit("unreadable JSON"), place, F.lit(": "), F.left(text, F.lit(200)))
    return F.when(~is_readable(text, kind), F.raise_error(message)).when(F.trim(text) != "", _held(text, kind)["v"])
