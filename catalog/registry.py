"""Registration of queries, table access and plain output types."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from citylake.session import bound_scans, configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Named SQL fragments, in dependency order.
FRAGMENTS: dict[str, str] = {}


_SCHEMAS: dict = {}


class Tables:
    """The Parquet tables of one directory, read on first use. `events.ts` is an instant in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        # A known schema saves the job that would read the file footers again.
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


NUDGE = 1e-9


def six_digits(value):
    """Rounds the double itself, half away from zero; `round` would round its decimal text instead.

    The nudge, used on both sides, decides ties that the last bit of an average would decide otherwise.
    """
    moved = value + NUDGE
    return F.signum(moved) * F.floor(F.abs(moved) * 1e6 + 0.5) / 1e6


def nudged(sql: str) -> str:
    """The same for every `round(x, 6)` of a statement."""
    parts, rest = [], sql
    while (at := rest.find("round(")) >= 0:
        parts.append(rest[: at + 6])
        rest = rest[at + 6 :]
        depth, end = 0, 0
        for end, char in enumerate(rest):
            depth += (char == "(") - (char == ")")
            if depth < 0:
                break
        inner = rest[:end]
        if inner.endswith(", 6"):
            inner = f"({inner[:-3]}) + {NUDGE}, 6"
        parts.append(nudged(inner))
        rest = rest[end:]
    return "".join(parts) + rest


def simple(df: DataFrame) -> DataFrame:
    """Text for dates and times, bigint for integers, doubles rounded to six digits."""
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, TimestampType | TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, DateType):
            value = value.cast("string")
        elif isinstance(kind, IntegerType | ShortType):
            value = value.cast("bigint")
        elif isinstance(kind, DoubleType | FloatType | DecimalType):
            value = six_digits(value.cast("double"))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Registers fn(tables) -> DataFrame, with SQL giving the same rows where SQL can."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return simple(fn(Tables(bound_scans(configure(spark)), folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = nudged(with_fragments(sql))
        return fn

    return register


def with_fragments(sql: str) -> str:
    """Prepends the fragments a statement uses, directly or through other fragments."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in FRAGMENTS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(FRAGMENTS[name])
                needed.append(name)

    visit(sql)
    body = sql.strip()
    if not needed:
        return body
    parts = ", ".join(f"{name} as ({FRAGMENTS[name].strip()})" for name in needed)
    return f"with {parts}, {body[5:]}" if body.lower().startswith("with ") else f"with {parts} {body}"


FORMS = {
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}",
    "d": "strftime({c}, '%Y-%m-%d') as {c}",
    "f": "round({c}::double, 6) as {c}",
    "i": "{c}::bigint as {c}",
    "s": "{c}",
}


def pick(spec: str) -> str:
    """Select list from 'kind column' pairs: t timestamp, d date, f double, i integer, s as it is."""
    return ", ".join(FORMS[kind].format(c=column) for kind, column in (p.split() for p in spec.split(",")))


def local(ts: str) -> str:
    """SQL: wall clock of a naive UTC timestamp."""
    return f"timezone('Europe/Prague', timezone('UTC', {ts}))"
