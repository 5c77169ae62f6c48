"""Queries over the test tables, one per operator, each with SQL that gives the same rows."""

from catalog import aggregates, analytics, model, relational, sources, windows  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
