"""All queries of the engine and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import pages, relational, scalar

_PARTS = [scalar, relational, pages]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for part in _PARTS for name, f in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.oracle_sql().items()}
