"""A place for queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nucleispark.plans.fixtures import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *tables: str, name: str | None = None):
    """Registers a function by its name, with DuckDB SQL over derived tables if SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = with_tables(sql, *tables) if tables else sql
        return f

    return add
