"""Registry of named queries, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` runs on the same tables in DuckDB."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def pct_sql(num: str, den: str, digits: int = 2, scale: int = 100) -> str:
    """SQL twin of ``rounded_ratio``."""
    return f"CAST((2*({num})*{scale * 10**digits} + ({den})) // (2*({den})) AS DOUBLE) / {10**digits}"
