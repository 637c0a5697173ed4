"""Registry of queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their SQL."""
    from basinflow.plans import (  # noqa: F401
        queries_grid, queries_io, queries_jobs, queries_network, queries_time, queries_weights,
    )

    return QUERIES, ORACLE
