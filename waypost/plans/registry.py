"""Registry of runnable queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(name: str | Column, alias: str | None = None) -> Column:
    """A double rounded for comparison."""
    col = F.col(name) if isinstance(name, str) else name
    out = F.round(col.cast("double"), 6)
    return out.alias(alias or name) if alias or isinstance(name, str) else out


def R(expr: str) -> str:
    """The SQL twin of ``r6``; adding zero turns -0.0 into 0.0."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def n64(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def load_all() -> None:
    """Import every query module once."""
    from waypost.plans import (  # noqa: F401
        cleaning_queries,
        detector_queries,
        panel_queries,
        perimeter_queries,
        profile_queries,
        ranking_queries,
        relation_queries,
        route_queries,
        stream_queries,
    )
