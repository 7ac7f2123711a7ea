"""Registry of runnable queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feira.queries.views import with_views
from feira.sources.domain import Marketplace

Query = Callable[[Marketplace], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_RAW: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the ``d_`` views."""
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql:
            _SQL[name], _RAW[name] = with_views(sql), sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Marketplace(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def raw_sql(name: str) -> str:
    """The SQL of a query as it was registered, without the views it uses."""
    return _RAW[name]
