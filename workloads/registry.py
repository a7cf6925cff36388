"""Registration of queries next to the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: list[str] | None = None, sql: str | None = None, recursive: bool = False):
    """Register a query; ``sql`` is its DuckDB counterpart over ``views``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views or [], sql.strip(), recursive)
        return fn

    return register
