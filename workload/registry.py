"""Registration of queries together with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.sql_views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, like: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``sql`` may use the views of ``sql_views``.  ``like`` names a query
    that has the same rows, whose SQL holds for this one too."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        elif like is not None:
            ORACLES[name] = ORACLES[like]
        return fn

    return register
