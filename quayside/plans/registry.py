"""The registered queries and, beside the later ones, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB SQL of the queries that are registered with it; ``plans.oracle`` has that of the others.
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    return query_named(function.__name__)(function)


def query_named(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register under a name, which an operator may have taken in the module, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register
