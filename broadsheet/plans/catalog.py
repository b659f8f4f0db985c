"""Named queries over the driver tables, each beside the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function under its name, with its SQL if there is any."""

    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


from . import event_queries, scalar_queries, table_queries, whole_queries  # noqa: E402, F401
