"""Names, queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL for the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = dedent(sql).strip()
        return function

    return register


# Rows per task of the queries with one large key, whatever the size of the
# tables: few enough for that key to be cut on the smallest of them.
SMALL_CUT = 1000
