"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL if there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register
