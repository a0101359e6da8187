"""Queries by the operator's key, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from votealloc.sources.scratch import folder

__all__ = ["ORACLES", "QUERIES", "Query", "folder", "register"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add
