"""Queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> tuple[dict[str, Query], dict[str, str]]:
    from graphloom.queries import checks, entities, scalars, store, times, tables

    found: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in (tables, checks, scalars, times, entities, store):
        found.update(module.QUERIES.queries)
        sql.update(module.QUERIES.sql)
    return found, sql
