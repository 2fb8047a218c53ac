"""What the query modules share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.sources.rows import text_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table as text, the form in which a mapping gets its rows."""
    return text_rows(table(spark, folder, name).select(*columns))


class Registered:
    """Queries by name, with the SQL of those that have one."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(query):
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return keep


# SQL texts for the check, in the dialect of the database that runs it.


def sql_base64(text: str) -> str:
    return f"to_base64(encode({text}::varchar))"


def sql_key_id(entity_set: str, entity_id: str) -> str:
    """UUID text of a key; ``entity_set`` is a name, ``entity_id`` an expression."""
    digest = f"md5('{entity_set}' || chr(31) || {entity_id})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in cuts)


def sql_iso(ts: str, offset: str = "'Z'") -> str:
    """ISO text of a clock reading: no zero seconds, and a fraction of 3 or 6 digits."""
    return (
        f"CASE WHEN microsecond({ts}) % 1000 <> 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') "
        f"WHEN microsecond({ts}) % 1000000 <> 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g') "
        f"WHEN microsecond({ts}) <> 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M') END || {offset}"
    )
