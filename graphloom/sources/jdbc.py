"""Rows of a SQL query that runs in the source database."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Iterable, Mapping
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession

from graphloom.sources.rows import text_rows

DEFAULT_FETCH_SIZE = 50_000


def jdbc_options(
    connection: Mapping[str, str],
    sql: str,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    split_on: str | None = None,
    lower: object = None,
    upper: object = None,
    splits: int | None = None,
) -> dict[str, str]:
    """Reader options. ``connection`` holds url, user, password and driver.

    With ``split_on`` the query runs as ``splits`` queries over ranges of that column.
    The bounds only set where the ranges are cut; rows outside of them are read too.
    """
    options = {**connection, "fetchsize": str(fetch_size)}
    if split_on is None:
        return {**options, "query": sql}
    if lower is None or upper is None or not splits:
        raise ValueError("a split read needs lower, upper and splits")
    return {
        **options,
        "dbtable": f"({sql}) source_rows",
        "partitionColumn": split_on,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(splits),
    }


def quantile_query(sql: str, split_on: str, splits: int) -> str:
    """SQL for the upper ends of ranges of a column that hold about as many rows each; the source computes them."""
    dealt = f"SELECT {split_on} AS bound, ntile({int(splits)}) OVER (ORDER BY {split_on}) AS part FROM ({sql}) source_rows WHERE {split_on} IS NOT NULL"
    return f"SELECT part, max(bound) AS bound FROM ({dealt}) parts GROUP BY part"


def range_predicates(split_on: str, bounds: Iterable[object]) -> list[str]:
    """Conditions that each row meets exactly one of: ranges up to each bound, what is above all, and nulls.

    Equal bounds, as of a value that many rows share, make one range.
    """
    ends = sorted({b for b in bounds if b is not None})
    cuts = [_literal(b) for b in ends[:-1]]
    if not cuts:
        return [f"{split_on} IS NOT NULL", f"{split_on} IS NULL"]
    between = [f"{split_on} > {low} AND {split_on} <= {high}" for low, high in pairwise(cuts)]
    return [f"{split_on} <= {cuts[0]}", *between, f"{split_on} > {cuts[-1]}", f"{split_on} IS NULL"]


def _literal(value: object) -> str:
    """A bound as SQL text."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, bool) or not isinstance(value, (int, decimal.Decimal)):
        raise ValueError(f"can't split a read by values such as {value!r}")
    return str(value)


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], sql: str, **options: object) -> DataFrame:
    """The rows of ``sql`` as text; see :func:`jdbc_options`.

    With ``split_on`` and ``splits`` but no bounds, the ranges are cut at quantiles that the source computes, so a skewed
    column gives tasks of like size. Rows with a null in that column are a range of their own.
    """
    if options.get("split_on") and options.get("splits") and options.get("lower") is None and options.get("upper") is None:
        split_on, splits = str(options["split_on"]), int(options["splits"])
        asked = jdbc_options(connection, quantile_query(sql, split_on, splits))
        # One row for each range.
        bounds = [r[1] for r in spark.read.format("jdbc").options(**asked).load().collect()]
        given = {k: v for k, v in connection.items() if k != "url"}
        given["fetchsize"] = str(options.get("fetch_size", DEFAULT_FETCH_SIZE))
        ranges = range_predicates(split_on, bounds)
        return text_rows(spark.read.jdbc(connection["url"], f"({sql}) source_rows", predicates=ranges, properties=given))
    reader = spark.read.format("jdbc").options(**jdbc_options(connection, sql, **options))
    return text_rows(reader.load())
