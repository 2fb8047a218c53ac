"""Rows of text: what a mapping reads."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.steps import Condition, Row
from graphloom.functions.times import utc_text


def _escaped(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_rows(df: DataFrame) -> DataFrame:
    """All values as text: timestamps as ISO offset text in UTC, bytes stay bytes, null stays null."""

    def as_text(field: T.StructField) -> Column:
        c = F.col(_escaped(field.name))
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return c
        if isinstance(field.dataType, T.TimestampType):
            return utc_text(c).alias(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            return utc_text(as_utc(c)).alias(field.name)
        return c.cast("string").alias(field.name)

    return df.select(*[as_text(f) for f in df.schema.fields])


def as_utc(c: Column) -> Column:
    """The instant at which a UTC clock shows the given clock reading."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", start, c))


def flattened(df: DataFrame) -> DataFrame:
    """Nested structs as columns with dotted names; lists stay as they are."""

    def leaves(fields: list[T.StructField], path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                found += leaves(f.dataType.fields, here)
            else:
                found.append(F.col(".".join(map(_escaped, here))).alias(".".join(here)))
        return found

    return df.select(*leaves(df.schema.fields, ()))


def kept(df: DataFrame, *conditions: Condition) -> DataFrame:
    """The rows for which all conditions hold."""
    row = Row(df.columns)
    return df.where(reduce(and_, [c(row) for c in conditions])) if conditions else df
