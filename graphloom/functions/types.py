"""Property datatypes: the Spark type of each, and the normal form of their values as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import numbers, times

# Datatype names of a catalog and the Spark type each is read as.
SPARK_TYPES = {
    "Binary": "binary",
    "Boolean": "boolean",
    "Date": "date",
    "DateTimeOffset": "timestamp",
    "Decimal": "decimal(38,18)",
    "Double": "double",
    "GeographyPoint": "string",
    "Guid": "string",
    "Int16": "smallint",
    "Int32": "int",
    "Int64": "bigint",
    "String": "string",
    "TimeOfDay": "string",
}

_POINT = r"^\s*[+-]?\d+(\.\d+)?\s*,\s*[+-]?\d+(\.\d+)?\s*$"
_TIME = r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?$"


def normal_text(c: Column, datatype: str) -> Column:
    """Text of the value in the normal form of its datatype; null when it is not of that type."""
    if datatype not in SPARK_TYPES:
        raise ValueError(f"unknown datatype {datatype!r}")
    c = c.cast("string")
    if datatype == "String":
        return c
    if datatype == "Guid":
        return numbers.parse_uuid(c)
    if datatype == "GeographyPoint":
        return F.when(c.rlike(_POINT), F.regexp_replace(c, r"\s", ""))
    if datatype == "TimeOfDay":
        return F.when(F.trim(c).rlike(_TIME), F.trim(c))
    if datatype == "DateTimeOffset":
        return times.datetime_text(c, ())
    if datatype in ("Int16", "Int32", "Int64"):
        whole = {"Int16": numbers.parse_short, "Int64": numbers.parse_long}
        if datatype in whole:
            return whole[datatype](c).cast("string")
        return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("int")).cast("string")
    return c.try_cast(SPARK_TYPES[datatype]).cast("string")
