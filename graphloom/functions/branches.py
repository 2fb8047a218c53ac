"""If/else on a condition, and the "lat,lon" point. A missing branch gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def branch(condition: Column, if_true: Column | None, if_false: Column | None) -> Column:
    nothing = F.lit(None).cast("string")
    return F.when(condition, nothing if if_true is None else if_true).otherwise(
        nothing if if_false is None else if_false
    )


def contains(c: Column, text: str, ignore_case: bool = False) -> Column:
    found = F.lower(c).contains(text.lower()) if ignore_case else c.contains(text)
    return F.coalesce(found, F.lit(False))


def starts_with(c: Column, text: str, ignore_case: bool = False) -> Column:
    found = F.lower(c).startswith(text.lower()) if ignore_case else c.startswith(text)
    return F.coalesce(found, F.lit(False))


def point(lat: Column, lon: Column) -> Column:
    """``"lat,lon"``, null when either part is null."""
    return F.concat(lat.cast("string"), F.lit(","), lon.cast("string"))
