"""Row conditions. Each returns a boolean Column that is never null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.text import is_blank, not_blank

AND = "and"
OR = "or"


def equals(c: Column, value: str) -> Column:
    return c.eqNullSafe(F.lit(value))


def not_equals(c: Column, value: str) -> Column:
    """Null counts as not equal."""
    return ~c.eqNullSafe(F.lit(value))


def blank(c: Column | None, reverse: bool = False) -> Column:
    """Blank check; a column the row does not have (None) counts as blank."""
    found = F.lit(True) if c is None else is_blank(c)
    return ~found if reverse else found


def non_blank_count(columns: Sequence[Column], kind: str | None = None, reverse: bool = False) -> Column:
    """``all`` (default), ``any`` or ``none`` of the columns hold a value."""
    checks = [not_blank(c) for c in columns]
    kind = kind or "all"
    if kind not in ("all", "any", "none"):
        raise ValueError(f"unknown combination {kind!r}")
    if kind == "all":
        found = fold([F.lit(True), *checks])
    else:
        found = fold([F.lit(False), OR, *checks])
        found = ~found if kind == "none" else found
    return ~found if reverse else found


def matches(c: Column | None, pattern: str, reverse: bool = False) -> Column:
    """Case-insensitive search for a pattern anywhere in the text; null is the empty text."""
    text = F.lit("") if c is None else F.coalesce(c, F.lit(""))
    found = text.rlike(f"(?i){pattern}")
    return ~found if reverse else found


def compare(left: Column, right: Column, comparison: str | None = None) -> Column:
    """Compare two values; null on either side is false, also for ``ne``."""
    tests = {
        "eq": lambda: left == right,
        "ne": lambda: left != right,
        "ge": lambda: left >= right,
        "gt": lambda: left > right,
        "lt": lambda: left < right,
        "le": lambda: left <= right,
    }
    kind = comparison or "le"
    if kind not in tests:
        raise ValueError(f"unknown comparison {kind!r}")
    return F.coalesce(tests[kind](), F.lit(False))


def fold(conditions: Sequence[Column | str]) -> Column:
    """Combine a condition list from left to right.

    The markers ``AND`` and ``OR`` set how the outcome so far meets the
    conditions after them; a list starts with AND.
    """
    outcome: Column | None = None
    joined_by = AND
    for item in conditions:
        if isinstance(item, str):
            if item not in (AND, OR):
                raise ValueError(f"unknown marker {item!r}")
            joined_by = item
        elif outcome is None:
            outcome = item
        else:
            outcome = outcome & item if joined_by == AND else outcome | item
    if outcome is None:
        raise ValueError("a condition list needs a condition")
    return outcome
