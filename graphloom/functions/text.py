"""Text functions. All take and return Columns and stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that a plain trim removes: everything up to and including the space.
_TRIMMED = "".join(chr(i) for i in range(33))


def is_blank(c: Column) -> Column:
    """Null, empty or only whitespace (a no-break space is not whitespace here).

    Most values start with a printable ASCII character, which settles the
    question without the regular expression.
    """
    printable = F.ascii(c).between(33, 126)
    return c.isNull() | (~printable & c.rlike(r"^\p{javaWhitespace}*$"))


def not_blank(c: Column) -> Column:
    printable = F.ascii(c).between(33, 126)
    return c.isNotNull() & (printable | ~c.rlike(r"^\p{javaWhitespace}*$"))


def trim_control(c: Column) -> Column:
    """Trim spaces and control characters at both ends."""
    return F.trim(c, F.lit(_TRIMMED))


def clean(c: Column) -> Column:
    """Blank becomes null, anything else is trimmed."""
    return F.when(not_blank(c), trim_control(c))


def base64_text(c: Column) -> Column:
    """Base64 on one line; by default Spark breaks it into lines of 76 characters."""
    return F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))


def prefix(c: Column, text: str) -> Column:
    return F.concat(F.lit(text), c)


def join_columns(columns: Sequence[Column], separator: str) -> Column:
    """Concatenate with a separator; null columns are left out."""
    return F.concat_ws(separator, *columns)


def split_part(
    c: Column,
    separator: str,
    index: int | str,
    value_else: str | None = None,
    if_more_than: int | None = None,
) -> Column:
    """Zero-based part of a text, or its ``"last"`` part.

    With ``if_more_than`` the part is given only when the text has more parts
    than that. A part that is not there gives ``value_else``.
    """
    parts = F.split(c, re.escape(separator))
    position = -1 if str(index) == "last" else int(index) + 1
    part = F.try_element_at(parts, F.lit(position))
    if if_more_than is not None:
        part = F.when(F.size(parts) > if_more_than, part)
    return part if value_else is None else F.coalesce(part, F.lit(value_else))


def change_case(c: Column, case: str | None = None) -> Column:
    """``lower``, ``upper``, ``sentence`` or ``name`` (the default)."""
    if case is None or case == "name":
        return F.initcap(c)
    if case == "lower":
        return F.lower(c)
    if case == "upper":
        return F.upper(c)
    if case == "sentence":
        return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    raise ValueError(f"unknown case {case!r}")


def replace_regex(c: Column, target: str, goal: str) -> Column:
    return F.regexp_replace(c, F.lit(target), F.lit(goal))


def replace_values(
    c: Column,
    targets: Sequence[str],
    goals: Sequence[str],
    ignore_case: bool = False,
    partial: bool = False,
    value_else: str | None = None,
) -> Column:
    """Replace listed values.

    Whole-value mode: a value without a match gives ``value_else``, where the
    text ``"null"`` means null, and no ``value_else`` keeps the value.
    Partial mode replaces every occurrence in one pass, so a replacement is
    never replaced again.
    """
    if len(targets) != len(goals):
        raise ValueError("targets and goals differ in length")
    if partial:
        return _replace_within(c, targets, goals, ignore_case)
    compared = F.lower(c) if ignore_case else c
    if value_else is None:
        other = c
    else:
        other = F.lit(None).cast("string") if value_else == "null" else F.lit(value_else)
    for target, goal in reversed(list(zip(targets, goals))):
        wanted = target.lower() if ignore_case else target
        other = F.when(compared == wanted, F.lit(goal)).otherwise(other)
    return other


def _replace_within(
    c: Column, targets: Sequence[str], goals: Sequence[str], ignore_case: bool
) -> Column:
    if not targets:
        return c
    goal_of: dict[str, str] = {}
    for target, goal in zip(targets, goals):
        goal_of.setdefault(target.lower() if ignore_case else target, goal)
    wanted = "|".join(re.escape(t) for t in targets)
    # A target, or the run up to the next one: as many pieces as targets, not as characters.
    pattern = f"(?s{'i' if ignore_case else ''})(?:{wanted})|(?:(?!{wanted}).)++"
    pieces = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    lookup = F.create_map(*[F.lit(x) for pair in goal_of.items() for x in pair])
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.coalesce(F.try_element_at(lookup, F.lower(p) if ignore_case else p), p),
        ),
        "",
    )


def pad(c: Column, filler: str, length: int, pre: bool = False, cutoff: bool = False) -> Column:
    """Pad to ``length``, on the left with ``pre`` and on the right otherwise.

    Longer text is kept unless ``cutoff``, which keeps its end (``pre``) or its start.
    """
    if pre:
        padded = F.right(F.concat(F.lit(filler * length), c), F.lit(length))
    else:
        padded = F.substring(F.concat(c, F.lit(filler * length)), 1, length)
    return padded if cutoff else F.when(F.length(c) >= length, c).otherwise(padded)
