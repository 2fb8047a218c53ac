"""Parsers from text to numbers, booleans and UUIDs, and arithmetic. Bad input gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.text import clean, trim_control

# Control characters and spaces around a number are read over, by these and by the casts.
_WHOLE = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
# Every text that is a number: decimal, hexadecimal, or one of two words in this spelling.
_NUMBER = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?)[\x00-\x20]*$"
)


def parse_double(c: Column) -> Column:
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def parse_int(c: Column) -> Column:
    """Whole numbers as they are; other numbers lose their fraction, and what does
    not fit in 32 bits keeps its low 32 bits."""
    whole = F.when(c.rlike(_WHOLE), c.try_cast("int"))
    return F.coalesce(whole, _low_32_bits(parse_double(c)))


def _low_32_bits(d: Column) -> Column:
    exact = F.when(F.abs(d) < 2.0**53, d.try_cast("bigint").cast("decimal(38,0)")).otherwise(
        d.cast("string").try_cast("decimal(38,0)")
    )
    # Moved by half the range, so that one remainder also gives the sign.
    half = F.lit(2**31).cast("decimal(38,0)")
    wrapped = F.pmod(exact + half, F.lit(2**32).cast("decimal(38,0)")) - half
    return F.when(F.abs(d) < 2.0**31, d.try_cast("int")).otherwise(wrapped.try_cast("int"))


def _parse_whole(c: Column, kind: str) -> Column:
    return F.when(c.rlike(_WHOLE), c.try_cast(kind))


def parse_short(c: Column) -> Column:
    return _parse_whole(c, "smallint")


def parse_long(c: Column) -> Column:
    return _parse_whole(c, "bigint")


def parse_uuid(c: Column) -> Column:
    """Canonical lower-case UUID text. Short groups are filled with zeros, long ones keep their end."""
    t = trim_control(c)
    exact = t.rlike(r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")
    valid = t.rlike(r"^[0-9A-Fa-f]{1,16}(-[0-9A-Fa-f]{1,16}){4}$") & (F.length(t) <= 36)
    groups = F.split(F.lower(t), "-")
    widths = (8, 4, 4, 4, 12)  # fixed values: the group lengths of a UUID
    padded = [
        F.right(F.concat(F.lit("0" * w), F.get(groups, i)), F.lit(w)) for i, w in enumerate(widths)
    ]
    return F.when(exact, F.lower(t)).when(valid, F.concat_ws("-", *padded))


def parse_boolean(c: Column) -> Column:
    """``yes``/``true`` are true, every other text is false, blank is null."""
    return F.lower(clean(c)).isin("yes", "true")


def int_text(c: Column) -> Column:
    return parse_int(c).cast("string")


def bool_text(c: Column) -> Column:
    """``"true"`` or ``"false"`` from the usual spellings, 1 and 0 included."""
    return c.try_cast("boolean").cast("string")


def arithmetic(left: Column, right: Column, operator: str, alternative: float | None = None) -> Column:
    """``+ - * /`` on two operands as doubles; an operand that is no number gives the
    alternative, or null without one. Division by zero gives null."""
    if operator not in ("+", "-", "*", "/"):
        raise ValueError(f"unknown operator {operator!r}")

    def operand(c: Column) -> Column:
        number = parse_double(c.cast("string"))
        return number if alternative is None else F.coalesce(number, F.lit(float(alternative)))

    x, y = operand(left), operand(right)
    if operator == "+":
        return x + y
    if operator == "-":
        return x - y
    if operator == "*":
        return x * y
    return F.try_divide(x, y)
