"""Date and time parsing by pattern lists, with ISO texts that keep the offset.

A clock reading ("wall") is held as a timestamp as if it were UTC, and an offset as its
seconds. None of it depends on the session time zone. Patterns are those of
Spark's ``to_timestamp``, so ``MM`` wants two digits and ``M`` takes one or two.

The expressions use each parsed value as few times as they can: what is repeated in an
expression is repeated in the code that Spark compiles from it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from datetime import date
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_PIVOT_YEAR = 2068  # two-digit years run from 1969 to 2068

_DAY = 86_400_000_000  # in microseconds
_ZONE_LETTERS = "XxZzVO"
_ZONE_AT_END = re.compile(rf"\s*[{_ZONE_LETTERS}]+$")
_OFFSET_AT_END = r"\s*([+-]\d{2}(:?\d{2}){0,2}|[Zz])$"
# ISO input is read by a cast and not by a pattern; these stand for it in a list of patterns.
_ISO, _ISO_WITH_OFFSET = "ISO", "ISO with offset"
_ISO_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?"
_SHAPES = {_ISO: _ISO_TEXT + "$", _ISO_WITH_OFFSET: _ISO_TEXT + r"(Z|[+-]\d\d:\d\d)$"}


def _unquoted(pattern: str) -> str:
    return re.sub(r"'[^']*'", "", pattern)


def _has_zone(pattern: str) -> bool:
    if pattern in _SHAPES:
        return pattern == _ISO_WITH_OFFSET
    return any(letter in _unquoted(pattern) for letter in _ZONE_LETTERS)


def _has_short_year(pattern: str) -> bool:
    if pattern in _SHAPES:
        return False
    return re.search(r"(?<![yu])[yu]{2}(?![yu])", _unquoted(pattern)) is not None


def _shape(pattern: str) -> str:
    """Regular expression that every text of a pattern matches.

    It turns most other texts away before the far slower try at parsing them. Patterns
    with optional parts match any text.
    """
    if pattern in _SHAPES:
        return _SHAPES[pattern]
    if re.search(r"[\[\]]|''", pattern):
        return "(?s).*"
    pieces = re.findall(r"'([^']*)'|(([A-Za-z])\3*)|(.)", pattern, re.DOTALL)
    return "(?is)^" + "".join(_piece(quoted, run, other) for quoted, run, _, other in pieces) + "$"


def _piece(quoted: str, run: str, other: str) -> str:
    if run:
        letter, size = run[0], len(run)
        if letter == "S":
            return rf"\d{{1,{size}}}"
        if letter in "yu":
            return r"\d{2}" if size == 2 else r"[+-]?\d+"
        if letter in "MdHhkKms" and size <= 2:
            return r"\d{2}" if size == 2 else r"[+-]?\d+"
        return ".+"  # names, zones and the like
    return re.escape(quoted) if quoted else re.escape(other)


def _ntz(ts: Column) -> Column:
    """A clock reading as a timestamp without zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def _century(wall: Column, pivot_year: int) -> Column:
    """Two-digit years come out as 20xx; those past the pivot belong to the century before."""
    limit = (date(pivot_year + 1, 1, 1) - date(1970, 1, 1)).days * _DAY
    # Counted without zone, and in months, so that 29 February stays a valid day.
    earlier = F.timestamp_diff(
        "MICROSECOND",
        F.expr("timestamp_ntz'1970-01-01 00:00:00'"),
        F.timestamp_add("MONTH", F.lit(-1200), _ntz(wall)),
    )
    return F.when(F.unix_micros(wall) >= limit, F.timestamp_micros(earlier)).otherwise(wall)


def _with_seconds(iso: Column) -> Column:
    """ISO text with its seconds, which a cast asks for."""
    return F.regexp_replace(iso, r"(T\d\d:\d\d)(?![:\d])", "$1:00")


def _in_utc(text: Column, pattern: str) -> Column:
    """A text without offset read as UTC, which keeps the session zone out of it."""
    if pattern in _SHAPES:
        return F.concat(_with_seconds(text), F.lit("Z")).try_cast("timestamp")
    return F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{pattern} XXX"))


def _instant(c: Column, pattern: str) -> Column:
    """The instant of a text with offset."""
    if pattern in _SHAPES:
        return _with_seconds(c).try_cast("timestamp")
    return F.try_to_timestamp(c, F.lit(pattern))


def _read(c: Column, pattern: str) -> Column:
    """Clock reading with two-digit years as 20xx; an offset at the end is read over."""
    if not _has_zone(pattern):
        return _in_utc(c, pattern)
    bare = _ZONE_AT_END.sub("", pattern)
    if pattern not in _SHAPES and _has_zone(bare):  # the zone stands inside the text: read in UTC
        return _instant(c, pattern)
    text = F.regexp_replace(c, _OFFSET_AT_END, "")
    return F.when(c.rlike(_OFFSET_AT_END), _in_utc(text, bare))


def _wall(c: Column, pattern: str, pivot_year: int) -> Column:
    read = _read(c, pattern)
    return _century(read, pivot_year) if _has_short_year(pattern) else read


def _first(c: Column, patterns: Iterable[str], parsed: Callable[[str], Column]) -> Column:
    """What the first matching pattern gives. Blank texts and words match none."""
    return F.coalesce(*[F.when(c.rlike(_shape(p)), parsed(p)) for p in patterns])


def _readings(c: Column, patterns: Iterable[str], pivot_year: int) -> Column:
    return _first(c, patterns, lambda p: _wall(c, p, pivot_year))


def _offsets(c: Column, patterns: Iterable[str]) -> Column:
    """Seconds of offset by the first matching pattern, all of which have one."""
    return _first(c, patterns, lambda p: F.unix_seconds(_read(c, p)) - F.unix_seconds(_instant(c, p)))


def _runs(patterns: Sequence[str]) -> list[tuple[bool, list[str]]]:
    """The patterns and ISO input, in order, cut where those with and without offset meet."""
    every = [*patterns, _ISO_WITH_OFFSET, _ISO]
    return [(zoned, list(run)) for zoned, run in groupby(every, _has_zone)]


def _wall_text(wall: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss[.f]`` of a clock reading."""
    return F.replace(_ntz(wall).cast("string"), F.lit(" "), F.lit("T"))


def _short_text(wall: Column) -> Column:
    """Reading whose seconds are left out when zero and whose fraction has 3 or 6 digits."""
    text = F.regexp_replace(_ntz(wall).cast("string"), r"^(\S+) (\d\d:\d\d)(:00$)?", "$1T$2")
    text = F.regexp_replace(text, r"(\.(?:\d{3})?\d)$", "$100")
    return F.regexp_replace(text, r"(\.(?:\d{3})?\d\d)$", "$10")


def _millis_text(wall: Column) -> Column:
    """Reading with exactly three digits of fraction."""
    text = F.regexp_replace(_wall_text(wall), r"(T\d\d:\d\d:\d\d)$", "$1.000")
    return F.substring(F.concat(text, F.lit("00")), 1, 23)


def _offset_text(seconds: Column) -> Column:
    """``Z`` or ``+hh:mm``, with seconds where there are any."""
    exact = seconds.cast("decimal(18,6)")
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), exact).cast("string")
    # An interval shows as INTERVAL '-0 08:00:00' DAY TO SECOND.
    text = F.regexp_extract(interval, r"'(-?0 \d\d:\d\d(?::(?!00)\d\d)?)", 1)
    text = F.replace(text, F.lit("-0 "), F.lit("-"))
    text = F.replace(text, F.lit("0 "), F.lit("+"))
    return F.replace(text, F.lit("+00:00"), F.lit("Z"))


def _text_in_zone(instant: Column, tz: str) -> Column:
    wall = F.from_utc_timestamp(instant, tz)
    return F.concat(_short_text(wall), _offset_text(F.unix_seconds(wall) - F.unix_seconds(instant)))


def _placed_text(wall: Column, tz: str) -> Column:
    """A clock reading in a zone; readings skipped by the clock change move forward."""
    return utc_text(wall) if tz == "UTC" else _text_in_zone(F.to_utc_timestamp(wall, tz), tz)


def utc_text(ts: Column) -> Column:
    """ISO offset text in UTC of a timestamp column."""
    return F.concat(_short_text(ts), F.lit("Z"))


def datetime_instant(
    c: Column, patterns: Sequence[str], tz: str = "UTC", pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """Point in time by the first matching pattern, ISO input included."""

    def of(zoned: bool, run: list[str]) -> Column:
        wall = _readings(c, run, pivot_year)
        if zoned:
            return F.timestamp_micros(F.unix_micros(wall) - _offsets(c, run) * 1_000_000)
        return wall if tz == "UTC" else F.to_utc_timestamp(wall, tz)

    return F.coalesce(*[of(zoned, run) for zoned, run in _runs(patterns)])


def datetime_text(
    c: Column, patterns: Sequence[str], tz: str = "UTC", pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """ISO offset text by the first matching pattern, ISO input included.

    The zone is used for input without an offset.
    """

    def of(zoned: bool, run: list[str]) -> Column:
        wall = _readings(c, run, pivot_year)
        if zoned:
            return F.concat(_short_text(wall), _offset_text(_offsets(c, run)))
        return _placed_text(wall, tz)

    return F.coalesce(*[of(zoned, run) for zoned, run in _runs(patterns)])


def shift_offset(
    c: Column, patterns: Sequence[str], tz: str = "UTC", pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """Keep the clock reading and replace the offset by the zone's."""
    return _placed_text(_readings(c, [*patterns, _ISO_WITH_OFFSET, _ISO], pivot_year), tz)


def shift_zone(
    c: Column, patterns: Sequence[str], tz: str = "UTC", pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """The same instant shown in another zone; input without an offset is in UTC."""
    return _text_in_zone(datetime_instant(c, patterns, "UTC", pivot_year), tz)


def date_value(
    c: Column, patterns: Sequence[str], pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """Date by the first matching pattern."""
    micros = F.unix_micros(_readings(c, patterns, pivot_year))
    return F.date_from_unix_date(F.floor(micros / F.lit(_DAY)).cast("int"))


def date_text(c: Column, patterns: Sequence[str], pivot_year: int = DEFAULT_PIVOT_YEAR) -> Column:
    return date_value(c, patterns, pivot_year).cast("string")


def parse_local_datetime(
    c: Column, patterns: Sequence[str], tz: str = "UTC", pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """Clock reading by the first matching pattern, placed in the zone, with milliseconds always
    shown. An offset in the text is read over; a reading the zone skips gives null."""
    read = _readings(c, patterns, pivot_year)
    if tz == "UTC":
        return F.concat(_millis_text(read), F.lit("Z"))
    instant = F.to_utc_timestamp(read, tz)
    wall = F.from_utc_timestamp(instant, tz)
    offset = _offset_text(F.unix_seconds(wall) - F.unix_seconds(instant))
    return F.when(read == wall, F.concat(_millis_text(wall), offset))


def parse_local_time(
    c: Column, patterns: Sequence[str], pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """``HH:mm:ss.SSS`` by the first matching pattern."""
    return F.right(_millis_text(_readings(c, patterns, pivot_year)), F.lit(12))


def parse_local_date(
    c: Column, patterns: Sequence[str], pivot_year: int = DEFAULT_PIVOT_YEAR
) -> Column:
    """Date by the first matching pattern, from text that may also hold a time."""
    return date_value(c, patterns, pivot_year)
