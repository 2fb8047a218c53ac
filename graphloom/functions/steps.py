"""Steps: the pieces of transform chains, and the registry that names them.

A step builds a Column from the source row and the value of the step before it.
Steps that read columns take no notice of that value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import branches, conditions, hashes, numbers, text, times


class Row:
    """The columns of a source by name; dots in a name are part of it."""

    def __init__(self, names: Iterable[str]):
        self.names = tuple(names)
        self._known = frozenset(self.names)

    def __contains__(self, name: str) -> bool:
        return name in self._known

    def __getitem__(self, name: str) -> Column:
        if name not in self._known:
            raise ValueError(f"the column {name!r} is not found")
        return F.col("`" + name.replace("`", "``") + "`")

    def get(self, name: str) -> Column | None:
        return self[name] if name in self._known else None


@dataclass(frozen=True)
class Step:
    build: Callable[[Row, Column | None], Column]
    # What a comparison uses in place of the text, such as a point in time.
    compared: Callable[[Row, Column | None], Column] | None = None


Chain = Sequence[Step]
Condition = Callable[[Row], Column]


def run_chain(chain: Chain, row: Row, start: Column | None = None, compared: bool = False) -> Column:
    value = start
    for position, step in enumerate(chain):
        last = position == len(chain) - 1
        build = step.compared if compared and last and step.compared else step.build
        value = build(row, value)
    if value is None:
        raise ValueError("an empty chain needs a column to start from")
    return value


def _on_value(function: Callable[..., Column], *args: Any, **kwargs: Any) -> Step:
    return Step(lambda row, c: function(c, *args, **kwargs))


def value(value: str | None) -> Step:
    return Step(lambda row, c: F.lit(value).cast("string"))


def column(column: str) -> Step:
    return Step(lambda row, c: row[column])


def extractor(function: Callable[[Row], Column]) -> Step:
    """A user function from the row to a Column."""
    return Step(lambda row, c: function(row))


def concat(columns: Sequence[str], separator: str = "") -> Step:
    return Step(lambda row, c: text.join_columns([row[n] for n in columns], separator))


def hash_of(columns: Sequence[str], hash_function: str = "murmur128") -> Step:
    return Step(lambda row, c: hashes.hash_columns([row[n] for n in columns], hash_function))


def point(lat: Chain, lon: Chain) -> Step:
    return Step(lambda row, c: branches.point(run_chain(lat, row, c), run_chain(lon, row, c)))


def arithmetic(left: Chain, right: Chain, operator: str, alternative: float | None = None) -> Step:
    return Step(
        lambda row, c: numbers.arithmetic(
            run_chain(left, row, c), run_chain(right, row, c), operator, alternative
        )
    )


def prefix(prefix: str) -> Step:
    return _on_value(text.prefix, prefix)


def split(
    separator: str, index: int | str, value_else: str | None = None, if_more_than: int | None = None
) -> Step:
    return _on_value(text.split_part, separator, index, value_else, if_more_than)


def case(type: str | None = None) -> Step:
    return _on_value(text.change_case, type)


def replace_regex(target: str, goal: str) -> Step:
    return _on_value(text.replace_regex, target, goal)


def replace(
    target: Sequence[str],
    goal: Sequence[str],
    ignore_case: bool = False,
    partial: bool = False,
    value_else: str | None = None,
) -> Step:
    return _on_value(text.replace_values, target, goal, ignore_case, partial, value_else)


def padding(pattern: str, length: int, pre: bool = False, cutoff: bool = False) -> Step:
    return _on_value(text.pad, pattern, length, pre, cutoff)


def parse_int() -> Step:
    return _on_value(numbers.int_text)


def parse_bool() -> Step:
    return _on_value(numbers.bool_text)


def date(patterns: Sequence[str], pivot_year: int = times.DEFAULT_PIVOT_YEAR) -> Step:
    return Step(
        lambda row, c: times.date_text(c, patterns, pivot_year),
        lambda row, c: times.date_value(c, patterns, pivot_year),
    )


def datetime(
    patterns: Sequence[str], timezone: str = "UTC", pivot_year: int = times.DEFAULT_PIVOT_YEAR
) -> Step:
    return Step(
        lambda row, c: times.datetime_text(c, patterns, timezone, pivot_year),
        lambda row, c: times.datetime_instant(c, patterns, timezone, pivot_year),
    )


def datetime_shift(
    patterns: Sequence[str], timezone: str = "UTC", pivot_year: int = times.DEFAULT_PIVOT_YEAR
) -> Step:
    return _on_value(times.shift_offset, patterns, timezone, pivot_year)


def timezone_shift(
    patterns: Sequence[str], timezone: str = "UTC", pivot_year: int = times.DEFAULT_PIVOT_YEAR
) -> Step:
    return _on_value(times.shift_zone, patterns, timezone, pivot_year)


def _either(
    test: Callable[[Row, Column | None], Column], if_true: Chain | None, if_false: Chain | None
) -> Step:
    def build(row: Row, c: Column | None) -> Column:
        return branches.branch(
            test(row, c),
            run_chain(if_true, row, c) if if_true else None,
            run_chain(if_false, row, c) if if_false else None,
        )

    return Step(build)


def when(
    condition: Condition | None = None,
    transforms_if_true: Chain | None = None,
    transforms_if_false: Chain | None = None,
) -> Step:
    """Branch on a condition; without one the condition is true."""

    def test(row: Row, c: Column | None) -> Column:
        return F.lit(True) if condition is None else condition(row)

    return _either(test, transforms_if_true, transforms_if_false)


def when_contains(
    column: str,
    text: str,
    ignore_case: bool = False,
    transforms_if_true: Chain | None = None,
    transforms_if_false: Chain | None = None,
) -> Step:
    return _either(
        lambda row, c: branches.contains(row[column], text, ignore_case),
        transforms_if_true,
        transforms_if_false,
    )


def when_blank(
    column: str, transforms_if_true: Chain | None = None, transforms_if_false: Chain | None = None
) -> Step:
    return _either(
        lambda row, c: conditions.blank(row[column]), transforms_if_true, transforms_if_false
    )


def when_prefix(
    prefix: str,
    column: str,
    ignore_case: bool = False,
    transforms_if_true: Chain | None = None,
    transforms_if_false: Chain | None = None,
) -> Step:
    return _either(
        lambda row, c: branches.starts_with(row[column], prefix, ignore_case),
        transforms_if_true,
        transforms_if_false,
    )


def when_regex(
    column: str,
    pattern: str,
    transforms_if_true: Chain | None = None,
    transforms_if_false: Chain | None = None,
) -> Step:
    return _either(
        lambda row, c: conditions.matches(row[column], pattern),
        transforms_if_true,
        transforms_if_false,
    )


# Conditions over a row, for mappings.


def equals(column: str, value: str) -> Condition:
    return lambda row: conditions.equals(_or_null(row, column), value)


def not_equals(column: str, value: str) -> Condition:
    return lambda row: conditions.not_equals(_or_null(row, column), value)


def _or_null(row: Row, name: str) -> Column:
    found = row.get(name)
    return F.lit(None).cast("string") if found is None else found


def is_null(column: str, reverse: bool = False) -> Condition:
    return lambda row: conditions.blank(row.get(column), reverse)


def are_not_null(columns: Sequence[str], type: str | None = None, reverse: bool = False) -> Condition:
    return lambda row: conditions.non_blank_count([row[n] for n in columns], type, reverse)


def regex(column: str, pattern: str, reverse: bool = False) -> Condition:
    return lambda row: conditions.matches(row.get(column), pattern, reverse)


def compare(
    left_column: str | None = None,
    left_transforms: Chain = (),
    right_column: str | None = None,
    right_transforms: Chain = (),
    comparison: str | None = None,
) -> Condition:
    """Compare two chains, each on a column; one of the two may be free of columns."""
    if left_column is None and right_column is None:
        raise ValueError("a comparison needs at least one column")

    def side(row: Row, name: str | None, chain: Chain) -> Column:
        start = None if name is None else row[name]
        made = run_chain(chain, row, start, compared=True)
        return made if start is None else F.when(start.isNotNull(), made)

    def build(row: Row) -> Column:
        return conditions.compare(
            side(row, left_column, left_transforms),
            side(row, right_column, right_transforms),
            comparison,
        )

    return build


def fold(items: Sequence[Condition | str]) -> Condition:
    """One condition from a list with AND and OR markers."""
    return lambda row: conditions.fold([i if isinstance(i, str) else i(row) for i in items])


# The names used in mapping files.
STEPS: dict[str, Callable[..., Step]] = {
    "ArithmeticTransform": arithmetic,
    "BooleanContainsTransform": when_contains,
    "BooleanIsNullTransform": when_blank,
    "BooleanPrefixTransform": when_prefix,
    "BooleanRegexTransform": when_regex,
    "BooleanTransformation": when,
    "CaseTransform": case,
    "ColumnTransform": column,
    "ConcatTransform": concat,
    "DateTimeShiftTransform": datetime_shift,
    "DateTimeTransform": datetime,
    "DateTransform": date,
    "GeographyPointTransform": point,
    "HashTransform": hash_of,
    "PaddingTransform": padding,
    "ParseBoolTransform": parse_bool,
    "ParseIntTransform": parse_int,
    "PrefixTransform": prefix,
    "ReplaceRegexTransform": replace_regex,
    "ReplaceTransform": replace,
    "SplitTransform": split,
    "TimezoneShiftTransform": timezone_shift,
    "ValueTransform": value,
}
CONDITIONS: dict[str, Callable[..., Condition | str]] = {
    "BooleanAreNotNullCondition": are_not_null,
    "BooleanIsNullCondition": is_null,
    "BooleanRegexCondition": regex,
    "CompareCondition": compare,
    "ConditionalAnd": lambda: conditions.AND,
    "ConditionalOr": lambda: conditions.OR,
}


def register_step(name: str, factory: Callable[..., Step]) -> None:
    STEPS[name] = factory


def register_condition(name: str, factory: Callable[..., Condition]) -> None:
    CONDITIONS[name] = factory


def _snake(name: str) -> str:
    out = "".join("_" + ch.lower() if ch.isupper() else ch for ch in name)
    return out.lstrip("_")


def _arguments(spec: Mapping[str, Any]) -> dict[str, Any]:
    """Arguments of a spec: camel-case keys become snake-case, nested specs become steps."""

    def convert(v: Any) -> Any:
        if isinstance(v, Mapping) and "kind" in v:
            return step_from(v) if v["kind"] in STEPS else condition_from(v)
        if isinstance(v, (list, tuple)):
            return [convert(x) for x in v]
        return v

    return {_snake(k): convert(v) for k, v in spec.items() if k != "kind"}


def _made(registry: Mapping[str, Callable[..., Any]], spec: Mapping[str, Any]) -> Any:
    kind = spec.get("kind")
    if kind not in registry:
        raise ValueError(f"unknown kind {kind!r}")
    return registry[kind](**_arguments(spec))


def step_from(spec: Step | Mapping[str, Any]) -> Step:
    return spec if isinstance(spec, Step) else _made(STEPS, spec)


def condition_from(spec: Condition | Mapping[str, Any]) -> Condition | str:
    return _made(CONDITIONS, spec) if isinstance(spec, Mapping) else spec


def chain_from(specs: Iterable[Step | Mapping[str, Any]]) -> tuple[Step, ...]:
    return tuple(step_from(s) for s in specs)
