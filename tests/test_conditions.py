"""Row conditions on fixed values."""

import pytest
from pyspark.sql import functions as F

from graphloom.functions import conditions, steps
from graphloom.functions.steps import Row
from graphloom.sources.rows import kept
from tests.helpers import evaluate

ENCOUNTERS = {
    "Encounter 1 start date": "03/05/2000 10:00",
    "Encounter 2 end date": "03/06/2000 12:00",
    "Episode 1 start date": "03/05/2000 09:30",
    "Episode 1 end date": "03/06/2000 12:00",
}


def test_compare_dates(spark):
    df = spark.createDataFrame([tuple(ENCOUNTERS.values())], ", ".join(f"`{n}` string" for n in ENCOUNTERS))
    row = Row(df.columns)
    dates = [steps.datetime(["MM/dd/yyyy HH:mm"])]
    first = steps.compare("Encounter 1 start date", dates, "Episode 1 start date", dates, "lt")
    second = steps.compare("Encounter 2 end date", dates, "Episode 1 end date", dates, "eq")
    assert tuple(df.select(first(row), second(row)).first()) == (False, True)


def test_compare_instants_and_not_texts(spark):
    df = spark.createDataFrame([("10:00", "10:00:30")], "a string, b string")
    times = [steps.datetime(["HH:mm", "HH:mm:ss"])]
    # As texts "1970-01-01T10:00Z" would come after "1970-01-01T10:00:30Z".
    assert df.select(steps.compare("a", times, "b", times, "lt")(Row(df.columns))).first()[0] is True


@pytest.mark.parametrize("comparison, expected", [
    ("eq", [False, True, False]), ("ne", [True, False, False]), ("ge", [False, True, False]),
    ("gt", [False, False, False]), ("lt", [True, False, False]), ("le", [True, True, False]),
    (None, [True, True, False]),
])
def test_compare_with_null_is_false(spark, comparison, expected):
    rows = [("a", "b"), ("a", "a"), ("a", None)]
    df = spark.createDataFrame(rows, "l string, r string")
    made = steps.compare("l", (), "r", (), comparison)(Row(df.columns))
    assert [r[0] for r in df.select(made).collect()] == expected


def test_compare_with_a_constant_and_bad_columns(spark):
    df = spark.createDataFrame([("5",), (None,)], "l string")
    made = steps.compare("l", (), None, [steps.value("5")], "eq")(Row(df.columns))
    assert [r[0] for r in df.select(made).collect()] == [True, False]
    with pytest.raises(ValueError):
        steps.compare(None, (), None, ())
    with pytest.raises(ValueError):
        steps.compare("l", (), "missing", ())(Row(df.columns))


def test_equality_and_null(spark):
    c = F.col("c")
    rows = [("x",), ("y",), (None,)]
    assert evaluate(spark, rows, "c string", conditions.equals(c, "x"), conditions.not_equals(c, "x")) == [
        (True, False), (False, True), (False, True)]


def test_absent_columns(spark):
    df = spark.createDataFrame([("x",)], "c string")
    row = Row(df.columns)
    assert df.select(steps.is_null("none")(row), steps.is_null("none", True)(row),
                     steps.regex("none", "^$")(row), steps.equals("none", "x")(row)).first()[:] == (
        True, False, True, False)
    with pytest.raises(ValueError):
        steps.are_not_null(["none"])(row)


def test_regex_finds_in_any_case(spark):
    c = F.col("c")
    assert evaluate(spark, [("Hello",), ("other",), (None,)], "c string",
                    conditions.matches(c, "ELL"), conditions.matches(c, "ELL", True)) == [
        (True, False), (False, True), (False, True)]


def test_non_blank_count(spark):
    columns = [F.col("a"), F.col("b")]
    rows = [("x", "y"), ("x", " "), (None, "")]
    found = evaluate(spark, rows, "a string, b string",
                     conditions.non_blank_count(columns), conditions.non_blank_count(columns, "any"),
                     conditions.non_blank_count(columns, "none"), conditions.non_blank_count(columns, "any", True))
    assert found == [(True, True, False, False), (False, True, False, False), (False, False, True, True)]
    with pytest.raises(ValueError):
        conditions.non_blank_count(columns, "most")


def test_fold_from_left_to_right(spark):
    t, f = F.lit(True), F.lit(False)
    cases = [
        ([t, f], False), ([conditions.OR, t, f], True), ([f, conditions.OR, t], True),
        ([f, conditions.OR, t, conditions.AND, f], False), ([t, conditions.AND, t, conditions.OR, f], True),
    ]
    df = spark.range(1)
    found = df.select(*[conditions.fold(items).alias(str(i)) for i, (items, _) in enumerate(cases)]).first()
    assert list(found) == [expected for _, expected in cases]
    with pytest.raises(ValueError):
        conditions.fold([conditions.AND])


def test_kept_needs_all_conditions(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "l string, n string")
    found = kept(df, steps.equals("l", "a"), steps.not_equals("n", "2"))
    assert [tuple(r) for r in found.collect()] == [("a", "1")]
