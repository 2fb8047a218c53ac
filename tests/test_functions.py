"""Scalar functions and steps on fixed values."""

import math

import pytest
from pyspark.sql import functions as F

from graphloom.functions import branches, hashes, numbers, steps, text, times, types
from graphloom.functions.steps import Row, run_chain
from tests.helpers import evaluate, on_texts

# The texts for which results are agreed.
PERSON = {
    "FirstName": "John",
    "LastName": "Doe",
    "Family": "Joanna Doe (mother)",
    "FullName": "John_Paul_Doe",
    "PartialName": "John_Doe",
    "DOB": "03/05/1998 10:00",
    "ArrestedDate": "10/01/92",
    "ReleasedDate": "10-01-25",
    "SSN": None,
    "Sex": "f",
    "Address": "560 Scott Street, San Francisco, CA 94117",
    "CommittedDateTime": "03/05/00 10:00",
    "ArrestedDateTime": "2000-03-05T08:00:00.000-08:00",
    "TransportedDateTime": "2000-03-05 00:02:37.486 +00:00",
    "ChargedDateTime": "03/05/00 10:00-00:00",
    "Lat": "36.23452",
    "Long": "30.34573",
}


@pytest.fixture(scope="module")
def person(spark):
    schema = ", ".join(f"`{n}` string" for n in PERSON)
    df = spark.createDataFrame([tuple(PERSON.values())], schema).cache()
    row = Row(df.columns)

    def run(*chain):
        return df.select(run_chain(chain, row).alias("r")).first()[0]

    return run


YES, NO = [steps.value("yup")], [steps.value("nope")]


def test_point(person):
    assert person(steps.point([steps.column("Lat")], [steps.column("Long")])) == "36.23452,30.34573"
    assert person(steps.point([steps.column("SSN")], [steps.column("Long")])) is None


def test_branches(person):
    assert person(steps.when_contains("DOB", "1998", True, YES, NO)) == "yup"
    assert person(steps.when_contains("DOB", "1999", True, YES, NO)) == "nope"
    assert person(steps.when_contains("FirstName", "jOHN", False, YES, NO)) == "nope"
    assert person(steps.when_contains("FirstName", "jOHN", True, YES, NO)) == "yup"
    assert person(steps.when_contains("SSN", "1", True, YES, NO)) == "nope"
    assert person(steps.when_blank("SSN", YES, NO)) == "yup"
    assert person(steps.when_blank("DOB", YES, NO)) == "nope"
    assert person(steps.when_prefix("jo", "FirstName", True, YES, NO)) == "yup"
    assert person(steps.when_prefix("jo", "FirstName", False, YES, NO)) == "nope"
    assert person(steps.when_prefix("Nobody", "FirstName", False, YES, NO)) == "nope"
    assert person(steps.when_regex("FirstName", "nobody|Jo", YES, NO)) == "yup"
    assert person(steps.when_regex("SSN", "^$", YES, NO)) == "yup"
    assert person(steps.when_blank("DOB", YES, None)) is None
    assert person(steps.when(None, YES, NO)) == "yup"


def test_parse_texts(person, spark):
    assert on_texts(spark, numbers.int_text, "3", "3.7", "-3.7", " 12 ", "x", "", None) == [
        "3", "3", "-3", "12", None, None, None]
    assert on_texts(spark, numbers.bool_text, "1", "0", "true", "false", "maybe") == [
        "true", "false", "true", "false", None]


def test_datetimes(person):
    patterns = ["MM/dd/yyyy HH:mm", "MM/dd/yy HH:mm", "yyyy-MM-dd HH:mm:ss.SSS XXX"]

    def at(column, *args):
        return person(steps.column(column), steps.datetime(patterns, *args))

    assert at("DOB", "UTC") == "1998-03-05T10:00Z"
    assert at("CommittedDateTime", "UTC") == "2000-03-05T10:00Z"
    assert at("ArrestedDateTime") == "2000-03-05T08:00-08:00"
    assert at("TransportedDateTime", "UTC") == "2000-03-05T00:02:37.486Z"
    assert at("DOB", "America/Los_Angeles") == "1998-03-05T10:00-08:00"
    assert at("FirstName") is None
    assert at("SSN") is None


def test_offset_and_zone_shift(person):
    shift = steps.datetime_shift(["MM/dd/yy HH:mmXXX"], "America/Los_Angeles")
    assert person(steps.column("ChargedDateTime"), shift) == "2000-03-05T10:00-08:00"
    zone = steps.timezone_shift(["MM/dd/yy HH:mmXXX"], "America/Los_Angeles")
    assert person(steps.column("ChargedDateTime"), zone) == "2000-03-05T02:00-08:00"


def test_dates(person):
    patterns = ["MM/dd/yy", "MM-dd-yy"]
    assert person(steps.column("ArrestedDate"), steps.date(patterns)) == "1992-10-01"
    assert person(steps.column("ReleasedDate"), steps.date(patterns)) == "2025-10-01"
    assert person(steps.column("ReleasedDate"), steps.date(patterns, 2020)) == "1925-10-01"


def test_two_digit_leap_day(spark):
    assert on_texts(spark, lambda c: times.date_text(c, ["MM/dd/yy"]), "02/29/96", "02/29/04") == [
        "1996-02-29", "2004-02-29"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = on_texts(
            spark,
            lambda c: times.datetime_text(c, ["yyyy-MM-dd HH:mm"], "America/Los_Angeles"),
            "2024-03-10 02:30", "2024-03-10 03:30", "2024-11-03 01:30", "2024-07-01 00:00",
        )
        # The first reading does not exist: the clock goes from 02:00 to 03:00.
        assert found == ["2024-03-10T03:30-07:00", "2024-03-10T03:30-07:00",
                         "2024-11-03T01:30-07:00", "2024-07-01T00:00-07:00"]
        assert on_texts(spark, lambda c: times.date_text(c, ["yyyy-MM-dd HH:mm"]), "2024-03-10 02:30") == [
            "2024-03-10"]
        assert on_texts(spark, lambda c: times.parse_local_time(c, ["yyyy-MM-dd HH:mm"]), "2024-03-10 02:30") == [
            "02:30:00.000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_local_parsers(spark):
    patterns = ["yyyy-MM-dd HH:mm:ss.SSSXXX", "yyyy-MM-dd HH:mm", "yyyy-MM-dd"]
    assert on_texts(
        spark, lambda c: times.parse_local_datetime(c, patterns, "America/Los_Angeles"),
        "2000-03-05 10:00", "2000-07-05", "2000-03-05 10:00:01.250+03:00", "2024-03-10 02:30",
        "NULL", " ", None, "x",
    ) == ["2000-03-05T10:00:00.000-08:00", "2000-07-05T00:00:00.000-07:00",
          "2000-03-05T10:00:01.250-08:00", None, None, None, None, None]
    assert on_texts(spark, lambda c: times.parse_local_time(c, patterns), "2000-03-05 10:07", "NULL") == [
        "10:07:00.000", None]
    assert on_texts(spark, lambda c: times.parse_local_date(c, patterns).cast("string"), "2000-03-05 23:59") == [
        "2000-03-05"]


def test_iso_text_of_fractions(spark):
    found = on_texts(
        spark, lambda c: times.datetime_text(c, ()),
        "2000-03-05T08:00:00Z", "2000-03-05T08:00:01Z", "2000-03-05T08:00:00.5Z",
        "2000-03-05T08:00:00.000250Z", "2000-03-05T08:00-02:30", "2000-03-05T08:00",
    )
    assert found == ["2000-03-05T08:00Z", "2000-03-05T08:00:01Z", "2000-03-05T08:00:00.500Z",
                     "2000-03-05T08:00:00.000250Z", "2000-03-05T08:00-02:30", "2000-03-05T08:00Z"]


def test_prefix(spark):
    assert on_texts(spark, lambda c: text.prefix(c, "prefix_"), "name", None) == ["prefix_name", None]


def test_split(person):
    assert person(steps.column("FullName"), steps.split("_", "2")) == "Doe"
    assert person(steps.column("PartialName"), steps.split("_", "last")) == "Doe"
    assert person(steps.column("FullName"), steps.split("_", "1", None, 2)) == "Paul"
    assert person(steps.column("PartialName"), steps.split("_", "1", None, 2)) is None
    assert person(steps.column("PartialName"), steps.split("_", "5")) is None
    assert person(steps.column("PartialName"), steps.split("_", "5", "none")) == "none"


def test_case(spark):
    assert on_texts(spark, lambda c: text.change_case(c), "JANINE", "123JANINE") == ["Janine", "123janine"]
    assert on_texts(spark, lambda c: text.change_case(c, "lower"), "JAniNE") == ["janine"]
    assert on_texts(spark, lambda c: text.change_case(c, "upper"), "JAniNE") == ["JANINE"]
    assert on_texts(spark, lambda c: text.change_case(c, "sentence"), "janine vanderginst") == ["Janine vanderginst"]
    assert on_texts(spark, lambda c: text.change_case(c, "name"), "janine vanderginst") == ["Janine Vanderginst"]
    with pytest.raises(ValueError):
        text.change_case(F.col("c"), "title")


def test_concat_and_absent_column(person):
    assert person(steps.concat(["FirstName", "LastName"], " ")) == "John Doe"
    with pytest.raises(ValueError):
        person(steps.column("thisdoesnotexist"))


def test_replace_regex(person):
    assert person(steps.column("Family"), steps.replace_regex(r".*\(|\)", "")) == "mother"


def test_replace(person, spark):
    sex = steps.column("Sex")
    assert person(sex, steps.replace(["F"], ["female"], True, False, "null")) == "female"
    assert person(sex, steps.replace(["F"], ["female"], False, False, "null")) is None
    assert person(sex, steps.replace(["F"], ["female"], False, False, None)) == "f"
    assert person(sex, steps.replace(["F"], ["female"], False, False, "other")) == "other"
    assert person(sex, steps.replace(["F", "e"], ["female", "erel"], True, True)) == "female"
    assert on_texts(
        spark, lambda c: text.replace_values(c, ["Android", "a"], ["Windows", "u"], True, True),
        "Android gave new life to java", "a\nb", None,
    ) == ["Windows guve new life to juvu", "u\nb", None]
    assert on_texts(spark, lambda c: text.replace_values(c, ["a.c"], ["$1"], False, True), "abc a.c") == ["abc $1"]


def test_arithmetic(person):
    lat, lon = [steps.column("Lat")], [steps.column("Long")]
    word, nothing = [steps.value("Long")], [steps.value(None)]
    for operator, expected in {
        "+": 36.23452 + 30.34573, "-": 36.23452 - 30.34573,
        "*": 36.23452 * 30.34573, "/": 36.23452 / 30.34573,
    }.items():
        assert math.isclose(person(steps.arithmetic(lat, lon, operator)), expected)
    assert math.isclose(person(steps.arithmetic(lat, word, "+", 0.0)), 36.23452)
    assert person(steps.arithmetic(lat, word, "+")) is None
    assert person(steps.arithmetic(nothing, lon, "+")) is None
    assert person(steps.arithmetic(lat, [steps.value("0")], "/")) is None
    with pytest.raises(ValueError):
        person(steps.arithmetic(lat, lon, ":"))


def test_padding(person):
    first, address = steps.column("FirstName"), steps.column("Address")
    assert person(first, steps.padding("dog", 21, True)) == "ogdogdogdogdogdogJohn"
    assert person(first, steps.padding("dog", 21, False)) == "Johndogdogdogdogdogdo"
    assert person(address, steps.padding("dog", 21, True, True)) == "n Francisco, CA 94117"
    assert person(address, steps.padding("dog", 21, False, True)) == "560 Scott Street, San"
    assert person(address, steps.padding("dog", 21, False, False)) == PERSON["Address"]


def test_number_parsers(spark):
    assert on_texts(spark, numbers.parse_int, "+7", "2147483648", "4294967301.5", "NaN", "1e3", "12d", "9e40") == [
        7, -2147483648, 5, None, 1000, 12, None]
    assert on_texts(spark, numbers.parse_short, "12", "40000", "1.0", "") == [12, None, None, None]
    assert on_texts(spark, numbers.parse_long, "-9", "9223372036854775808", "1e3") == [-9, None, None]
    found = on_texts(spark, numbers.parse_double, " 1.5 ", "inf", "Infinity", "-Infinity", "nan", "x", None)
    assert found == [1.5, None, math.inf, -math.inf, None, None, None]


def test_uuid_and_boolean(spark):
    assert on_texts(
        spark, numbers.parse_uuid, "0123ABCD-0000-1111-2222-0123456789AB", "1-2-3-4-5", "zz", "", None
    ) == ["0123abcd-0000-1111-2222-0123456789ab", "00000001-0002-0003-0004-000000000005", None, None, None]
    assert on_texts(spark, numbers.parse_boolean, "yes", "NO", "TRUE", "1", "what", " ", None) == [
        True, False, True, False, False, None, None]


def test_blank_and_clean(spark):
    texts = [None, "", " \t\n", "\u2003", "\u00a0", "a", " é "]
    blank = [True, True, True, True, False, False, False]
    assert on_texts(spark, text.is_blank, *texts) == blank
    assert on_texts(spark, text.not_blank, *texts) == [not b for b in blank]
    assert on_texts(spark, text.clean, "\x01 a b\t", "  ", None) == ["a b", None, None]


def test_hashes(spark):
    rows = [("AES", "CTR", "128")]
    columns = [F.col(n) for n in ("a", "b", "c")]
    found = evaluate(
        spark, rows, "a string, b string, c string",
        hashes.hash_columns(columns), hashes.hash_columns(columns, "sha256"), hashes.key_id(*columns[:2]),
    )[0]
    import hashlib

    assert found[0] == hashlib.md5(b"AESCTR128").hexdigest()
    assert found[1] == hashlib.sha256(b"AESCTR128").hexdigest()
    assert found[2].replace("-", "") == hashlib.md5(b"AES\x1fCTR").hexdigest()
    with pytest.raises(ValueError):
        hashes.hash_columns(columns, "crc")


@pytest.mark.parametrize("datatype, given, expected", [
    ("String", "x", "x"), ("Boolean", "TRUE", "true"), ("Boolean", "x", None),
    ("Int16", "40000", None), ("Int32", " 12 ", "12"), ("Int32", "1.5", None), ("Int64", "9", "9"),
    ("Double", "1.50", "1.5"), ("Decimal", "1.5", "1.500000000000000000"), ("Date", "2020-02-30", None),
    ("Date", "2020-02-29", "2020-02-29"), ("DateTimeOffset", "2020-02-29T10:00:00+02:00", "2020-02-29T10:00+02:00"),
    ("TimeOfDay", "25:00", None), ("TimeOfDay", "10:00:01.5", "10:00:01.5"),
    ("Guid", "0123ABCD-0000-1111-2222-0123456789AB", "0123abcd-0000-1111-2222-0123456789ab"),
    ("GeographyPoint", "36.2, -30", "36.2,-30"), ("GeographyPoint", "here", None),
])
def test_normal_text(spark, datatype, given, expected):
    assert on_texts(spark, lambda c: types.normal_text(c, datatype), given) == [expected]


def test_registry(person):
    spec = [
        {"kind": "ColumnTransform", "column": "Sex"},
        {"kind": "ReplaceTransform", "target": ["F"], "goal": ["female"], "ignoreCase": True},
        {"kind": "PrefixTransform", "prefix": "is "},
    ]
    assert person(*steps.chain_from(spec)) == "is female"
    nested = {
        "kind": "BooleanIsNullTransform", "column": "SSN",
        "transformsIfTrue": [{"kind": "ValueTransform", "value": "none"}],
    }
    assert person(steps.step_from(nested)) == "none"
    steps.register_step("Reversed", lambda: steps.Step(lambda row, c: F.reverse(c)))
    assert person(steps.column("Sex"), steps.step_from({"kind": "Reversed"})) == "f"
    with pytest.raises(ValueError):
        steps.step_from({"kind": "NoSuchTransform"})


def test_extractor(person):
    assert person(steps.extractor(lambda row: F.concat(row["FirstName"], row["LastName"]))) == "JohnDoe"
    assert branches.branch is not None
