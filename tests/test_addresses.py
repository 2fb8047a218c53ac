"""Addresses in parts, and lookup with misspelt words."""

import random

import pytest

from graphloom.operators import addresses
from graphloom.operators.addresses import look_up_near, near_pairs, parse_address
from tests.helpers import on_texts


def test_parts_of_addresses(spark):
    cases = {
        "556 Scott Street, San Francisco": ("scott street", "556", "house", "san francisco"),
        "556 ; 560B Scott Street": ("scott street", "556;560b", "house", None),
        "Große Straße 12a, 10115 Berlin": ("große straße", "12a", "house", "10115 berlin"),
        "Main Road": ("main road", None, "road", None),
        "42": ("42", None, "road", None), "12 34": ("34", "12", "house", None),
        "": (None, None, None, None), " , Town": (None, None, None, "town"), None: (None, None, None, None),
    }
    found = on_texts(spark, parse_address, *cases)
    assert [tuple(r) if r is not None else (None,) * 4 for r in found] == list(cases.values())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_no_near_pair_is_missed(spark, most):
    rng = random.Random(most)
    texts = [("1", "".join(rng.choice("ab c") for _ in range(rng.randint(1, 9)))) for _ in range(60)] + [("2", "ab"), ("1", "")]
    sides = [spark.createDataFrame(texts[k::2], "house_number string, text string") for k in (0, 1)]
    found = near_pairs(*sides, most).collect()
    expected = {(n, a, b, edits(a, b)) for n, a in texts[::2] for m, b in texts[1::2] if n == m and edits(a, b) <= most}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_no_near_pair_is_missed_where_pieces_are_common(spark, most, monkeypatch):
    rng = random.Random(most)
    texts = [("1", "".join(rng.choice("ab c") for _ in range(rng.randint(1, 9)))) for _ in range(60)] + [("2", "ab"), ("1", ""), ("1", "aé😀")]
    sides = [spark.createDataFrame(texts[k::2], "house_number string, text string") for k in (0, 1)]
    expected = {(n, a, b, edits(a, b)) for n, a in texts[::2] for m, b in texts[1::2] if n == m and edits(a, b) <= most}
    for common in (0, 2):
        monkeypatch.setattr(addresses, "COMMON", common)
        found = near_pairs(*sides, most).collect()
        assert {tuple(r) for r in found} == expected and len(found) == len(expected)


def test_texts_that_begin_alike_are_not_all_paired(spark):
    # 400 numbers on either side that differ in their last digits, with one letter left out on one side.
    rows = spark.range(400).selectExpr("'7' AS house_number", "'suplier ' || lpad(id * 7, 9, '0') AS text")
    known = spark.range(400).selectExpr("'7' AS house_number", "'supplier ' || lpad(id * 7, 9, '0') AS text")
    found = near_pairs(rows, known).where("distance < 2")
    assert found.count() == 400
    pairs = addresses._met_by_shortening(rows, known.selectExpr("house_number", "text AS entry", "length(text) AS size"), 2)
    assert pairs.count() < 0.2 * 400 * 400


def test_lookup_takes_the_nearest(spark):
    gazetteer = spark.createDataFrame(
        [("12 Scott Street", "b"), ("12 Scott Street", "a"), ("12 Skott Street", "c"), ("13 Scott Street", "d"), ("Scott Street", "e"), (" ", "f"), (None, "g")],
        "address string, point string")
    rows = [(1, "12 scot street"), (2, "12 Scott  Street."), (3, "Scott-Street"), (4, "14 Scott Street"), (5, None), (6, ","), (7, "12 Sqott Street"), (8, "12 Schott Strasse")]
    found = look_up_near(spark.createDataFrame(rows, "id int, address string"), "address", gazetteer, ["point"])
    assert found.columns == ["id", "address", "point", "distance"] and "CartesianProduct" not in found._jdf.queryExecution().toString()
    assert {r.id: (r.point, r.distance) for r in found.collect()} == {
        1: ("a", 1), 2: ("a", 0), 3: ("e", 0), 4: (None, None), 5: (None, None), 6: (None, None), 7: ("a", 1), 8: (None, None)}
