"""Every query against its SQL, on the smallest tables."""

import os

import pytest

import check
from __spark_entry__ import entry
from graphloom.queries import all_queries, tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    return check.database(FOLDER)


QUERIES, SQL = all_queries()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check.compare(spark, con, name, FOLDER, QUERIES, SQL) is None


def test_customers_are_dealt_out_before_they_are_mapped(spark):
    found = QUERIES["residence_values"](spark, FOLDER)
    assert "RebalancePartitions" in found._jdf.queryExecution().optimizedPlan().toString()


def test_xml_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_A_FILE", 100)
    path = tables._xml_of(spark.range(1050).selectExpr("id", "id AS n").coalesce(1), str(tmp_path / "x"), "row")
    assert len(list((tmp_path / "x").glob("part-*"))) == 11
    assert spark.read.format("xml").option("rowTag", "row").load(path).count() == 1050


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).columns == ["entity_set", "entity_id", "property", "value"]
