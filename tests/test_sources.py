"""Sources on files that the tests write, and the rules for choosing one."""

import datetime
import decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from graphloom.functions import steps
from graphloom.sources.choose import read_source
from graphloom.sources.files import Ledger, read_csv, read_local, read_new_objects, read_object_store, read_xml
from graphloom.sources.jdbc import jdbc_options, quantile_query, range_predicates
from graphloom.sources.rows import flattened, text_rows

LOANS = """tool,days,note,no
saw,3,,7
plane,"1
4",late,8
file,2,"said ""so"" twice",9
"""


@pytest.fixture
def loans(tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text(LOANS)
    return str(path)


def test_csv(spark, loans):
    rows = read_csv(spark, loans, multi_line=True)
    assert {f.dataType.simpleString() for f in rows.schema} == {"string"}
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("file", "2", 'said "so" twice', "9"), ("plane", "1\n4", "late", "8"), ("saw", "3", "", "7")]


def test_csv_with_conditions(spark, loans):
    rows = read_csv(spark, loans, steps.not_equals("days", "2"), steps.equals("note", "late"), multi_line=True)
    assert [r.no for r in rows.collect()] == ["8"]


@pytest.mark.parametrize("text", ["id,name\n1,amy\n2,bob,EXTRA\n", "id,name\n1,amy\n3\n"])
@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_rows_have_as_many_fields_as_the_header(spark, tmp_path, text, multi_line):
    (tmp_path / "bad.csv").write_text(text)
    for columns in (["id", "name"], ["id"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_csv(spark, str(tmp_path / "bad.csv"), multi_line=multi_line).select(*columns).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_files_have_one_header(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("id,name\n1,amy\n")
    (tmp_path / "b.csv").write_text("name,id\nbob,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), multi_line=multi_line).collect()


def test_broken_xml_ends_the_query(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><id>1</id></r>")
    (tmp_path / "b.xml").write_text("<r><id>2</id")
    for schema in (None, "id string"):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_xml(spark, str(tmp_path), "r", schema=schema).collect()


def test_hidden_csv_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    assert read_csv(spark, str(tmp_path)).count() == 1
    (tmp_path / "_b.csv").write_text("id\n2\n")
    with pytest.raises(ValueError, match="_b.csv"):
        read_csv(spark, str(tmp_path))
    assert read_csv(spark, str(tmp_path / "a.csv")).count() == 1


def test_a_ledger_of_objects(spark, tmp_path):
    ledger, root = Ledger(spark, str(tmp_path / "ledger")), tmp_path / "in"
    def put(name, *ids):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("<rs>" + "".join(f"<r><id>{i}</id></r>" for i in ids) + "</rs>" if ids else "")

    def read(keep=True, prefix=""):
        rows, objects = read_new_objects(spark, str(root), "r", ledger, "id string", prefix)
        found = sorted(r.id for r in rows.collect())
        if keep:
            ledger.add(objects)
        return found

    put("a/1.xml", 1, 2)
    put("a/b [x].xml", 3)
    put("empty")
    assert read(keep=False) == ["1", "2", "3"] and read() == ["1", "2", "3"] and read() == []
    assert ledger.objects().count() == 2
    put("a/1.xml", 1, 2, 4)  # another size
    put("c/2.xml", 5)
    assert read(prefix="c") == ["5"] and read() == ["1", "2", "4"] and read() == []
    put("c/_d/.x.xml", 6)
    with pytest.raises(ValueError, match="hidden|_d"):
        read()


def test_hidden_names_are_refused(spark, tmp_path):
    (tmp_path / "k" / "part").mkdir(parents=True)
    (tmp_path / "k" / "a.xml").write_text("<r><id>1</id></r>")
    (tmp_path / "k" / "_SUCCESS").write_text("")
    (tmp_path / "k" / ".a.xml.crc").write_text("")
    assert read_local(spark, str(tmp_path / "k"), "r").count() == 1
    (tmp_path / "k" / "part" / "_c.xml").write_text("<r><id>2</id></r>")
    assert read_local(spark, str(tmp_path / "k"), "r").count() == 1  # not in this folder
    with pytest.raises(ValueError, match="_c.xml"):
        read_object_store(spark, str(tmp_path), "r", "k")
    (tmp_path / "k" / ".hidden.xml").write_text("<r><id>3</id></r>")
    for read in (read_xml, read_local):
        with pytest.raises(ValueError, match="hidden.xml"):
            read(spark, str(tmp_path / "k"), "r")


def test_csv_reads_only_the_columns_asked_for(spark, tmp_path):
    spark.range(5).select("id", F.lit("x").alias("a"), F.lit("y").alias("b")).write.option("header", True).csv(str(tmp_path / "c"))
    plan = read_csv(spark, str(tmp_path / "c")).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string>" in plan


def test_xml(spark, tmp_path):
    folder = tmp_path / "xml"
    (folder / "below").mkdir(parents=True)
    record = "<record><id>{}</id><plate kind='x'><number>{}</number><empty></empty></plate><seen>a</seen><seen>b</seen></record>"
    (folder / "one.xml").write_text(record.format(1, "AB"))
    (folder / "two.xml").write_text(record.format(2, "CD"))
    (folder / "other.txt").write_text(record.format(3, "EF"))
    (folder / "below" / "deep.xml").write_text(record.format(4, "GH"))
    rows = read_xml(spark, str(folder), "record")
    assert sorted(rows.columns) == ["id", "plate.empty", "plate.kind", "plate.number", "seen"]
    found = rows.select("id", F.col("`plate.number`").alias("number"), F.col("`plate.empty`").alias("empty"), "seen")
    assert sorted(tuple(r) for r in found.collect()) == [("1", "AB", "", ["a", "b"]), ("2", "CD", "", ["a", "b"])]
    assert sorted(r.id for r in read_local(spark, str(folder), "record").collect()) == ["1", "2", "3"]
    assert [r.id for r in read_xml(spark, str(folder / "one.xml"), "record").collect()] == ["1"]
    by_spec = read_source(spark, {"xml": True, "row_tag": "record", "origin": ["local", str(folder)]})
    assert by_spec.count() == 3
    chosen = read_source(spark, {"xml": str(folder), "row_tag": "record", "schema": "id string"})
    assert chosen.columns == ["id"] and chosen.count() == 2


def test_object_store_prefix(spark, tmp_path):
    root = tmp_path / "bucket"
    for name, text in {"2020/a": "<r><id>1</id></r>", "2020/b/c": "<r><id>2</id></r>", "2021/a": "<r><id>3</id></r>", "2020/none": ""}.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def found(*prefix):
        return sorted(r.id for r in read_object_store(spark, str(root), "r", *prefix).collect())

    assert found("2020") == ["1", "2"] and found("2020/a") == ["1"] and found() == ["1", "2", "3"]


def test_text_rows(spark):
    df = spark.sql("""SELECT 1 AS i, 1.5D AS d, true AS b, X'01' AS bytes, CAST(NULL AS int) AS n, DATE'2020-01-02' AS day,
        TIMESTAMP_MICROS(1500) AS ts, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS ntz, CAST(1.50 AS decimal(5,2)) AS dec, 'x' AS `a.b`""")
    row = text_rows(df).first()
    assert tuple(row) == ("1", "1.5", "true", bytearray(b"\x01"), None, "2020-01-02", "1970-01-01T00:00:00.001500Z",
                          "2020-01-02T03:04:05Z", "1.50", "x")


def test_flattened(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd.e', 2), 'l', array(1)) AS a, 3 AS z")
    flat = flattened(df)
    assert flat.columns == ["a.b.c", "a.b.d.e", "a.l", "z"] and tuple(flat.first()) == (1, 2, [1], 3)


def test_jdbc_options():
    connection = {"url": "jdbc:x", "user": "u"}
    assert jdbc_options(connection, "SELECT 1") == {**connection, "fetchsize": "50000", "query": "SELECT 1"}
    split = jdbc_options(connection, "SELECT id FROM t", 100, "id", 0, 900, 9)
    assert split == {**connection, "fetchsize": "100", "dbtable": "(SELECT id FROM t) source_rows",
                     "partitionColumn": "id", "lowerBound": "0", "upperBound": "900", "numPartitions": "9"}
    with pytest.raises(ValueError):
        jdbc_options(connection, "SELECT 1", split_on="id")


@pytest.mark.parametrize("values", [
    [1, 1, 1, 1, 1, 1, 2, 3, None, None], list(range(100)) + [None], [5] * 9, [None, None], [],
    ["a", "it's", "b", "b", "zz", None, ""],
    [datetime.date(2020, 1, d) for d in range(1, 30)], [datetime.datetime(2020, 1, 1, h, 30, 0, 5) for h in range(24)],
    [decimal.Decimal("-1.50"), decimal.Decimal("2.25"), decimal.Decimal("99.00")],
])
def test_each_row_is_in_one_range(values):
    # The SQL runs in the database that checks the queries, within this process.
    con = duckdb.connect()
    kind = next((v for v in values if v is not None), 0)
    name = {str: "varchar", datetime.date: "date", datetime.datetime: "timestamp", decimal.Decimal: "decimal(9, 2)"}.get(type(kind), "bigint")
    con.execute(f"CREATE TABLE t (n bigint, k {name})")
    if values:
        con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    bounds = [b for _, b in con.execute(quantile_query("SELECT n, k FROM t", "k", 4)).fetchall()]
    ranges = range_predicates("k", bounds)
    read = [con.execute(f"SELECT n FROM (SELECT n, k FROM t) source_rows WHERE {r}").fetchall() for r in ranges]
    assert sorted(n for part in read for (n,) in part) == list(range(len(values)))
    assert len(ranges) <= 5
    if len(set(values)) == len(values) > 20:
        assert max(len(part) for part in read) <= -(-len(values) // 4)


def test_bounds_that_are_no_literals():
    with pytest.raises(ValueError):
        range_predicates("k", [b"a", b"b"])


def test_splits_reach_the_reader(spark, monkeypatch):
    from graphloom.sources import choose

    asked = {}
    monkeypatch.setattr(choose, "read_jdbc", lambda spark, connection, sql, **options: asked.update(options))
    spec = {"datasource": {"url": "jdbc:x"}, "sql": "SELECT id FROM t", "fetch_size": 5, "split_on": "id", "lower": 0, "upper": 9, "splits": 3}
    read_source(spark, spec)
    assert asked == {k: spec[k] for k in ("fetch_size", "split_on", "lower", "upper", "splits")}


@pytest.mark.parametrize("spec", [
    {}, {"sql": "SELECT 1"}, {"datasource": {"url": "x"}}, {"datasource": {"url": "x"}, "sql": "q", "csv": "c"},
    {"datasource": {"url": "x"}, "sql": "q", "xml": "c"}, {"datasource": {"url": "x"}, "sql": "q", "origin": ["S3"]},
    {"csv": "c", "origin": ["local", "p"]}, {"csv": "c", "xml": "x"}, {"xml": "x"},
    {"xml": True, "row_tag": "r", "origin": ["S3", "region"]}, {"xml": True, "row_tag": "r", "origin": ["local"]},
    {"xml": True, "row_tag": "r", "origin": ["ftp", "x"]},
])
def test_bad_source_specs(spark, spec):
    with pytest.raises(ValueError):
        read_source(spark, spec)
