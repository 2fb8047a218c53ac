"""Source queries: tables written in a file format and read back, or read as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import steps
from graphloom.queries.shared import Registered, sql_iso, table, texts
from graphloom.sources.choose import read_source
from graphloom.sources.files import Ledger, read_csv, read_local, read_new_objects, read_object_store, read_xml
from graphloom.sources.rows import flattened, kept, text_rows
from graphloom.sources.scratch import shared_folder

QUERIES = Registered()


def _csv_of(spark, df, name):
    """The table as CSV files in a shared folder."""
    path = shared_folder(spark, name)
    writer = df.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


# Amounts are read as text and compared as numbers, since engines write doubles differently.
_MONEY_SQL = "{}::decimal(18, 2)"
_SUPPLIER_SQL = f"""SELECT s_suppkey::varchar AS s_suppkey, s_name, s_nationkey::varchar AS s_nationkey,
                           {_MONEY_SQL.format('s_acctbal')} AS s_acctbal FROM supplier"""


def _money(name):
    return F.col(name).cast("decimal(18, 2)").alias(name)


#: Rows of an XML file at most: a file is read by one task, since Spark can't split it.
ROWS_A_FILE = 100_000


def _xml_of(df, path, row_tag):
    df.write.option("maxRecordsPerFile", ROWS_A_FILE).format("xml").option("rowTag", row_tag).option("rootTag", f"{row_tag}s").save(path)
    return path


@QUERIES.add(
    "src_1_csv",
    """SELECT doc_id::varchar AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
              n_chars::varchar AS n_chars FROM documents""",
)
def csv(spark, folder):
    # Texts hold line breaks, so each file is read as a whole.
    return read_csv(spark, _csv_of(spark, table(spark, folder, "documents"), "documents-csv"), multi_line=True)


@QUERIES.add(
    "src_2_filtered_csv",
    f"""SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey, {_MONEY_SQL.format('c_acctbal')} AS c_acctbal
       FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey <> 3""",
)
def filtered_csv(spark, folder):
    found = read_csv(
        spark,
        _csv_of(spark, table(spark, folder, "customer"), "customer-csv"),
        steps.equals("c_mktsegment", "BUILDING"),
        steps.not_equals("c_nationkey", "3"),
    )
    return found.select("c_custkey", "c_name", "c_nationkey", _money("c_acctbal"))


@QUERIES.add(
    "src_3_rows_as_text",
    f"""SELECT event_id::varchar AS event_id, {sql_iso('ts')} AS ts, user_id::varchar AS user_id,
               event_type, value::decimal(20, 6) AS value, props FROM events""",
)
def rows_as_text(spark, folder):
    # Texts of doubles differ between engines where their values don't.
    return text_rows(table(spark, folder, "events")).withColumn("value", F.col("value").cast("decimal(20, 6)"))


_PART_SQL = """SELECT p_partkey::varchar AS id, p_name AS name, p_brand AS brand, p_type AS type,
                      p_size::varchar AS size, {} AS price FROM part""".format(_MONEY_SQL.format("p_retailprice"))


@QUERIES.add("src_4_xml", _PART_SQL)
def xml(spark, folder):
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.col("p_name").alias("name"),
            F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).alias("kind"),
        ).alias("label"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )
    path = _xml_of(rows, shared_folder(spark, "part-xml"), "part")
    schema = "id string, label struct<name string, kind struct<brand string, type string>>, size string, price string"
    found = read_xml(spark, path, "part", only="part-*", schema=schema)
    return found.select(
        "id",
        F.col("`label.name`").alias("name"),
        F.col("`label.kind.brand`").alias("brand"),
        F.col("`label.kind.type`").alias("type"),
        "size",
        _money("price"),
    )


@QUERIES.add(
    "src_5_local_files",
    _SUPPLIER_SQL,
)
def local_files(spark, folder):
    path = _xml_of(table(spark, folder, "supplier"), shared_folder(spark, "supplier-xml"), "supplier")
    return read_local(spark, path, "supplier").withColumn("s_acctbal", _money("s_acctbal"))


@QUERIES.add(
    "src_6_object_prefix",
    """SELECT o_orderkey::varchar AS o_orderkey, o_orderpriority FROM orders
       WHERE o_orderstatus = 'F'""",
)
def object_prefix(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    root = shared_folder(spark, "orders-objects")
    for name, done in (("filled/a", True), ("open/a", False)):
        part = rows.where((F.col("o_orderstatus") == "F") == done).drop("o_orderstatus")
        _xml_of(part, f"{root}/{name}", "order")
    schema = "o_orderkey string, o_orderpriority string"
    return read_object_store(spark, root, "order", "filled", schema)



@QUERIES.add(
    "src_6_new_objects",
    "SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS reading, o_orderkey::varchar AS o_orderkey, o_orderpriority FROM orders",
)
def new_objects(spark, folder):
    # The second reading gives only what has been added since the first.
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    root, ledger = shared_folder(spark, "growing-objects"), Ledger(spark, shared_folder(spark, "ledger"))
    readings = []
    for reading, done in ((1, True), (2, False)):
        part = rows.where((F.col("o_orderstatus") == "F") == done).drop("o_orderstatus")
        _xml_of(part, f"{root}/day/{reading}", "order")
        found, objects = read_new_objects(spark, root, "order", ledger, "o_orderkey string, o_orderpriority string", "day")
        readings.append(found.select(F.lit(reading).alias("reading"), "o_orderkey", "o_orderpriority"))
        ledger.add(objects)
    return readings[0].unionByName(readings[1])


@QUERIES.add(
    "src_7_source_choice",
    _SUPPLIER_SQL,
)
def source_choice(spark, folder):
    path = _csv_of(spark, table(spark, folder, "supplier"), "supplier-csv")
    return read_source(spark, {"csv": path}).withColumn("s_acctbal", _money("s_acctbal"))


@QUERIES.add(
    "map_10_flatten",
    """SELECT o_orderkey::varchar AS id, o_custkey::varchar AS "by.customer",
              o_orderstatus AS "state.now.status", o_orderpriority AS "state.priority" FROM orders""",
)
def flatten(spark, folder):
    orders = texts(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    nested = orders.select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("customer")).alias("by"),
        F.struct(
            F.struct(F.col("o_orderstatus").alias("status")).alias("now"),
            F.col("o_orderpriority").alias("priority"),
        ).alias("state"),
    )
    return flattened(nested)


@QUERIES.add(
    "flt_1_equals",
    "SELECT c_custkey FROM customer WHERE nullif(c_mktsegment, 'HOUSEHOLD') = 'BUILDING'",
)
def equals(spark, folder):
    return kept(_segments(spark, folder), steps.equals("segment", "BUILDING")).select("c_custkey")


@QUERIES.add(
    "flt_2_not_equals",
    """SELECT c_custkey FROM customer
       WHERE coalesce(nullif(c_mktsegment, 'HOUSEHOLD') <> 'BUILDING', true)""",
)
def not_equals(spark, folder):
    return kept(_segments(spark, folder), steps.not_equals("segment", "BUILDING")).select("c_custkey")


def _segments(spark, folder):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment")
    return table(spark, folder, "customer").select("c_custkey", segment)
