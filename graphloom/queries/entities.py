"""Queries for mappings: entities, edges, ids, lookups and counts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from graphloom.functions import steps
from graphloom.functions.steps import Row
from graphloom.functions.text import base64_text
from graphloom.operators import addresses, counts, graph, ids
from graphloom.plans.catalog import ID_PROPERTY, Catalog, EntitySet, EntityType, PropertyType
from graphloom.plans.mapping import Association, Entity, Mapping, prop
from graphloom.queries.shared import Registered, sql_base64, sql_key_id, table, texts
from graphloom.sources.rows import text_rows

QUERIES = Registered()


def _catalog(properties: dict[str, str], types: dict[str, tuple[tuple[str, ...], tuple[str, ...]]],
             sets: dict[str, str]) -> Catalog:
    return Catalog.of(
        [PropertyType(n, kind) for n, kind in properties.items()],
        [EntityType(n, key, tuple(dict.fromkeys((*key, *rest)))) for n, (key, rest) in types.items()],
        [EntitySet(n, kind) for n, kind in sets.items()],
    )


# Customers live in nations.
RESIDENCE_CATALOG = _catalog(
    {"person.key": "Int64", "person.name": "String", "person.segment": "String", "place.key": "Int32",
     "place.name": "String", "lives.key": "String"},
    {"person": (("person.key",), ("person.name", "person.segment")),
     "place": (("place.key",), ("place.name",)),
     "lives": (("lives.key",), ())},
    {"customers": "person", "nations": "place", "lives_in": "lives"},
)
RESIDENCE = Mapping(
    name="residence",
    entities=(
        Entity("customer", "customers", (
            prop("person.key", "c_custkey"), prop("person.name", "c_name"), prop("person.segment", "c_mktsegment"))),
        Entity("nation", "nations", (prop("place.key", "n_nationkey"), prop("place.name", "n_name"))),
    ),
    associations=(
        Association("lives_in", "lives_in", (prop("lives.key", steps.concat(["c_custkey", "n_nationkey"], "-")),),
                    src="customer", dst="nation"),
    ),
)


def residence_rows(spark, folder):
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return text_rows(joined.select("c_custkey", "c_name", "c_mktsegment", "n_nationkey", "n_name"))


_C, _N = sql_base64("c_custkey"), sql_base64("n_nationkey")
_L = sql_base64("(c_custkey::varchar || '-' || n_nationkey::varchar)")
_RESIDENCE_SQL = "customer JOIN nation ON c_nationkey = n_nationkey"
_VALUES_SQL = f"""SELECT 'customers' AS entity_set, {_C} AS entity_id, 'person.key' AS property, c_custkey::varchar AS value FROM {_RESIDENCE_SQL}
  UNION ALL SELECT 'customers', {_C}, 'person.name', c_name FROM {_RESIDENCE_SQL}
  UNION ALL SELECT 'customers', {_C}, 'person.segment', c_mktsegment FROM {_RESIDENCE_SQL}
  UNION ALL SELECT 'nations', {_N}, 'place.key', n_nationkey::varchar FROM {_RESIDENCE_SQL}
  UNION ALL SELECT 'nations', {_N}, 'place.name', n_name FROM {_RESIDENCE_SQL}
  UNION ALL SELECT 'lives_in', {_L}, 'lives.key', c_custkey::varchar || '-' || n_nationkey::varchar FROM {_RESIDENCE_SQL}"""


@QUERIES.add("residence_values", f"SELECT DISTINCT * FROM ({_VALUES_SQL})")
def residence_values(spark, folder):
    # Customers may be in one file: they are dealt out before they are mapped, so no task groups the values of all.
    values = graph.entity_values(residence_rows(spark, folder).hint("rebalance"), RESIDENCE, RESIDENCE_CATALOG)
    return counts.distinct_values(values).select("entity_set", "entity_id", "property", "value")


@QUERIES.add("map_2_entities", _VALUES_SQL)
def entities(spark, folder):
    values = graph.entity_values(residence_rows(spark, folder), RESIDENCE, RESIDENCE_CATALOG)
    return values.select("entity_set", "entity_id", "property", "value")


@QUERIES.add(
    "map_3_edges",
    f"""SELECT 'POSTGRES' AS destination, 'lives_in' AS edge_set, {_L} AS edge_id, 'customers' AS src_set, {_C} AS src_id,
               'nations' AS dst_set, {_N} AS dst_id FROM {_RESIDENCE_SQL}""",
)
def edges(spark, folder):
    return graph.edges(residence_rows(spark, folder), RESIDENCE, RESIDENCE_CATALOG)


# Words of parts.
_PARTS_CATALOG = _catalog(
    {"part.key": "Int64", "part.word": "String"},
    {"part": (("part.key",), ("part.word",))},
    {"parts": "part"},
)


@QUERIES.add(
    "map_1_value_sets",
    """SELECT p_partkey::varchar AS part, property, value FROM (
         SELECT p_partkey, 'part.key' AS property, p_partkey::varchar AS value FROM part
         UNION ALL SELECT DISTINCT p_partkey, 'part.word', unnest(string_split(p_name || ' ' || p_type || ' ' || p_name, ' '))
         FROM part)""",
)
def value_sets(spark, folder):
    rows = texts(spark, folder, "part", "p_partkey", "p_name", "p_type")
    words = prop("part.word", lambda row: F.split(F.concat_ws(" ", row["p_name"], row["p_type"], F.lit(""), row["p_name"]), " "))
    mapping = Mapping("words", (Entity("part", "parts", (prop("part.key", "p_partkey"), words)),))
    values = graph.entity_values(rows, mapping, _PARTS_CATALOG, keep=["p_partkey"])
    return values.select(F.col("p_partkey").alias("part"), "property", "value")


@QUERIES.add(
    "map_5_default_id",
    f"""SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' OR c_nationkey <> 3 THEN
          CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN {sql_base64('c_mktsegment')} ELSE '' END || '|' ||
          CASE WHEN c_nationkey <> 3 THEN {sql_base64('c_nationkey')} ELSE '' END || '|' END AS entity_id
        FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' OR c_nationkey <> 3""",
)
def default_id(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment"),
        F.when(F.col("c_nationkey") == 3, " ").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
    )
    catalog = _catalog(
        {"group.segment": "String", "group.nation": "Int32", "group.other": "String", "group.size": "String"},
        {"group": (("group.segment", "group.nation", "group.other"), ("group.size",))},
        {"groups": "group"},
    )
    mapping = Mapping("groups", (Entity("group", "groups", (
        prop("group.nation", "nation"), prop("group.segment", "segment"), prop("group.size", steps.value("any")))),))
    values = graph.entity_values(rows, mapping, catalog, keep=["c_custkey"])
    return values.where(F.col("property") == "group.size").select("c_custkey", "entity_id")


@QUERIES.add(
    "map_6_generated_id",
    """SELECT 'ID-' || lower(c_mktsegment) AS entity_id, c_name AS value FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def generated_id(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_name", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment"))
    entity = Entity("person", "customers", (prop("person.name", "c_name"),),
                    generator=(steps.column("segment"), steps.case("lower"), steps.prefix("ID-")))
    values = graph.entity_values(rows, Mapping("people", (entity,)), RESIDENCE_CATALOG)
    return values.select("entity_id", "value")


# Documents and the sources they come from.
_DOCUMENTS_CATALOG = _catalog(
    {"doc.key": "Int64", "doc.lang": "String", "doc.body": "Binary", "doc.size": "Int64", "source.name": "String",
     "from.key": "String"},
    {"doc": (("doc.key",), ("doc.lang", "doc.body", "doc.size")), "source": (("source.name",), ()),
     "from": (("from.key",), ())},
    {"documents": "doc", "sources": "source", "from_source": "from"},
)
_DOCUMENTS = Mapping(
    "documents",
    (
        Entity("document", "documents", (
            prop("doc.key", "doc_id"), prop("doc.lang", "lang"), prop("doc.body", "body"),
            prop("doc.size", "n_chars", destination="REST"))),
        Entity("source", "sources", (prop("source.name", "source"),), associate_only=True),
    ),
    (Association("from", "from_source", (prop("from.key", steps.concat(["doc_id", "source"], "@")),),
                 src="document", dst="source"),),
)


def _documents(spark, folder):
    rows = table(spark, folder, "documents")
    return text_rows(rows.withColumn("body", F.encode("text", "UTF-8")).drop("text"))


@QUERIES.add(
    "map_7_destinations",
    f"""SELECT {sql_base64('doc_id')} AS entity_id, 'doc.key' AS property, 'POSTGRES' AS destination, NULL::bigint AS bytes, doc_id::varchar AS value FROM documents
        UNION ALL SELECT {sql_base64('doc_id')}, 'doc.lang', 'POSTGRES', NULL, lang FROM documents
        UNION ALL SELECT {sql_base64('doc_id')}, 'doc.body', 'S3', strlen(text), NULL FROM documents WHERE text <> ''
        UNION ALL SELECT {sql_base64('doc_id')}, 'doc.size', 'REST', NULL, n_chars::varchar FROM documents
        UNION ALL SELECT {sql_base64('source')}, 'source.name', 'NO_OP', NULL, source FROM documents
        UNION ALL SELECT {sql_base64("(doc_id::varchar || '@' || source)")}, 'from.key', 'POSTGRES', NULL, doc_id::varchar || '@' || source FROM documents""",
)
def destinations(spark, folder):
    values = graph.entity_values(_documents(spark, folder), _DOCUMENTS, _DOCUMENTS_CATALOG)
    return values.select(
        "entity_id", "property", "destination", F.length("content").cast("bigint").alias("bytes"), "value")


@QUERIES.add(
    "map_8_associate_only",
    f"""SELECT 'sources' AS entity_set, {sql_key_id('sources', sql_base64('source'))} AS key_id, 0::bigint AS written_values,
               count(*) AS edges FROM documents GROUP BY source""",
)
def associate_only(spark, folder):
    rows = _documents(spark, folder)
    values = graph.entity_values(rows, _DOCUMENTS, _DOCUMENTS_CATALOG)
    written = ids.with_ids(values.where("entity_set = 'sources' and destination <> 'NO_OP'"))
    per_key = written.groupBy("entity_set", "key_id").agg(F.count("*").alias("written_values"))
    made = ids.edge_ids(graph.edges(rows, _DOCUMENTS, _DOCUMENTS_CATALOG))
    ends = made.groupBy(F.col("dst_set").alias("entity_set"), F.col("dst_key_id").alias("key_id")).agg(
        F.count("*").alias("edges"))
    zero = F.lit(0).cast("bigint")
    return ends.join(per_key, ["entity_set", "key_id"], "left").select(
        "entity_set", "key_id", F.coalesce("written_values", zero).alias("written_values"), "edges")


def _uuid_of(c):
    digest = F.md5(c)
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _sql_uuid(text):
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({text}), {a}, {n})" for a, n in cuts)


_BUYERS_CATALOG = _catalog(
    {"person.key": "Int64", "person.status": "String"},
    {"person": (("person.key",), ("person.status",))},
    {"buyers": "person"},
)


GIVEN_IDS_CATALOG = _BUYERS_CATALOG
GIVEN_IDS = Mapping("buyers", (Entity("buyer", "buyers", (
    prop("person.key", "o_custkey"), prop("person.status", "o_orderstatus"), prop(ID_PROPERTY, "given"))),))
_GIVEN_ROWS_SQL = f"""SELECT DISTINCT 'buyers' AS entity_set, entity_id, CASE WHEN filled THEN given ELSE assigned END AS key_id, property, value
        FROM (SELECT {sql_base64('o_custkey')} AS entity_id, {_sql_uuid("'given ' || o_custkey::varchar")} AS given,
                     {sql_key_id('buyers', sql_base64('o_custkey'))} AS assigned,
                     bool_or(o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS filled,
                     unnest(['person.key', 'person.status']) AS property, unnest([o_custkey::varchar, o_orderstatus]) AS value
              FROM orders)"""
GIVEN_IDS_SQL = f"SELECT entity_set, key_id, property, value FROM ({_GIVEN_ROWS_SQL})"


def given_id_rows(spark, folder):
    """Orders as text, filled ones with an id for their customer."""
    orders = table(spark, folder, "orders")
    given = F.when(F.col("o_orderstatus") == "F", _uuid_of(F.concat(F.lit("given "), F.col("o_custkey").cast("string"))))
    return text_rows(orders.select("o_custkey", "o_orderstatus", given.alias("given")))


@QUERIES.add("map_9_explicit_id", _GIVEN_ROWS_SQL)
def explicit_id(spark, folder):
    rows = given_id_rows(spark, folder)
    values = ids.assign_ids(graph.entity_values(rows, GIVEN_IDS, GIVEN_IDS_CATALOG))
    return values.select("entity_set", "entity_id", "key_id", "property", "value")


@QUERIES.add(
    "map_11_binary_envelope",
    """SELECT doc_id, md5('{"content-type":"application/octet-stream","data":"' || to_base64(encode(text)) || '"}') AS envelope
       FROM documents""",
)
def binary_envelope(spark, folder):
    made = graph.binary_envelope(F.encode("text", "UTF-8"))
    return table(spark, folder, "documents").select("doc_id", F.md5(made).alias("envelope"))


@QUERIES.add(
    "map_12_print_row",
    """SELECT o_orderkey, o_orderkey::varchar || chr(9) || '|' || chr(9) || o_orderpriority || chr(9) || '|' || chr(9) ||
              coalesce(nullif(o_orderstatus, 'F'), 'null') AS "row" FROM orders""",
)
def print_row(spark, folder):
    rows = table(spark, folder, "orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("F")))
    return rows.select(
        "o_orderkey", graph.print_row(Row(rows.columns), ["o_orderkey", "o_orderpriority", "status"]).alias("row"))


# Orders, their buyers, and the edge between them. Pending orders have a blank note.
_ORDERS_CATALOG = _catalog(
    {"order.key": "Int64", "order.note": "String", "order.late": "Date", "buyer.key": "Int64", "placed.key": "Int64"},
    {"order": (("order.key",), ("order.note", "order.late")), "buyer": (("buyer.key",), ()),
     "placed": (("placed.key",), ())},
    {"orders": "order", "buyers": "buyer", "placed_by": "placed"},
)
_ORDER = Entity("order", "orders", (prop("order.key", "o_orderkey"), prop("order.note", "note")))
_BUYER = Entity("buyer", "buyers", (prop("buyer.key", "o_custkey"),))
_PLACED = Association("placed", "placed_by", (prop("placed.key", "o_orderkey"),), src="order", dst="buyer")
_ORDERS = Mapping("orders", (_ORDER, _BUYER), (_PLACED,))


def _orders(spark, folder):
    rows = texts(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    note = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderpriority"))
    return rows.withColumn("note", note)


_O, _B = sql_base64("o_orderkey"), sql_base64("o_custkey")
_ORDER_EDGES = f"SELECT {_O} AS src_id, {_B} AS dst_id FROM orders"


@QUERIES.add(
    "flt_9_row_condition",
    f"{_ORDER_EDGES} WHERE o_orderstatus = 'F'",
)
def row_condition(spark, folder):
    mapping = replace(_ORDERS, condition=steps.equals("o_orderstatus", "F"))
    return graph.edges(_orders(spark, folder), mapping, _ORDERS_CATALOG).select("src_id", "dst_id")


@QUERIES.add(
    "flt_10_entity_condition",
    f"""SELECT 'value' AS part, 'orders' AS entity_set, {_O} AS id FROM orders
        UNION ALL SELECT 'value', 'orders', {_O} FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'value', 'buyers', {_B} FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '3-MEDIUM')
        UNION ALL SELECT 'value', 'placed_by', {_O} FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '3-MEDIUM')
        UNION ALL SELECT 'edge', 'placed_by', {_O} FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '3-MEDIUM')""",
)
def entity_condition(spark, folder):
    buyer = replace(_BUYER, condition=steps.regex("o_orderpriority", "low|medium", True))
    mapping = replace(_ORDERS, entities=(_ORDER, buyer))
    return _values_and_edges(_orders(spark, folder), mapping)


def _values_and_edges(rows, mapping):
    values = graph.entity_values(rows, mapping, _ORDERS_CATALOG)
    made = graph.edges(rows, mapping, _ORDERS_CATALOG)
    return values.select(F.lit("value").alias("part"), "entity_set", F.col("entity_id").alias("id")).unionByName(
        made.select(F.lit("edge").alias("part"), F.col("edge_set").alias("entity_set"), F.col("edge_id").alias("id")))


@QUERIES.add(
    "flt_11_association_condition",
    f"""SELECT 'value' AS part, 'orders' AS entity_set, {_O} AS id FROM orders
        UNION ALL SELECT 'value', 'orders', {_O} FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'value', 'buyers', {_B} FROM orders
        UNION ALL SELECT 'value', 'placed_by', {_O} FROM orders WHERE o_orderstatus <> 'O'
        UNION ALL SELECT 'edge', 'placed_by', {_O} FROM orders WHERE o_orderstatus <> 'O'""",
)
def association_condition(spark, folder):
    placed = replace(_PLACED, condition=steps.not_equals("o_orderstatus", "O"))
    return _values_and_edges(_orders(spark, folder), replace(_ORDERS, associations=(placed,)))


@QUERIES.add(
    "flt_12_blank_skip",
    f"""SELECT {_O} AS entity_id, 'order.key' AS property, o_orderkey::varchar AS value FROM orders
        UNION ALL SELECT {_O}, 'order.note', o_orderpriority FROM orders WHERE o_orderstatus <> 'P'""",
)
def blank_skip(spark, folder):
    mapping = Mapping("orders", (_ORDER,))
    values = graph.entity_values(_orders(spark, folder), mapping, _ORDERS_CATALOG)
    return values.select("entity_id", "property", "value")


@QUERIES.add(
    "join_1_ids",
    f"""SELECT DISTINCT 'customers' AS entity_set, {_C} AS entity_id, {sql_key_id('customers', _C)} AS key_id FROM {_RESIDENCE_SQL}
        UNION ALL SELECT DISTINCT 'nations', {_N}, {sql_key_id('nations', _N)} FROM {_RESIDENCE_SQL}
        UNION ALL SELECT DISTINCT 'lives_in', {_L}, {sql_key_id('lives_in', _L)} FROM {_RESIDENCE_SQL}""",
)
def key_ids(spark, folder):
    values = graph.entity_values(residence_rows(spark, folder), RESIDENCE, RESIDENCE_CATALOG)
    return ids.with_ids(ids.entity_keys(values))


def _registry(spark, folder):
    """Ids already given: to all nations, and to customers with a high balance."""
    nation, customer = table(spark, folder, "nation"), table(spark, folder, "customer")
    keys = nation.select(F.lit("nations").alias("entity_set"), F.col("n_nationkey").cast("string").alias("k")).unionByName(
        customer.where("c_acctbal > 5000").select(F.lit("customers").alias("entity_set"), F.col("c_custkey").cast("string").alias("k")))
    return keys.select("entity_set", base64_text(F.col("k").cast("binary")).alias("entity_id"),
                       _uuid_of(F.concat(F.lit("old "), F.col("k"))).alias("key_id"))


_OLD_C, _OLD_N = _sql_uuid("'old ' || c_custkey::varchar"), _sql_uuid("'old ' || n_nationkey::varchar")
_KNOWN_C = f"CASE WHEN c_acctbal > 5000 THEN {_OLD_C} ELSE {sql_key_id('customers', _C)} END"


@QUERIES.add(
    "join_1_registry",
    f"""SELECT DISTINCT 'customers' AS entity_set, 'person.name' AS property, c_name AS value, {_KNOWN_C} AS key_id FROM {_RESIDENCE_SQL}
        UNION ALL SELECT DISTINCT 'nations', 'place.name', n_name, {_OLD_N} FROM {_RESIDENCE_SQL}""",
)
def registered_ids(spark, folder):
    values = graph.entity_values(residence_rows(spark, folder), RESIDENCE, RESIDENCE_CATALOG)
    named = values.where(F.col("property").isin("person.name", "place.name"))
    found = ids.assign_ids(named, _registry(spark, folder), explicit=False)
    return found.select("entity_set", "property", "value", "key_id")


@QUERIES.add(
    "join_2_edge_ids",
    f"""SELECT 'lives_in' AS edge_set, {sql_key_id('lives_in', _L)} AS edge_key_id, 'customers' AS src_set,
               {_KNOWN_C} AS src_key_id, 'nations' AS dst_set, {_OLD_N} AS dst_key_id FROM {_RESIDENCE_SQL}""",
)
def edge_ids(spark, folder):
    made = graph.edges(residence_rows(spark, folder), RESIDENCE, RESIDENCE_CATALOG)
    return ids.distinct_edges(ids.edge_ids(made, _registry(spark, folder)))


@QUERIES.add(
    "join_2_dangling",
    f"""SELECT {_O} AS edge_id, {_B} AS dst_id FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING')""",
)
def dangling(spark, folder):
    orders = _orders(spark, folder)
    made = graph.edges(orders, _ORDERS, _ORDERS_CATALOG)
    known = table(spark, folder, "customer").where("c_acctbal > 0 and c_mktsegment <> 'BUILDING'")
    buyers = known.select(F.lit("buyers").alias("entity_set"), base64_text(F.col("c_custkey").cast("string").cast("binary")).alias("entity_id"))
    sources = made.select(F.col("src_set").alias("entity_set"), F.col("src_id").alias("entity_id"))
    return ids.dangling_edges(made, buyers.unionByName(sources)).select("edge_id", "dst_id")


@QUERIES.add(
    "join_4_address",
    """SELECT c_custkey, road, house_number, type, geographypoint FROM customer LEFT JOIN (
         SELECT DISTINCT c_nationkey AS k, c_mktsegment AS s, c_mktsegment || ' road' AS road,
                c_nationkey::varchar AS house_number, 'house' AS type,
                c_nationkey::varchar || '.5,' || length(c_mktsegment)::varchar AS geographypoint
         FROM customer WHERE c_acctbal > 6000) ON c_nationkey = k AND c_mktsegment = s""",
)
def address(spark, folder):
    customer = table(spark, folder, "customer")
    rows = customer.select(
        "c_custkey", F.concat_ws(", ", F.col("c_nationkey").cast("string"), "c_mktsegment", F.lit("")).alias("address"))
    known = customer.where("c_acctbal > 6000")
    gazetteer = known.select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(" "), F.lower("c_mktsegment")).alias("address"),
        F.concat("c_mktsegment", F.lit(" road")).alias("road"),
        F.col("c_nationkey").cast("string").alias("house_number"),
        F.lit("house").alias("type"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".5,"), F.length("c_mktsegment").cast("string")).alias("geographypoint"),
    )
    fields = ["road", "house_number", "type", "geographypoint"]
    return ids.look_up_address(rows, "address", gazetteer, fields).drop("address")


_NORMAL = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


@QUERIES.add(
    "join_4_parsed",
    f"""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN {_NORMAL.format('c_name')} || ' road' WHEN 'MACHINERY' THEN {_NORMAL.format('c_name')} || ' street'
              WHEN 'FURNITURE' THEN {_NORMAL.format('n_name')} ELSE {_NORMAL.format('n_name')} || ' lane' END AS road,
           CASE c_mktsegment WHEN 'BUILDING' THEN c_custkey::varchar WHEN 'MACHINERY' THEN c_custkey::varchar || 'b'
              WHEN 'FURNITURE' THEN c_custkey::varchar || ';' || c_nationkey::varchar END AS house_number,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'house' ELSE 'road' END AS type,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN {_NORMAL.format('n_name')} END AS place
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def parsed_address(spark, folder):
    rows = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    number, kind = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    made = (
        F.when(kind == "BUILDING", F.concat(number, F.lit(" "), "c_name", F.lit(" Road, "), "n_name"))
        .when(kind == "MACHINERY", F.concat("c_name", F.lit(" Street "), number, F.lit("b,"), "n_name"))
        .when(kind == "FURNITURE", F.concat(number, F.lit(" ; "), F.col("c_nationkey").cast("string"), F.lit(" "), "n_name"))
        .otherwise(F.concat("n_name", F.lit("-Lane"))))
    return rows.select("c_custkey", addresses.parse_address(made).alias("a")).select("c_custkey", "a.*")


@QUERIES.add(
    "join_4_near",
    """SELECT c_custkey, s_suppkey AS supplier, d AS distance FROM customer LEFT JOIN (
         SELECT c_custkey AS k, s_suppkey, levenshtein(mine, theirs) AS d FROM (
           SELECT c_custkey, c_nationkey, 'suplier ' || lpad(c_custkey::varchar, 9, '0') AS mine FROM customer)
         JOIN (SELECT s_suppkey, s_nationkey, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g')) AS theirs FROM supplier) ON c_nationkey = s_nationkey
         WHERE levenshtein(mine, theirs) <= 2
         QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY levenshtein(mine, theirs), theirs, s_suppkey) = 1) ON c_custkey = k""",
)
def near_address(spark, folder):
    # One letter is missing everywhere, and the number is at most one digit off.
    rows = table(spark, folder, "customer").select("c_custkey", F.concat(
        F.col("c_nationkey").cast("string"), F.lit(" Suplier "), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("address"))
    known = table(spark, folder, "supplier").select(
        F.concat(F.col("s_nationkey").cast("string"), F.lit(" "), "s_name").alias("address"), F.col("s_suppkey").alias("supplier"))
    return addresses.look_up_near(rows, "address", known, ["supplier"]).select("c_custkey", "supplier", "distance")


# Users and what they last did.
_USERS_CATALOG = _catalog(
    {"user.key": "Int64", "user.did": "String", "user.note": "String"},
    {"user": (("user.key",), ("user.did", "user.note"))},
    {"users": "user"},
)
_USERS = Mapping("users", (Entity("user", "users", (
    prop("user.key", "user_id"), prop("user.did", "event_type"), prop("user.note", "props"))),))


def _user_values(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "props")
    texts_ = rows.withColumn("user_id", F.col("user_id").cast("string"))
    return graph.entity_values(texts_, _USERS, _USERS_CATALOG, keep=["event_id"])


_USER_SQL = """(SELECT event_id, user_id, unnest(['user.key', 'user.did', 'user.note']) AS property,
  unnest([user_id::varchar, event_type, props]) AS value FROM events) long"""
_U = sql_base64("user_id")


@QUERIES.add(
    "agg_1_value_sets_across_rows",
    f"SELECT {_U} AS entity_id, property, count(DISTINCT value) AS values FROM {_USER_SQL} GROUP BY ALL",
)
def sets_across_rows(spark, folder):
    distinct = counts.distinct_values(_user_values(spark, folder))
    return distinct.groupBy("entity_id", "property").agg(F.count("*").alias("values"))


@QUERIES.add("agg_2_union", f"SELECT DISTINCT {_U} AS entity_id, property, value FROM {_USER_SQL}")
def union_of_rows(spark, folder):
    return counts.distinct_values(_user_values(spark, folder)).select("entity_id", "property", "value")


@QUERIES.add(
    "agg_2_last_wins",
    f"""SELECT {_U} AS entity_id, property, value FROM {_USER_SQL} WHERE event_id IN (
          SELECT event_id FROM (SELECT event_id, row_number() OVER (
            PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 <> 0 AND user_id % 5 <> 0 THEN event_id // 100 END DESC NULLS LAST, event_id DESC
          ) AS n FROM events) WHERE n = 1)""",
)
def last_wins(spark, folder):
    # An order with ties, without a value for some rows and for all rows of some users.
    ordered = (F.col("event_id") % 3 != 0) & (F.col("user_id") % 5 != 0)
    rows = table(spark, folder, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "props",
        F.when(ordered, F.floor(F.col("event_id") / 100)).alias("at"))
    values = graph.entity_values(rows, _USERS, _USERS_CATALOG, keep=["at", "event_id"])
    return counts.last_row_wins(values, ["at", "event_id"]).select("entity_id", "property", "value")


@QUERIES.add(
    "agg_3_counts",
    """SELECT 'POSTGRES' AS destination, 2 * count(*) AS entities, 3 * count(*) AS property_values, count(*) AS edges FROM documents
       UNION ALL SELECT 'S3', count(*), count(*), 0 FROM documents WHERE text <> ''
       UNION ALL SELECT 'REST', count(*), count(*), 0 FROM documents
       UNION ALL SELECT 'NO_OP', count(DISTINCT source), count(*), 0 FROM documents""",
)
def destination_counts(spark, folder):
    rows = _documents(spark, folder)
    return counts.counts_by_destination(
        graph.entity_values(rows, _DOCUMENTS, _DOCUMENTS_CATALOG), graph.edges(rows, _DOCUMENTS, _DOCUMENTS_CATALOG))


@QUERIES.add(
    "agg_4_counters",
    "SELECT count(*) AS rows, ceil(count(*) / 1000.0)::bigint AS batches FROM lineitem",
)
def counters(spark, folder):
    return counts.batch_counts(table(spark, folder, "lineitem"), 1000)


@QUERIES.add(
    "agg_5_distinct",
    f"""SELECT 'key' AS part, 'customers' AS entity_set, count(DISTINCT c_custkey) AS n FROM {_RESIDENCE_SQL}
        UNION ALL SELECT 'key', 'nations', count(DISTINCT n_nationkey) FROM {_RESIDENCE_SQL}
        UNION ALL SELECT 'key', 'lives_in', count(*) FROM {_RESIDENCE_SQL}
        UNION ALL SELECT 'edge', 'lives_in', count(*) FROM {_RESIDENCE_SQL}""",
)
def distinct(spark, folder):
    rows = residence_rows(spark, folder)
    keys = ids.entity_keys(graph.entity_values(rows, RESIDENCE, RESIDENCE_CATALOG))
    made = ids.distinct_edges(ids.edge_ids(graph.edges(rows, RESIDENCE, RESIDENCE_CATALOG)))
    key_counts = keys.groupBy("entity_set").agg(F.count("*").alias("n"))
    edge_counts = made.groupBy(F.col("edge_set").alias("entity_set")).agg(F.count("*").alias("n"))
    return key_counts.select(F.lit("key").alias("part"), "entity_set", "n").unionByName(
        edge_counts.select(F.lit("edge").alias("part"), "entity_set", "n"))


# Orders whose late date is no date when they are urgent.
_LATE = Mapping("late orders", (
    Entity("order", "orders", (prop("order.key", "o_orderkey"), prop("order.late", "late"))),
    Entity("buyer", "buyers", (prop("buyer.key", "o_custkey"),), generator=(steps.column("note"),)),
))


def _late_rejects(spark, folder):
    rows = _orders(spark, folder)
    late = F.when(F.col("o_orderpriority") == "1-URGENT", "at once").otherwise(F.substring("o_orderdate", 1, 10))
    rows = rows.withColumn("late", late).withColumn("at", F.col("o_orderkey").cast("bigint"))
    return graph.rejects(rows, _LATE, _ORDERS_CATALOG, ["o_orderkey", "o_orderpriority"], keep=["at"])


_SHOWN = "o_orderkey::varchar || chr(9) || '|' || chr(9) || o_orderpriority"
_REJECTS_SQL = f"""SELECT o_orderkey AS "at", {_SHOWN} AS "row", 'order' AS alias, 'order.late' AS property, 'at once' AS value, 'not a Date' AS reason
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, {_SHOWN}, 'buyer', NULL, NULL, 'blank id' FROM orders WHERE o_orderstatus = 'P'"""


@QUERIES.add("agg_6_rejects", _REJECTS_SQL)
def rejects(spark, folder):
    return _late_rejects(spark, folder)


@QUERIES.add(
    "agg_6_earliest_reject",
    f"""SELECT "at", "row", alias, property, reason FROM ({_REJECTS_SQL})
        ORDER BY "at", "row", alias, property NULLS FIRST LIMIT 1""",
)
def earliest_reject(spark, folder):
    return counts.earliest_reject(_late_rejects(spark, folder), "at")


@QUERIES.add(
    "agg_7_binaries_by_update_type",
    """SELECT CASE WHEN lang IN ('de', 'fr') THEN 'Versioned' WHEN lang = 'en' THEN 'Unversioned' END AS property_update_type,
              count(*) AS binaries, sum(strlen(text))::bigint AS bytes FROM documents WHERE text IS NOT NULL GROUP BY ALL""",
)
def binaries_by_update_type(spark, folder):
    values = table(spark, folder, "documents").select(
        F.col("lang").alias("entity_set"), F.encode("text", "UTF-8").alias("content"))
    types = {"de": "Versioned", "fr": "Versioned", "en": "Unversioned"}
    return counts.binaries_by_update_type(values, types)


@QUERIES.add(
    "agg_8_update_types",
    """SELECT entity_set, update_type, count(*) AS n FROM (
         SELECT 'orders' AS entity_set, 'Replace' AS update_type FROM orders
         UNION ALL SELECT 'orders', 'Replace' FROM orders WHERE o_orderstatus <> 'P'
         UNION ALL SELECT 'buyers', 'Merge' FROM orders UNION ALL SELECT 'placed_by', 'PartialReplace' FROM orders)
       GROUP BY ALL""",
)
def update_types(spark, folder):
    mapping = replace(
        _ORDERS,
        entities=(replace(_ORDER, update_type="Replace"), _BUYER),
        associations=(replace(_PLACED, update_type="PartialReplace"),),
    )
    values = graph.entity_values(_orders(spark, folder), mapping, _ORDERS_CATALOG)
    kind = counts.labelled(F.col("entity_set"), mapping.update_types()).alias("update_type")
    return values.groupBy("entity_set", kind).agg(F.count("*").alias("n"))
