"""Queries for row conditions and for the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import conditions, steps
from graphloom.functions.steps import Row
from graphloom.plans.catalog import Catalog, EntitySet, EntityType, PropertyType, not_in_catalog
from graphloom.queries.shared import Registered, table, texts
from graphloom.sources.rows import kept

QUERIES = Registered()

# Customers with some segments blank in different ways: null, empty, whitespace, a no-break space.
_BLANKS_SQL = """(SELECT c_custkey, c_name, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL
  WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN ' ' || chr(9) || chr(8195)
  WHEN 'FURNITURE' THEN chr(160) ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal < 2000 THEN ' ' ELSE c_name END AS label FROM customer) blanks"""
_BLANK_SQL = "regexp_matches(coalesce({}, ''), '^[\\s\\x{{2003}}]*$')"


def _blanks(spark, folder):
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        F.when(segment == "HOUSEHOLD", None)
        .when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", " \t\u2003")
        .when(segment == "FURNITURE", "\u00a0")
        .otherwise(segment)
        .alias("segment"),
        F.when(F.col("c_acctbal") < 2000, " ").otherwise(F.col("c_name")).alias("label"),
    )


@QUERIES.add(
    "flt_3_is_blank",
    f"""SELECT c_custkey, {_BLANK_SQL.format('segment')} AS segment_blank,
               NOT {_BLANK_SQL.format('segment')} AS segment_set, true AS absent_blank
        FROM {_BLANKS_SQL}""",
)
def is_blank(spark, folder):
    rows = _blanks(spark, folder)
    row = Row(rows.columns)
    return rows.select(
        "c_custkey",
        steps.is_null("segment")(row).alias("segment_blank"),
        steps.is_null("segment", True)(row).alias("segment_set"),
        steps.is_null("no_such_column")(row).alias("absent_blank"),
    )


@QUERIES.add(
    "flt_4_non_blank_count",
    f"""SELECT c_custkey, s AND l AS all_set, s OR l AS any_set, NOT s AND NOT l AS none_set,
               NOT (s AND l) AS not_all_set
        FROM (SELECT c_custkey, NOT {_BLANK_SQL.format('segment')} AS s,
                     NOT {_BLANK_SQL.format('label')} AS l FROM {_BLANKS_SQL})""",
)
def non_blank_count(spark, folder):
    rows = _blanks(spark, folder)
    row, columns = Row(rows.columns), ["segment", "label"]
    return rows.select(
        "c_custkey",
        steps.are_not_null(columns)(row).alias("all_set"),
        steps.are_not_null(columns, "any")(row).alias("any_set"),
        steps.are_not_null(columns, "none")(row).alias("none_set"),
        steps.are_not_null(columns, "all", True)(row).alias("not_all_set"),
    )


@QUERIES.add(
    "flt_5_regex",
    """SELECT doc_id FROM documents
       WHERE regexp_matches(text, 'license|[a-z]+@[a-z]+', 'i') AND NOT regexp_matches(lang, 'F', 'i')""",
)
def regex(spark, folder):
    rows = kept(
        table(spark, folder, "documents").select("doc_id", "text", "lang"),
        steps.regex("text", "license|[a-z]+@[a-z]+"),
        steps.regex("lang", "F", True),
    )
    return rows.select("doc_id")


@QUERIES.add(
    "flt_6_compare",
    """SELECT l_orderkey, l_linenumber, l_shipdate < o_orderdate + interval 60 day AS soon,
              l_shipdate::varchar = o_orderdate::varchar AS same_day,
              coalesce(nullif(l_returnflag, 'N') <> 'A', false) AS flag_ne,
              coalesce(l_returnflag > l_linestatus, false) AS flag_gt,
              coalesce(l_returnflag <= l_linestatus, false) AS flag_le
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def compare(spark, folder):
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    # Equi join of two tables by their key; Spark picks the join by their sizes.
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        "l_returnflag",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.date_format("l_shipdate", "MM/dd/yyyy HH:mm").alias("shipped"),
        F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("ordered"),
        F.date_format(F.col("o_orderdate") + F.expr("interval 60 days"), "yyyy-MM-dd HH:mm").alias("late"),
    )
    row = Row(joined.columns)
    us, iso = [steps.datetime(["MM/dd/yyyy HH:mm"])], [steps.datetime(["yyyy-MM-dd HH:mm"])]
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        steps.compare("shipped", us, "late", iso, "lt")(row).alias("soon"),
        steps.compare("shipped", us, "ordered", us, "eq")(row).alias("same_day"),
        steps.compare("flag", (), None, [steps.value("A")], "ne")(row).alias("flag_ne"),
        steps.compare("l_returnflag", (), "l_linestatus", (), "gt")(row).alias("flag_gt"),
        steps.compare("l_returnflag", (), "l_linestatus", ())(row).alias("flag_le"),
    )


_FOLDED = """SELECT o_orderkey FROM orders WHERE {}"""


def _order_conditions():
    return (
        steps.equals("o_orderstatus", "F"),
        steps.regex("o_orderpriority", "urgent|high"),
        steps.not_equals("o_custkey", "7"),
    )


@QUERIES.add(
    "flt_7_and",
    _FOLDED.format(
        "(o_orderstatus = 'F' OR regexp_matches(o_orderpriority, 'urgent|high', 'i')) AND o_custkey <> 7"
    ),
)
def and_marker(spark, folder):
    status, urgent, customer = _order_conditions()
    wanted = steps.fold([conditions.OR, status, urgent, conditions.AND, customer])
    return kept(texts(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"),
                wanted).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"))


@QUERIES.add(
    "flt_8_or",
    _FOLDED.format(
        "(o_orderstatus = 'F' AND o_custkey <> 7) OR regexp_matches(o_orderpriority, 'urgent|high', 'i')"
    ),
)
def or_marker(spark, folder):
    status, urgent, customer = _order_conditions()
    wanted = steps.fold([status, customer, conditions.OR, urgent])
    return kept(texts(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"),
                wanted).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"))


# A catalog whose entity sets are the event types; every type but one allows the property "value".
_EVENT_CATALOG = Catalog.of(
    [
        PropertyType("event.id", "Int64"),
        PropertyType("event.user", "Int64", pii=True),
        PropertyType("event.value", "Double"),
    ],
    [
        EntityType("plain", ("event.id",), ("event.id", "event.user")),
        EntityType("valued", ("event.id",), ("event.id", "event.user", "event.value")),
    ],
    [EntitySet(s, "valued") for s in ("view", "click", "purchase")] + [EntitySet("signup", "plain")],
)


def _event_properties(spark, folder):
    """Properties in long form, as a property store holds them."""
    events = table(spark, folder, "events").select("event_type", "event_id", "user_id", "value")
    return events.select(
        F.col("event_type").alias("entity_set"),
        F.explode(
            F.array(
                F.struct(F.lit("event.id").alias("property"), F.col("event_id").cast("string").alias("value")),
                F.struct(F.lit("event.user").alias("property"), F.col("user_id").cast("string").alias("value")),
                F.struct(
                    F.lit("event.value").alias("property"),
                    F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
                ),
            )
        ).alias("p"),
    ).select("entity_set", "p.*")


_CATALOG_SQL = """(SELECT * FROM (VALUES ('view'), ('click'), ('purchase'), ('signup')) s(entity_set),
  (VALUES ('event.id', 'Int64', false), ('event.user', 'Int64', true), ('event.value', 'Double', false))
  p(property, datatype, pii) WHERE NOT (entity_set = 'signup' AND property = 'event.value')) known"""
_EVENT_LONG_SQL = """(SELECT event_type AS entity_set, unnest(['event.id', 'event.user', 'event.value']) AS property
  FROM events) used"""


@QUERIES.add(
    "cat_1_catalog",
    f"""SELECT entity_set, property, datatype, pii, count(*) AS n
        FROM {_EVENT_LONG_SQL} JOIN {_CATALOG_SQL} USING (entity_set, property) GROUP BY ALL""",
)
def catalog(spark, folder):
    used = _event_properties(spark, folder).groupBy("entity_set", "property").agg(F.count("*").alias("n"))
    known = _EVENT_CATALOG.property_frame(spark)
    joined = used.join(known, ["entity_set", "property"])
    return joined.select("entity_set", "property", "datatype", "pii", "n")


@QUERIES.add(
    "cat_2_missing_sets",
    """SELECT DISTINCT event_type AS entity_set FROM events
       WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup')""",
)
def missing_sets(spark, folder):
    sets = [(name,) for name in _EVENT_CATALOG.entity_sets]
    known = spark.createDataFrame(sets, "entity_set string")
    return not_in_catalog(_event_properties(spark, folder), known, ["entity_set"])


@QUERIES.add(
    "join_3_property_check",
    f"""SELECT DISTINCT entity_set, property FROM {_EVENT_LONG_SQL}
        WHERE (entity_set, property) NOT IN (SELECT (entity_set, property) FROM {_CATALOG_SQL})""",
)
def property_check(spark, folder):
    return not_in_catalog(
        _event_properties(spark, folder), _EVENT_CATALOG.property_frame(spark), ["entity_set", "property"]
    )
