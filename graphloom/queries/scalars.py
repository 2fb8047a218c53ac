"""Queries for text, number, hash and branch functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import branches, hashes, numbers, steps, text, types
from graphloom.functions.steps import Row, run_chain
from graphloom.queries.shared import Registered, table, texts
from graphloom.sources.rows import text_rows

QUERIES = Registered()


@QUERIES.add(
    "fn_1_value",
    "SELECT c_custkey, 'person' AS kind, NULL::varchar AS nothing FROM customer",
)
def value(spark, folder):
    rows = table(spark, folder, "customer")
    row = Row(rows.columns)
    return rows.select(
        "c_custkey",
        run_chain([steps.value("person")], row).alias("kind"),
        run_chain([steps.value(None)], row).alias("nothing"),
    )


@QUERIES.add("fn_2_column", "SELECT c_custkey::varchar AS id, c_name AS name FROM customer")
def column(spark, folder):
    rows = texts(spark, folder, "customer", "c_custkey", "c_name")
    row = Row(rows.columns)
    return rows.select(
        run_chain([steps.column("c_custkey")], row).alias("id"),
        run_chain([steps.column("c_name")], row).alias("name"),
    )


@QUERIES.add(
    "fn_3_prefix",
    "SELECT p_partkey, 'brand: ' || nullif(p_brand, 'Brand#2') AS branded FROM part",
)
def prefix(spark, folder):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    return table(spark, folder, "part").select("p_partkey", text.prefix(brand, "brand: ").alias("branded"))


@QUERIES.add(
    "fn_4_concat",
    "SELECT p_partkey, concat_ws(' / ', p_name, nullif(p_type, 'SMALL'), p_brand) AS label FROM part",
)
def concat(spark, folder):
    parts = [F.col("p_name"), F.nullif(F.col("p_type"), F.lit("SMALL")), F.col("p_brand")]
    return table(spark, folder, "part").select("p_partkey", text.join_columns(parts, " / ").alias("label"))


@QUERIES.add(
    "fn_5_split",
    """SELECT doc_id, w[1] AS first_word, w[-1] AS last_word, CASE WHEN len(w) > 60 THEN w[3] END AS third_if_long,
              coalesce(w[100], 'none') AS hundredth
       FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
)
def split(spark, folder):
    c = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        text.split_part(c, " ", "0").alias("first_word"),
        text.split_part(c, " ", "last").alias("last_word"),
        text.split_part(c, " ", 2, None, 60).alias("third_if_long"),
        text.split_part(c, " ", 99, "none").alias("hundredth"),
    )


@QUERIES.add(
    "fn_6_case",
    """SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, upper(p_name[1]) || lower(p_name[2:]) AS sentence,
              array_to_string(list_transform(string_split(p_name, ' '),
                lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name, upper(p_type[1]) || lower(p_type[2:]) AS type_name
       FROM part""",
)
def case(spark, folder):
    name, kind = F.col("p_name"), F.col("p_type")
    return table(spark, folder, "part").select(
        "p_partkey",
        text.change_case(kind, "lower").alias("low"),
        text.change_case(name, "upper").alias("up"),
        text.change_case(name, "sentence").alias("sentence"),
        text.change_case(name, "name").alias("name"),
        text.change_case(kind).alias("type_name"),
    )


@QUERIES.add(
    "fn_7_replace_regex",
    r"""SELECT doc_id, md5(regexp_replace(text, '[aeiou]+|\n', '_', 'g')) AS replaced,
               length(regexp_replace(text, '[aeiou]+|\n', '_', 'g')) AS n FROM documents""",
)
def replace_regex(spark, folder):
    replaced = text.replace_regex(F.col("text"), r"[aeiou]+|\n", "_")
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(replaced).alias("replaced"), F.length(replaced).cast("bigint").alias("n")
    )


@QUERIES.add(
    "fn_8_replace",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS or_null,
              CASE o_orderstatus WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS or_same,
              CASE o_orderstatus WHEN 'F' THEN 'filled' ELSE 'other' END AS or_other,
              translate(o_orderpriority, 'eEoOtT', 'ooeexx') AS within
       FROM orders""",
)
def replace(spark, folder):
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.replace_values(status, ["f", "o"], ["filled", "open"], True, False, "null").alias("or_null"),
        text.replace_values(status, ["F"], ["filled"]).alias("or_same"),
        text.replace_values(status, ["F"], ["filled"], value_else="other").alias("or_other"),
        text.replace_values(F.col("o_orderpriority"), ["E", "o", "t"], ["o", "e", "x"], True, True).alias("within"),
    )


@QUERIES.add(
    "fn_9_padding",
    """SELECT p_partkey, right(repeat('dog', 12) || p_name, 12) AS pre_cut, left(p_name || repeat('dog', 12), 12) AS post_cut,
              CASE WHEN length(p_name) >= 9 THEN p_name ELSE right(repeat('xy', 9) || p_name, 9) END AS pre,
              CASE WHEN length(p_name) >= 9 THEN p_name ELSE left(p_name || repeat('xy', 9), 9) END AS post
       FROM part""",
)
def padding(spark, folder):
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        text.pad(name, "dog", 12, pre=True, cutoff=True).alias("pre_cut"),
        text.pad(name, "dog", 12, cutoff=True).alias("post_cut"),
        text.pad(name, "xy", 9, pre=True).alias("pre"),
        text.pad(name, "xy", 9).alias("post"),
    )


@QUERIES.add(
    "fn_10_hash",
    """SELECT p_partkey, md5(concat_ws('', p_name, p_brand)) AS h128, sha256(concat_ws('', p_name, p_brand)) AS h256
       FROM part""",
)
def hash_columns(spark, folder):
    columns = [F.col("p_name"), F.col("p_brand")]
    return table(spark, folder, "part").select(
        "p_partkey",
        hashes.hash_columns(columns).alias("h128"),
        hashes.hash_columns(columns, "sha256").alias("h256"),
    )


@QUERIES.add(
    "fn_11_point",
    """SELECT p_partkey, p_size::varchar || ',' || nullif(p_name, 'small ring') AS point FROM part""",
)
def point(spark, folder):
    rows = table(spark, folder, "part")
    made = branches.point(F.col("p_size"), F.nullif(F.col("p_name"), F.lit("small ring")))
    return rows.select("p_partkey", made.alias("point"))


@QUERIES.add(
    "fn_12_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice + l_quantity AS added,
              l_extendedprice - l_quantity AS taken, l_extendedprice * l_quantity AS times,
              l_extendedprice / l_quantity AS unit, l_extendedprice + 1.5 AS with_other, NULL::double AS without
       FROM lineitem""",
)
def arithmetic(spark, folder):
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag")
    rows = texts(spark, folder, "lineitem", *columns)
    price, quantity, flag = (F.col(c) for c in columns[3:])
    return rows.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_partkey").cast("bigint").alias("l_partkey"),
        numbers.arithmetic(price, quantity, "+").alias("added"),
        numbers.arithmetic(price, quantity, "-").alias("taken"),
        numbers.arithmetic(price, quantity, "*").alias("times"),
        numbers.arithmetic(price, quantity, "/").alias("unit"),
        numbers.arithmetic(price, flag, "+", 1.5).alias("with_other"),
        numbers.arithmetic(price, flag, "+").alias("without"),
    )


@QUERIES.add(
    "fn_13_int_text",
    """SELECT l_orderkey, l_linenumber, l_partkey, trunc(l_extendedprice)::int::varchar AS price, NULL::varchar AS flag
       FROM lineitem""",
)
def int_text(spark, folder):
    rows = table(spark, folder, "lineitem")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.int_text(F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"))).alias("price"),
        numbers.int_text(F.col("l_returnflag")).alias("flag"),
    )


_FLAGS = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag || l_linestatus WHEN 'AF' THEN '1' WHEN 'AO' THEN '0'
  WHEN 'NF' THEN 'TRUE' WHEN 'NO' THEN ' yes ' WHEN 'RF' THEN '  ' ELSE 'maybe' END AS flag FROM lineitem) flags"""


def _flags(spark, folder):
    both = F.concat("l_returnflag", "l_linestatus")
    flag = (
        F.when(both == "AF", "1").when(both == "AO", "0").when(both == "NF", "TRUE")
        .when(both == "NO", " yes ").when(both == "RF", "  ").otherwise("maybe")
    )
    rows = table(spark, folder, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", flag.alias("flag"))


@QUERIES.add(
    "fn_14_bool_text",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN lower(trim(flag)) IN ('1', 'true', 'yes') THEN 'true' WHEN flag = '0' THEN 'false' END AS flag
        FROM {_FLAGS}""",
)
def bool_text(spark, folder):
    rows = _flags(spark, folder)
    return rows.withColumn("flag", numbers.bool_text(F.col("flag")))


@QUERIES.add(
    "fn_19_parse_int",
    """SELECT o_orderkey, trunc(o_totalprice)::int AS whole,
              (t - floor((t + 2147483648) / 4294967296) * 4294967296)::int AS low_bits, o_custkey::int AS plain, NULL::int AS bad
       FROM (SELECT *, o_totalprice::decimal(18, 2)::decimal(30, 2) * 100000 AS t FROM orders)""",
)
def parse_int(spark, folder):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.parse_int(price.cast("string")).alias("whole"),
        numbers.parse_int((price * 100000).cast("string")).alias("low_bits"),
        numbers.parse_int(F.concat(F.lit("\t"), F.col("o_custkey").cast("string"))).alias("plain"),
        numbers.parse_int(F.col("o_orderpriority")).alias("bad"),
    )


@QUERIES.add(
    "fn_20_parse_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey <= 32767 THEN l_partkey END::smallint AS short,
              l_orderkey AS long, NULL::bigint AS long_of_decimal, l_extendedprice AS price, NULL::double AS bad
       FROM lineitem""",
)
def parse_numbers(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.parse_short(F.col("l_partkey").cast("string")).alias("short"),
        numbers.parse_long(F.concat(F.lit(" "), F.col("l_orderkey").cast("string"))).alias("long"),
        numbers.parse_long(F.col("l_extendedprice").cast("string")).alias("long_of_decimal"),
        numbers.parse_double(F.col("l_extendedprice").cast("string")).alias("price"),
        numbers.parse_double(F.col("l_returnflag")).alias("bad"),
    )


@QUERIES.add(
    "fn_21_parse_uuid",
    """SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
              substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id, NULL::varchar AS bad
       FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""",
)
def parse_uuid(spark, folder):
    digest = F.upper(F.md5("c_name"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    given = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])
    return table(spark, folder, "customer").select(
        "c_custkey",
        numbers.parse_uuid(F.concat(F.lit(" "), given)).alias("id"),
        numbers.parse_uuid(F.col("c_name")).alias("bad"),
    )


@QUERIES.add(
    "fn_22_parse_boolean",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN trim(flag) <> '' THEN lower(trim(flag)) IN ('true', 'yes') END AS flag FROM {_FLAGS}""",
)
def parse_boolean(spark, folder):
    rows = _flags(spark, folder)
    return rows.withColumn("flag", numbers.parse_boolean(F.col("flag")))


@QUERIES.add(
    "fn_23_clean",
    f"SELECT l_orderkey, l_linenumber, l_partkey, nullif(trim(flag), '') AS flag FROM {_FLAGS}",
)
def clean(spark, folder):
    rows = _flags(spark, folder)
    return rows.withColumn("flag", text.clean(F.col("flag")))


_BRANCHED = """SELECT o_orderkey, CASE WHEN {} THEN 'yes: ' || o_orderstatus ELSE 'no' END AS found,
  CASE WHEN {} THEN 'yes: ' || o_orderstatus END AS or_null FROM orders"""


def _branched(spark, folder, made):
    """A branch with both sides, and the same branch without its else side."""
    rows = texts(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    row = Row(rows.columns)
    yes, no = [steps.column("o_orderstatus"), steps.prefix("yes: ")], [steps.value("no")]
    return rows.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        run_chain([made(yes, no)], row).alias("found"),
        run_chain([made(yes, None)], row).alias("or_null"),
    )


@QUERIES.add("fn_27_branch", _BRANCHED.format("o_orderstatus <> 'P'", "o_orderstatus <> 'P'"))
def branch(spark, folder):
    wanted = steps.not_equals("o_orderstatus", "P")
    return _branched(spark, folder, lambda yes, no: steps.when(wanted, yes, no))


@QUERIES.add(
    "fn_28_branch_contains",
    _BRANCHED.format("contains(lower(o_orderpriority), 'ed')", "contains(lower(o_orderpriority), 'ed')"),
)
def branch_contains(spark, folder):
    return _branched(
        spark, folder, lambda yes, no: steps.when_contains("o_orderpriority", "eD", True, yes, no)
    )


@QUERIES.add(
    "fn_29_branch_blank",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'none' ELSE c_mktsegment END AS segment
       FROM customer""",
)
def branch_blank(spark, folder):
    segment = F.col("c_mktsegment")
    gaps = F.when(segment == "HOUSEHOLD", None).when(segment == "BUILDING", "  ").otherwise(segment)
    rows = table(spark, folder, "customer").select("c_custkey", gaps.alias("segment"))
    step = steps.when_blank("segment", [steps.value("none")], [steps.column("segment")])
    return rows.select("c_custkey", run_chain([step], Row(rows.columns)).alias("segment"))


@QUERIES.add(
    "fn_30_branch_prefix",
    _BRANCHED.format("starts_with(o_orderpriority, '4-N')", "starts_with(o_orderpriority, '4-N')"),
)
def branch_prefix(spark, folder):
    return _branched(
        spark, folder, lambda yes, no: steps.when_prefix("4-n", "o_orderpriority", True, yes, no)
    )


@QUERIES.add(
    "fn_31_branch_regex",
    _BRANCHED.format(
        "regexp_matches(o_orderpriority, '^[12]-|low', 'i')", "regexp_matches(o_orderpriority, '^[12]-|low', 'i')"
    ),
)
def branch_regex(spark, folder):
    return _branched(
        spark, folder, lambda yes, no: steps.when_regex("o_orderpriority", "^[12]-|low", yes, no)
    )


@QUERIES.add(
    "fn_32_chain",
    """SELECT c_custkey, 'ID ' || right(repeat('0', 12) || regexp_replace(c_name, '^Customer#0*', ''), 12) AS label
       FROM customer""",
)
def chain(spark, folder):
    rows = table(spark, folder, "customer")
    label = [
        steps.column("c_name"),
        steps.replace_regex("^Customer#0*", ""),
        steps.padding("0", 12, pre=True),
        steps.prefix("ID "),
    ]
    return rows.select("c_custkey", run_chain(label, Row(rows.columns)).alias("label"))


@QUERIES.add(
    "fn_33_value_hash",
    "SELECT doc_id, sha256(text) AS hash FROM documents",
)
def value_hash(spark, folder):
    made = F.lower(F.hex(hashes.value_hash(F.col("text"))))
    return table(spark, folder, "documents").select("doc_id", made.alias("hash"))


@QUERIES.add(
    "fn_34_normal_text",
    """SELECT o_orderkey::varchar AS key, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS flag,
              CASE WHEN o_custkey < 32768 THEN o_custkey::varchar END AS short,
              o_totalprice::decimal(18, 2)::decimal(38, 18)::varchar AS price, strftime(o_orderdate, '%Y-%m-%d') AS day,
              NULL::varchar AS wrong_day, 'A' AS any_text
       FROM orders""",
)
def normal_text(spark, folder):
    rows = text_rows(
        table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    )
    flag = F.replace(F.replace("o_orderstatus", F.lit("F"), F.lit("T")), F.lit("O"), F.lit("N"))
    return rows.select(
        types.normal_text(F.col("o_orderkey"), "Int64").alias("key"),
        types.normal_text(F.nullif(flag, F.lit("P")), "Boolean").alias("flag"),
        types.normal_text(F.col("o_custkey"), "Int16").alias("short"),
        types.normal_text(F.col("o_totalprice"), "Decimal").alias("price"),
        types.normal_text(F.substring("o_orderdate", 1, 10), "Date").alias("day"),
        types.normal_text(F.col("o_orderpriority"), "Date").alias("wrong_day"),
        types.normal_text(F.lit("A"), "String").alias("any_text"),
    )


@QUERIES.add(
    "udf_1_extractor",
    "SELECT p_partkey::varchar AS p_partkey, reverse(p_name) || '/' || length(p_brand)::varchar AS made FROM part",
)
def user_function(spark, folder):
    rows = texts(spark, folder, "part", "p_partkey", "p_name", "p_brand")
    step = steps.extractor(
        lambda row: F.concat(F.reverse(row["p_name"]), F.lit("/"), F.length(row["p_brand"]).cast("string"))
    )
    return rows.select("p_partkey", run_chain([step], Row(rows.columns)).alias("made"))


@QUERIES.add(
    "udf_2_registry",
    """SELECT p_partkey::varchar AS p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'made by ' || lower(p_brand) END AS made
       FROM part""",
)
def registry(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_brand", (F.col("p_size") > 25).alias("large"))
    rows = text_rows(rows)
    spec = {
        "kind": "BooleanContainsTransform",
        "column": "large",
        "text": "true",
        "transformsIfTrue": [{"kind": "ValueTransform", "value": "large"}],
        "transformsIfFalse": [
            {"kind": "ColumnTransform", "column": "p_brand"},
            {"kind": "CaseTransform", "type": "lower"},
            {"kind": "PrefixTransform", "prefix": "made by "},
        ],
    }
    made = run_chain([steps.step_from(spec)], Row(rows.columns))
    return rows.select("p_partkey", made.alias("made"))
