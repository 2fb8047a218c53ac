"""Queries for dates and times: texts made from a timestamp, parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import times
from graphloom.queries.shared import Registered, sql_iso, table

QUERIES = Registered()

_ZONE = "America/Los_Angeles"
_US, _DAY_FIRST, _WITH_OFFSET = "MM/dd/yy HH:mm", "dd.MM.yyyy HH:mm", "yyyy-MM-dd HH:mm:ss.SSS XXX"
_PATTERNS = [_US, _DAY_FIRST, _WITH_OFFSET]

# Events, every other one half a year later, so that there are winter and summer times.
_SEASONS_SQL = """(SELECT event_id, event_type, ts + CASE WHEN event_id % 2 = 1 THEN interval 182 day ELSE interval 0 day END AS ts
  FROM events)"""
# Minutes of events with a text that differs by event type; errors have no time.
_TEXTS_SQL = f"""(SELECT event_id, event_type, date_trunc('minute', ts) AS minute, date_trunc('millisecond', ts) AS ms,
  event_type IN ('view', 'click') AS zoneless FROM {_SEASONS_SQL}) written"""
_OFFSET_SQL = (
    "(CASE WHEN timezone('UTC', timezone('America/Los_Angeles', {0})) - {0} = interval 7 hour "
    "THEN '-07:00' ELSE '-08:00' END)"
)


def _written(spark, folder):
    """Events with their time as text: two patterns without zone, one with, ISO, and junk."""
    summer = F.when(F.col("event_id") % 2 == 1, F.expr("interval 182 days")).otherwise(F.expr("interval 0 days"))
    ts, kind = F.col("ts") + summer, F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.when(kind == "view", F.date_format(ts, _US))
        .when(kind == "click", F.date_format(ts, _DAY_FIRST))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" +05:30")))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise("NULL")
        .alias("text"),
    )


@QUERIES.add(
    "fn_15_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered,
              CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS mixed, NULL::varchar AS bad
       FROM orders""",
)
def date(spark, folder):
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    mixed = (
        F.when(status == "F", F.date_format(day, "MM-dd-yy"))
        .when(status == "O", F.date_format(day, "MM/dd/yy"))
        .otherwise(F.date_format(day, "yyyy"))
    )
    patterns = ["MM/dd/yy", "MM-dd-yy"]
    return table(spark, folder, "orders").select(
        "o_orderkey",
        times.date_text(F.date_format(day, "MM/dd/yy"), patterns).alias("ordered"),
        times.date_text(mixed, patterns).alias("mixed"),
        times.date_text(F.col("o_orderpriority"), patterns).alias("bad"),
    )


@QUERIES.add(
    "fn_16_datetime",
    f"""SELECT event_id, CASE WHEN zoneless THEN {sql_iso('minute', _OFFSET_SQL.format('minute'))}
          WHEN event_type = 'purchase' THEN {sql_iso('ms', "'+05:30'")}
          WHEN event_type = 'signup' THEN full_iso END AS made
        FROM {_TEXTS_SQL} JOIN (SELECT event_id, {sql_iso('ts')} AS full_iso FROM {_SEASONS_SQL}) USING (event_id)""",
)
def datetime(spark, folder):
    rows = _written(spark, folder)
    return rows.select("event_id", times.datetime_text(F.col("text"), _PATTERNS, _ZONE).alias("made"))


@QUERIES.add(
    "fn_17_shift_offset",
    f"""SELECT o_orderkey, strftime(t, '%Y-%m-%dT%H:%M') || {_OFFSET_SQL.format('t')} AS shifted
        FROM (SELECT o_orderkey, o_orderdate + interval 10 hour AS t FROM orders)""",
)
def shift_offset(spark, folder):
    at_ten = F.col("o_orderdate") + F.expr("interval 10 hours")
    given = F.concat(F.date_format(at_ten, "MM/dd/yy HH:mm"), F.lit("-00:00"))
    made = times.shift_offset(given, ["MM/dd/yy HH:mmXXX"], _ZONE)
    return table(spark, folder, "orders").select("o_orderkey", made.alias("shifted"))


@QUERIES.add(
    "fn_18_shift_zone",
    """SELECT o_orderkey, strftime(w, '%Y-%m-%dT%H:%M') || CASE WHEN t - w = interval 7 hour THEN '-07:00' ELSE '-08:00' END AS shifted
       FROM (SELECT o_orderkey, t, timezone('America/Los_Angeles', timezone('UTC', t)) AS w
             FROM (SELECT o_orderkey, o_orderdate + interval 10 hour AS t FROM orders))""",
)
def shift_zone(spark, folder):
    at_noon = F.col("o_orderdate") + F.expr("interval 12 hours")
    given = F.concat(F.date_format(at_noon, "MM/dd/yy HH:mm"), F.lit("+02:00"))
    made = times.shift_zone(given, ["MM/dd/yy HH:mmXXX"], _ZONE)
    return table(spark, folder, "orders").select("o_orderkey", made.alias("shifted"))


@QUERIES.add(
    "fn_24_local_datetime",
    f"""SELECT event_id, CASE WHEN zoneless THEN strftime(minute, '%Y-%m-%dT%H:%M:00.000') || {_OFFSET_SQL.format('minute')}
          WHEN event_type = 'purchase' THEN strftime(ms, '%Y-%m-%dT%H:%M:%S.%g') || {_OFFSET_SQL.format('ms')} END AS made
        FROM {_TEXTS_SQL}""",
)
def local_datetime(spark, folder):
    rows = _written(spark, folder)
    return rows.select("event_id", times.parse_local_datetime(F.col("text"), _PATTERNS, _ZONE).alias("made"))


@QUERIES.add(
    "fn_25_local_time",
    f"""SELECT event_id, CASE WHEN zoneless THEN strftime(minute, '%H:%M:00.000')
          WHEN event_type = 'purchase' THEN strftime(ms, '%H:%M:%S.%g') END AS made FROM {_TEXTS_SQL}""",
)
def local_time(spark, folder):
    rows = _written(spark, folder)
    return rows.select("event_id", times.parse_local_time(F.col("text"), _PATTERNS).alias("made"))


@QUERIES.add(
    "fn_26_local_date",
    f"""SELECT event_id, CASE WHEN event_type NOT IN ('signup', 'error') THEN strftime(minute, '%Y-%m-%d') END AS made
        FROM {_TEXTS_SQL}""",
)
def local_date(spark, folder):
    rows = _written(spark, folder)
    return rows.select("event_id", times.parse_local_date(F.col("text"), _PATTERNS).cast("string").alias("made"))
