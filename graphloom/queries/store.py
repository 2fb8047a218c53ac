"""Queries for versioned updates, sinks and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from graphloom.functions.text import base64_text
from graphloom.functions.times import utc_text
from graphloom.operators import ids, update
from graphloom.plans.catalog import Catalog, EntitySet, EntityType, PropertyType
from graphloom.plans.mapping import Entity, Mapping, prop
from graphloom.queries.entities import (
    GIVEN_IDS,
    GIVEN_IDS_CATALOG,
    GIVEN_IDS_SQL,
    RESIDENCE,
    RESIDENCE_CATALOG,
    _USERS,
    _USERS_CATALOG,
    given_id_rows,
    residence_rows,
)
from graphloom.queries.shared import Registered, sql_base64, sql_iso, sql_key_id, table
from graphloom.sinks.binaries import read_binaries, write_binaries
from graphloom.sinks.store import Store
from graphloom.sinks.targets import log_rows, read_log, write_nothing, write_target
from graphloom.sources.rows import as_utc
from graphloom.sources.scratch import shared_folder
from graphloom.streaming.ingest import integrate, stream_into

QUERIES = Registered()


def _long(orders, status, priority):
    """Values (entity_set, entity_id, property, value, content) of orders; null values are left out."""
    pairs = [F.struct(F.lit(n).alias("property"), c.alias("value")) for n, c in (("status", status), ("priority", priority))]
    rows = orders.select(
        F.lit("orders").alias("entity_set"),
        base64_text(F.col("o_orderkey").cast("string").cast("binary")).alias("entity_id"),
        F.explode(F.array(*pairs)).alias("p"),
    )
    rows = rows.select("entity_set", "entity_id", "p.*", F.lit(None).cast("binary").alias("content"))
    return ids.with_ids(rows.where("value is not null"))


def _first(spark, folder):
    """All orders: status and priority."""
    orders = table(spark, folder, "orders")
    return _long(orders, F.col("o_orderstatus"), F.col("o_orderpriority"))


def _second(spark, folder):
    """Filled orders with a new status and the same priority; open ones with the same status alone."""
    orders = table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    filled = F.col("o_orderstatus") == "F"
    return _long(orders, F.when(filled, "CLOSED").otherwise("O"), F.when(filled, F.col("o_orderpriority")))


def _updated(spark, folder, kind, unversioned=()):
    state = update.state_of(update.incoming_rows(_first(spark, folder), 100))
    return update.update(state, _second(spark, folder), 200, {"orders": kind}, unversioned)


def _shown(state):
    versions = F.array_join(F.transform("versions", lambda v: v.cast("string")), ",").alias("versions")
    return state.select("key_id", "property", "value", "version", versions)


_K = sql_key_id("orders", sql_base64("o_orderkey"))


def _updated_sql(open_status, open_priority, filled_status, filled_priority):
    """State as SQL: the versions of the values that the second batch may touch."""
    return f"""SELECT key_id, property, value, string_split(versions, ',')[-1]::bigint AS version, versions FROM (
      SELECT {_K} AS key_id, 'status' AS property, o_orderstatus AS value,
             CASE o_orderstatus WHEN 'O' THEN '{open_status}' WHEN 'F' THEN '{filled_status}' ELSE '101' END AS versions FROM orders
      UNION ALL SELECT {_K}, 'priority', o_orderpriority,
             CASE o_orderstatus WHEN 'O' THEN '{open_priority}' WHEN 'F' THEN '{filled_priority}' ELSE '101' END FROM orders
      UNION ALL SELECT {_K}, 'status', 'CLOSED', '201' FROM orders WHERE o_orderstatus = 'F')"""


_MERGED_SQL = _updated_sql("101,201", "101", "101", "101,201")
_REPLACED_SQL = _updated_sql("101,-200,201", "101,-200", "101,-200", "101,-200,201")
_PARTIAL_SQL = _updated_sql("101,-200,201", "101", "101,-200", "101,-200,201")


@QUERIES.add("upd_1_merge", _MERGED_SQL)
def merge(spark, folder):
    return _shown(_updated(spark, folder, "Merge"))


@QUERIES.add("upd_2_replace", _REPLACED_SQL)
def replace_all(spark, folder):
    return _shown(_updated(spark, folder, "Replace"))


@QUERIES.add("upd_3_partial_replace", _PARTIAL_SQL)
def replace_some(spark, folder):
    return _shown(_updated(spark, folder, "PartialReplace"))


@QUERIES.add(
    "upd_4_tombstones",
    f"""SELECT {_K} AS key_id, 'status' AS property, o_orderstatus AS value, (-200)::bigint AS version FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT {_K}, 'priority', o_orderpriority, -200 FROM orders WHERE o_orderstatus <> 'P'""",
)
def tombstones(spark, folder):
    log = update.incoming_rows(_first(spark, folder), 100)
    touched = _second(spark, folder).select("entity_set", "key_id")
    return update.tombstones(log, touched, 200).select("key_id", "property", "value", "version")


@QUERIES.add(
    "upd_5_unversioned",
    f"SELECT key_id, property, value, version, version::varchar AS versions FROM ({_REPLACED_SQL})",
)
def unversioned(spark, folder):
    return _shown(_updated(spark, folder, "Replace", ["orders"]))


@QUERIES.add(
    "upd_6_current",
    f"SELECT key_id, property, value, version FROM ({_REPLACED_SQL}) WHERE version > 0",
)
def current(spark, folder):
    return update.current(_updated(spark, folder, "Replace")).select("key_id", "property", "value", "version")


def _store(spark, name):
    return Store(spark, shared_folder(spark, name))


@QUERIES.add("snk_1_property_upsert", _REPLACED_SQL)
def property_upsert(spark, folder):
    store = _store(spark, "orders-store")
    store.write(100, _first(spark, folder))
    store.write(200, _second(spark, folder), update_types={"orders": "Replace"})
    return _shown(store.state())


_RC, _RN = sql_base64("c_custkey"), sql_base64("n_nationkey")
_RL = sql_base64("(c_custkey::varchar || '-' || n_nationkey::varchar)")


@QUERIES.add(
    "snk_2_edge_upsert",
    f"""SELECT {sql_key_id('lives_in', _RL)} AS edge_key_id, {sql_key_id('customers', _RC)} AS src_key_id,
               {sql_key_id('nations', _RN)} AS dst_key_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 21 ELSE 11 END::bigint AS version
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def edge_upsert(spark, folder):
    store = _store(spark, "residence-store")
    rows = residence_rows(spark, folder)
    integrate(rows, RESIDENCE, RESIDENCE_CATALOG, store, 10)
    integrate(rows.where("c_mktsegment = 'BUILDING'"), RESIDENCE, RESIDENCE_CATALOG, store, 20)
    return store.edges().select("edge_key_id", "src_key_id", "dst_key_id", "version")


@QUERIES.add(
    "snk_3_entity_commit",
    f"SELECT 'orders' AS entity_set, {_K} AS key_id, CASE WHEN o_orderstatus = 'P' THEN 101 ELSE 201 END::bigint AS version FROM orders",
)
def entity_commit(spark, folder):
    store = _store(spark, "commit-store")
    store.write(100, _first(spark, folder))
    store.write(200, _second(spark, folder))
    return store.entities()


@QUERIES.add(
    "snk_4_binaries",
    f"""SELECT lang AS entity_set, {_K.replace("'orders'", "lang").replace('o_orderkey', 'doc_id')} AS key_id, sha256(text) AS hash,
               strlen(text)::int AS bytes FROM documents""",
)
def binaries(spark, folder):
    documents = table(spark, folder, "documents").select(
        F.col("lang").alias("entity_set"),
        base64_text(F.col("doc_id").cast("string").cast("binary")).alias("entity_id"),
        F.lit("body").alias("property"),
        F.encode("text", "UTF-8").alias("content"),
    )
    path = shared_folder(spark, "binaries")
    write_binaries(ids.with_ids(documents), path)
    return read_binaries(spark, path).select("entity_set", "key_id", "hash", F.length("content").alias("bytes"))


@QUERIES.add(
    "snk_5_no_op",
    "SELECT l_returnflag, count(*) AS rows, 0 AS written FROM lineitem GROUP BY l_returnflag",
)
def no_op(spark, folder):
    rows = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("rows"))
    return rows.withColumn("written", F.lit(write_nothing(rows)))


@QUERIES.add(
    "snk_6_run_log",
    f"""SELECT user_id::varchar AS job_id, 'events' AS name, unnest(list_distinct([event_type, props, event_type])) AS line,
              {sql_iso('ts')} AS time_logged, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status
       FROM events""",
)
def run_log(spark, folder):
    events = table(spark, folder, "events")
    status = F.when(F.col("event_type") == "error", "FAILED").otherwise("IN_PROGRESS")
    columns = log_rows(
        F.col("user_id"), F.lit("events"), F.array("event_type", "props", "event_type"), as_utc(F.col("ts")), status)
    path = shared_folder(spark, "run-log")
    events.select(*columns).write.mode("append").parquet(path)
    return read_log(spark, path).select(
        "job_id", "name", F.explode("log").alias("line"),
        utc_text(F.col("time_logged")).alias("time_logged"), "status")


@QUERIES.add(
    "snk_7_targets",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'AURORA' ELSE 'POSTGRES' END AS store, o_orderkey FROM orders""",
)
def targets(spark, folder):
    config = {"aurora": {"path": shared_folder(spark, "aurora")}, "postgres": {"path": shared_folder(spark, "postgres")}}
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    filled = F.col("o_orderstatus") == "F"
    write_target(orders.where(filled).select("o_orderkey"), "AURORA", config)
    write_target(orders.where(~filled).select("o_orderkey"), "POSTGRES", config)
    write_target(orders, "NONE", config)
    read = [spark.read.parquet(config[s.lower()]["path"]).select(F.lit(s).alias("store"), "o_orderkey") for s in ("AURORA", "POSTGRES")]
    return read[0].unionByName(read[1])


_USERS_SQL = f"""SELECT DISTINCT {sql_key_id('users', sql_base64('user_id'))} AS key_id, property, value
  FROM (SELECT user_id, unnest(['user.key', 'user.did', 'user.note']) AS property, unnest([user_id::varchar, event_type, props]) AS value
        FROM events)"""


@QUERIES.add("str_1_ingest", _USERS_SQL)
def ingest(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type", "props")
    path = shared_folder(spark, "events-files")
    # As many files as event types, so that the stream takes more than one batch.
    events.write.partitionBy("event_type").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(path)
    store = _store(spark, "users-store")
    query = stream_into(stream, _USERS, _USERS_CATALOG, store, shared_folder(spark, "users-progress"))
    query.awaitTermination()
    return store.current().select("key_id", "property", "value")


@QUERIES.add(
    "str_2_replay",
    f"SELECT key_id, property, value, 3::bigint AS version, '3' AS versions FROM ({_USERS_SQL})",
)
def replay(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type", "props")
    store = _store(spark, "replay-store")
    for _ in range(2):
        integrate(events, _USERS, _USERS_CATALOG, store, 2)
    return _shown(store.state())


_SCORES_CATALOG = Catalog.of(
    [PropertyType("event.key", "Int64"), PropertyType("event.score", "Int32"), PropertyType("event.day", "Date")],
    [EntityType("event", ("event.key",), ("event.key", "event.score", "event.day"))],
    [EntitySet("events", "event")],
)
_SCORES = Mapping("events", (Entity("event", "events", (
    prop("event.key", "event_id"), prop("event.score", "score"), prop("event.day", "day"))),))


@QUERIES.add(
    "str_1_rejects",
    """SELECT 'rejected' AS outcome, 'event.score' AS property, event_type || event_id::varchar AS value FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'rejected', 'event.day', 'someday' FROM events WHERE event_type = 'click'
       UNION ALL SELECT 'kept', 'event.score', event_id::varchar FROM events WHERE event_type <> 'error'
       UNION ALL SELECT 'kept', 'event.day', strftime(ts, '%Y-%m-%d') FROM events WHERE event_type <> 'click'
       UNION ALL SELECT 'kept', 'event.key', event_id::varchar FROM events""",
)
def rejected(spark, folder):
    events, kind, number = table(spark, folder, "events"), F.col("event_type"), F.col("event_id").cast("string")
    rows = events.select(
        number.alias("event_id"),
        F.when(kind == "error", F.concat(kind, number)).otherwise(number).alias("score"),
        F.when(kind == "click", "someday").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"))
    store = _store(spark, "scores-store")
    integrate(rows, _SCORES, _SCORES_CATALOG, store, 1, on_bad_value="reject", shown=["event_id"])
    kept = store.current().select(F.lit("kept").alias("outcome"), "property", "value")
    return kept.unionByName(store.rejects().select(F.lit("rejected").alias("outcome"), "property", "value"))


@QUERIES.add(
    "upd_5_ingest_unversioned",
    f"""SELECT key_id, property, value, 21::bigint AS version, '21' AS versions FROM ({_USERS_SQL})""",
)
def ingest_unversioned(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type", "props")
    alone = replace(_USERS, entities=tuple(replace(e, property_update_type="Unversioned") for e in _USERS.entities))
    store = _store(spark, "unversioned-store")
    for version in (10, 20):
        integrate(events, alone, _USERS_CATALOG, store, version)
    return _shown(store.state())


@QUERIES.add("str_3_given_ids", GIVEN_IDS_SQL)
def given_ids(spark, folder):
    # Ids come with the filled orders, in the first batch only; the keys keep them in the second.
    rows, store = given_id_rows(spark, folder), _store(spark, "given-store")
    for version, filled in ((1, True), (3, False)):
        integrate(rows.where((F.col("o_orderstatus") == "F") == filled), GIVEN_IDS, GIVEN_IDS_CATALOG, store, version)
    return store.current().select("entity_set", "key_id", "property", "value")


@QUERIES.add("str_3_given_ids_streamed", GIVEN_IDS_SQL)
def given_ids_streamed(spark, folder):
    # The filled orders, which bring ids, come first. The rest come when the stream is started again.
    rows, store = given_id_rows(spark, folder), _store(spark, "given-stream-store")
    path, progress = shared_folder(spark, "given-files"), shared_folder(spark, "given-progress")
    for filled in (True, False):
        part = rows.where((F.col("o_orderstatus") == "F") == filled)
        part.repartition(2, "o_custkey").write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        stream_into(stream, GIVEN_IDS, GIVEN_IDS_CATALOG, store, progress).awaitTermination()
    return store.current().select("entity_set", "key_id", "property", "value")


@QUERIES.add("snk_8_compaction", f"SELECT * FROM ({_REPLACED_SQL}) UNION ALL SELECT 'k', 'status', 'NEW', 203, '203'")
def compaction(spark, folder):
    store = _store(spark, "compacted-store")
    store.write(100, _first(spark, folder))
    store.compact()
    store.write(200, _second(spark, folder), update_types={"orders": "Replace"})
    store.compact()
    store.compact()
    # A batch after two compactions: nothing of those before is lost.
    store.write(202, spark.createDataFrame([("orders", "k", "status", "NEW", None)], _VALUES))
    store.remove_dead()
    return _shown(store.state())


_VALUES = "entity_set string, key_id string, property string, value string, content binary"
_URGENT = "o_orderpriority = '1-URGENT'"


@QUERIES.add(
    "upd_2_replace_pruned",
    f"""SELECT key_id, property, value, string_split(versions, ',')[-1]::bigint AS version, versions FROM (
      SELECT {_K} AS key_id, unnest(['status', 'priority']) AS property, unnest([o_orderstatus, o_orderpriority]) AS value,
             (CASE o_orderstatus WHEN 'F' THEN 101 WHEN 'O' THEN 201 ELSE 301 END)::varchar || CASE WHEN {_URGENT} THEN ',-400' ELSE '' END AS versions
      FROM orders
      UNION ALL SELECT {_K}, 'status', 'HELD', '401' FROM orders WHERE {_URGENT})""",
)
def replace_pruned(spark, folder):
    # Three batches, and a replace of some of their keys that opens the files which may hold these.
    store, first = _store(spark, "pruned-store"), table(spark, folder, "orders")
    for version, status in ((100, "F"), (200, "O"), (300, "P")):
        own = first.where(F.col("o_orderstatus") == status)
        store.write(version, _long(own, F.col("o_orderstatus"), F.col("o_orderpriority")))
    held = _long(first.where(_URGENT), F.lit("HELD"), F.lit(None).cast("string"))
    store.write(400, held, update_types={"orders": "Replace"})
    return _shown(store.state())


@QUERIES.add(
    "upd_6_as_of",
    f"""SELECT 100 AS as_of, {_K} AS key_id, unnest(['status', 'priority']) AS property, unnest([o_orderstatus, o_orderpriority]) AS value, 101::bigint AS version FROM orders
        UNION ALL SELECT 200, key_id, property, value, version FROM ({_REPLACED_SQL}) WHERE version > 0
        UNION ALL SELECT 300, {_K}, unnest(['status', 'priority']), unnest([o_orderstatus, o_orderpriority]), 301 FROM orders
        UNION ALL SELECT 300, {_K}, 'status', 'CLOSED', 201 FROM orders WHERE o_orderstatus = 'F'""",
)
def current_as_of(spark, folder):
    # The first view is a snapshot, the second one is patched by a batch, and the third by two that were merged.
    store = _store(spark, "views-store")
    store.write(100, _first(spark, folder))
    store.snapshot()
    store.write(200, _second(spark, folder), update_types={"orders": "Replace"})
    store.write(300, _first(spark, folder))
    store.compact()
    views = [store.current(as_of=v).select(F.lit(v).alias("as_of"), "key_id", "property", "value", "version") for v in (100, 200, 300)]
    return views[0].unionByName(views[1]).unionByName(views[2])


@QUERIES.add(
    "agg_3_totals",
    """SELECT counted, name, exact, true AS near FROM (
         SELECT 'entities' AS counted, 'customers' AS name, count(DISTINCT c_custkey) AS exact FROM customer JOIN nation ON c_nationkey = n_nationkey
         UNION ALL SELECT 'entities', 'nations', count(DISTINCT n_nationkey) FROM customer JOIN nation ON c_nationkey = n_nationkey
         UNION ALL SELECT unnest(['entities', 'edges']), 'lives_in', count(DISTINCT (c_custkey, n_nationkey)) FROM customer JOIN nation ON c_nationkey = n_nationkey)
       WHERE exact > 0""",
)
def totals(spark, folder):
    # Two batches, of which the second brings rows of the first again, merged into one: sketches against exact counts.
    store, rows = _store(spark, "totals-store"), residence_rows(spark, folder)
    integrate(rows, RESIDENCE, RESIDENCE_CATALOG, store, 10)
    integrate(rows.where("c_mktsegment = 'BUILDING'"), RESIDENCE, RESIDENCE_CATALOG, store, 20)
    store.compact()
    exact = store.entities().groupBy(F.lit("entities").alias("counted"), F.col("entity_set").alias("name")).agg(F.count("*").alias("exact"))
    exact = exact.unionByName(
        store.edges().groupBy(F.lit("edges").alias("counted"), F.col("edge_set").alias("name")).agg(F.count("*").alias("exact")))
    near = F.abs(F.col("distinct") - F.col("exact")) <= 0.02 * F.col("exact")
    return store.totals().join(exact, ["counted", "name"], "full").select("counted", "name", "exact", F.coalesce(near, F.lit(False)).alias("near"))


@QUERIES.add("str_1_tiers", f"SELECT *, true AS few_batches FROM ({_USERS_SQL})")
def tiers(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type", "props")
    path = shared_folder(spark, "forty-files")
    events.repartition(40).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    store = _store(spark, "tiers-store")
    stream_into(stream, _USERS, _USERS_CATALOG, store, shared_folder(spark, "tiers-progress")).awaitTermination()
    return store.current().select("key_id", "property", "value", F.lit(len(store.live()) <= 8).alias("few_batches"))
