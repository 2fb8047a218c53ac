"""Ids that came with the data: filters of keys, and lookups at the cost of a batch's keys."""

import random

from pyspark.sql import functions as F

from graphloom.operators import ids
from graphloom.operators.key_filters import filter_of, kept_by, marked, met, united
from graphloom.sinks.store import Store

KEYS = "entity_set string, entity_id string"


def keys(spark, numbers, entity_set="users"):
    return spark.createDataFrame([(entity_set, str(n)) for n in numbers], KEYS)


def given(spark, numbers, mark):
    return keys(spark, numbers).withColumn("key_id", F.concat(F.lit(mark), "entity_id"))


def test_a_filter_never_misses_a_key(spark):
    held = filter_of(keys(spark, range(3000)), ids.KEY)
    found = {int(r.entity_id): r.m for r in marked(keys(spark, range(6000)), ids.KEY, held, "m").collect()}
    assert len(found) == 6000 and all(found[n] for n in range(3000))
    assert sum(found[n] for n in range(3000, 6000)) < 10
    # The same text in another set is another key, and a null is a key that is held or not as any other.
    assert kept_by(keys(spark, range(3000), "things"), ids.KEY, held).count() < 10
    odd = spark.createDataFrame([("users", None), (None, None), ("", "")], KEYS)
    assert marked(odd, ids.KEY, filter_of(odd, ids.KEY), "m").where("m").count() == 3
    assert marked(odd, ids.KEY, filter_of(odd.limit(0), ids.KEY), "m").where("m").count() == 0


def test_filters_of_parts(spark):
    parts = keys(spark, range(400)).withColumn("file", F.concat(F.lit("f"), (F.col("entity_id").cast("int") / 10).cast("int")))
    each = filter_of(parts, ids.KEY, "file")
    asked = filter_of(keys(spark, [25, 26, 333, 9999]), ids.KEY)
    files = {r.file for r in met(each, asked, "file").collect()}
    assert {"f2", "f33"} <= files and len(files) <= 4
    whole = {(r.slice, bytes(r.bits)) for r in united(each).collect()}
    assert whole == {(r.slice, bytes(r.bits)) for r in filter_of(parts, ids.KEY).collect()}


def test_few_ids_equal_a_join_with_all(spark):
    rng = random.Random(4)
    values = keys(spark, [rng.randrange(50) for _ in range(300)] + [7] * 200).withColumn("value", F.lit("v"))
    few = given(spark, [7, 8, 9, 70], "g")
    shown = lambda df: sorted(tuple(r) for r in df.select("entity_set", "entity_id", "value", "key_id").collect())
    assert shown(ids.with_few_ids(values, few)) == shown(ids.with_ids(values, few))
    edges = spark.createDataFrame(
        [("e", str(i), "users", str(i % 12), "users", str(i % 7)) for i in range(60)],
        "edge_set string, edge_id string, src_set string, src_id string, dst_set string, dst_id string")
    made, plain = ids.edges_with_few_ids(edges, few), ids.edge_ids(edges, few)
    assert sorted(made.collect()) == sorted(plain.select(*made.columns).collect()) and made.count() == 60


def test_the_first_origin_wins_and_only_asked_keys_are_grouped(spark):
    asked = filter_of(keys(spark, [1, 2, 3, 4]), ids.KEY)
    sources = [(ids.REGISTERED, given(spark, range(1000), "r")), (ids.KNOWN, given(spark, [1, 1, 500], "k")),
               (ids.GIVEN, given(spark, [1, 2], "g"))]
    found = ids.ids_of_keys(asked, sources)
    assert {r.entity_id: (r.key_id, r.origin) for r in found.collect() if int(r.entity_id) < 5} == {
        "1": ("k1", ids.KNOWN), "2": ("g2", ids.GIVEN), "3": ("r3", ids.REGISTERED), "4": ("r4", ids.REGISTERED)}
    assert found.count() < 10


def test_a_batch_opens_only_files_that_may_hold_its_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], "entity_set string, key_id string, property string, value string, content binary")
    for batch in range(8):
        numbers = range(100 * batch, 100 * batch + 100)
        store.write(2 * batch + 1, none, given_ids=given(spark, numbers, f"b{batch}-"))
    asked = filter_of(keys(spark, [305, 306, 5000]), ids.KEY)
    found = store.given_ids_of(asked, 100)
    assert {f.split("attempt=")[1][:32] for f in found.inputFiles()} == {store._commits.last().batches[3].attempt}
    assert {r.key_id for r in found.collect()} >= {"b3-305", "b3-306"} and found.count() <= 4
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    # Batches that came later don't count, and after a merge the ids are found as before.
    assert not {r.key_id for r in store.given_ids_of(asked, 5).collect()} & {"b3-305", "b3-306"}
    store.compact()
    store.remove_dead()
    assert {r.key_id for r in store.given_ids_of(asked, 100).collect()} >= {"b3-305", "b3-306"}
