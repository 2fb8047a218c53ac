"""Versioned updates against a plain model, the store, sinks, streams and hot keys."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph, ids, update
from graphloom.plans.catalog import Catalog, EntitySet, EntityType, PropertyType
from graphloom.plans.mapping import BINARIES, TABLES, Association, Entity, Mapping, prop
from graphloom.sinks.binaries import binary_rows, read_binaries, write_binaries
from graphloom.sinks.commits import as_runs, in_runs
from graphloom.sinks.store import Store
from graphloom.sinks.targets import append_log, read_log, target_options, write_nothing, write_target
from graphloom.sources.scratch import create_text, discard, read_text, shared_folder
from graphloom.streaming.ingest import integrate, run_all, stream_into

VALUES = "entity_set string, key_id string, property string, value string, content binary"


def frame(spark, values):
    return spark.createDataFrame([(*v, None) for v in values], VALUES)


def model(state, batch, version, kinds):
    """The state after an update, value by value: {(set, key, property, value): versions}."""
    state = {k: list(v) for k, v in state.items()}
    touched = {"Replace": {v[:2] for v in batch}, "PartialReplace": {v[:3] for v in batch}}
    for key, versions in state.items():
        kind = kinds.get(key[0], "Merge")
        scope = key[:2] if kind == "Replace" else key[:3]
        if kind != "Merge" and scope in touched[kind] and versions[-1] > 0:
            versions.append(-version)
    for key in set(batch):
        state.setdefault(key, []).append(version + 1)
    return state


def shown(state):
    return {(r.entity_set, r.key_id, r.property, r.value): list(r.versions) for r in state.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_updates_follow_the_model(spark, seed):
    rng = random.Random(seed)
    kinds = {"m": "Merge", "r": "Replace", "p": "PartialReplace"}
    expected, state = {}, spark.createDataFrame([], update.LOG_SCHEMA)
    log = state
    for version in (10, 20, 30):
        batch = [
            (rng.choice("mrp"), rng.choice("ab"), rng.choice(["x", "y"]), rng.choice(["1", "2", "3"]))
            for _ in range(rng.randint(1, 12))
        ]
        expected = model(expected, batch, version, kinds)
        state = update.update(state, frame(spark, batch), version, kinds)
        rows = state.collect()
        assert {(r.entity_set, r.key_id, r.property, r.value): list(r.versions) for r in rows} == expected
        assert all(r.version == r.versions[-1] for r in rows)
        # The same by way of an append-only log.
        added = update.changes(log, frame(spark, batch), version, kinds)
        log = spark.createDataFrame(log.unionByName(added).collect(), update.LOG_SCHEMA)
        assert shown(update.state_of(log)) == expected
        state = spark.createDataFrame(rows, update.LOG_SCHEMA)
    alive = {k for k, versions in expected.items() if versions[-1] > 0}
    assert {(r.entity_set, r.key_id, r.property, r.value) for r in update.current(log).collect()} == alive


def test_unversioned_sets_keep_the_last_version(spark):
    log = update.incoming_rows(frame(spark, [("a", "k", "p", "1"), ("b", "k", "p", "1")]), 10)
    state = update.update(log, frame(spark, [("a", "k", "p", "1"), ("b", "k", "p", "1")]), 20, {}, ["a"])
    assert shown(state) == {("a", "k", "p", "1"): [21], ("b", "k", "p", "1"): [11, 21]}


def test_value_hash_tells_values_apart(spark):
    rows = update.incoming_rows(frame(spark, [("a", "k", "p", "1"), ("a", "k", "p", "1"), ("a", "k", "p", "2")]), 1).collect()
    assert {bytes(r.value_hash) for r in rows} == {hashlib.sha256(v).digest() for v in (b"1", b"2")}


def test_joins_are_planned_without_a_job(spark):
    """Hot keys are left to adaptive execution: nothing runs before the result is asked for."""
    rows = spark.range(9_000).select(
        F.lit("s").alias("entity_set"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 3000).cast("string")).alias("entity_id"),
        F.lit("p").alias("property"), F.col("id").cast("string").alias("value"), F.lit(None).cast("binary").alias("content"))
    registry = spark.createDataFrame([("s", "hot", "given"), ("s", "1", "one")], "entity_set string, entity_id string, key_id string")
    spark.sparkContext.setJobGroup("planning", "joins")
    joined = ids.assign_ids(rows, registry)
    edges = rows.select(*[c.alias(f"{e}_{n}") for e in ("edge", "src", "dst") for n, c in (("set", F.col("entity_set")), ("id", F.col("entity_id")))])
    with_ends = ids.edge_ids(edges, registry)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup(None, None)
    assert joined.where("key_id = 'given'").count() == 3_000 and joined.count() == 9_000
    assert with_ends.where("src_key_id = 'given' and dst_key_id = 'given' and edge_key_id = 'given'").count() == 1
    assert with_ends.count() == 2_001


CATALOG = Catalog.of(
    [PropertyType(n) for n in ("u.k", "u.did", "t.k", "d.k")],
    [EntityType("user", ("u.k",), ("u.k", "u.did")), EntityType("thing", ("t.k",), ("t.k",)),
     EntityType("did", ("d.k",), ("d.k",))],
    [EntitySet("users", "user"), EntitySet("things", "thing"), EntitySet("does", "did")],
)
MAPPING = Mapping(
    "events",
    (Entity("user", "users", (prop("u.k", "user"), prop("u.did", "did")), update_type="Replace"),
     Entity("thing", "things", (prop("t.k", "did"),), associate_only=True)),
    (Association("does", "does", (prop("d.k", lambda row: F.concat(row["user"], row["did"])),),
                 src="user", dst="thing"),),
)
EVENTS = "user string, did string"


def test_integrate_and_replay(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    first = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], EVENTS)
    integrate(first, MAPPING, CATALOG, store, 10)
    once = shown(store.state())
    integrate(first, MAPPING, CATALOG, store, 10, stage=True)
    assert shown(store.state()) == once
    second = spark.createDataFrame([("1", "c")], EVENTS)
    integrate(second, MAPPING, CATALOG, store, 20)
    alive = {(r.entity_set, r.value) for r in store.current().collect()}
    # User 1 is replaced; associate-only things are not written; edges stay.
    assert alive == {("users", "1"), ("users", "c"), ("users", "2"), ("users", "a"), ("does", "1a"), ("does", "1b"),
                     ("does", "2a"), ("does", "1c")}
    assert {r.value: list(r.versions) for r in store.state().where("entity_set = 'users' and value = 'b'").collect()} == {
        "b": [11, -20]}
    assert store.edges().count() == 4
    versions = {r.version for r in store.entities().where("entity_set = 'users'").collect()}
    assert versions == {11, 21}
    # A batch without a commit is not seen.
    store._write(update.incoming_rows(frame(spark, [("users", "k", "u.did", "lost")]), 30), "values", "cut-short")
    assert not store.state().where("value = 'lost'").count()
    for bad in (0, 19, 21):
        with pytest.raises(ValueError):
            store.write(bad, frame(spark, []))
    before = shown(store.state()), store.edges().count(), sorted(map(str, store.entities().collect()))
    assert store.compact() and store.remove_dead() > 0
    again = Store(spark, str(tmp_path / "store"))
    assert (shown(again.state()), again.edges().count(), sorted(map(str, again.entities().collect()))) == before
    # What a compaction has taken up is in already; older batches can't come any more.
    assert store.write(10, frame(spark, [])) == {} and shown(store.state()) == before[0]
    with pytest.raises(ValueError, match="merger"):
        store.write(15, frame(spark, []))
    integrate(second.withColumn("did", F.lit("d")), MAPPING, CATALOG, store, 22)
    assert {r.value for r in store.current().where("entity_set = 'users'").collect()} == {"1", "d", "2", "a"}


def test_a_source_is_read_once(spark, tmp_path):
    """Values, edges and rejects are of the same read, also of a source that gives other rows each time."""
    catalog = Catalog.of(
        [PropertyType("u.k"), PropertyType("u.day", "Date"), PropertyType("t.k"), PropertyType("d.k")],
        [EntityType("user", ("u.k",), ("u.k", "u.day")), EntityType("thing", ("t.k",), ("t.k",)), EntityType("did", ("d.k",), ("d.k",))],
        [EntitySet("users", "user"), EntitySet("things", "thing"), EntitySet("does", "did")])
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"), prop("u.day", "user"))), Entity("thing", "things", (prop("t.k", "did"),))),
                      (Association("does", "does", (prop("d.k", "user"),), src="user", dst="thing"),))
    changing = spark.range(40).select(F.expr("uuid()").alias("user"), F.expr("uuid()").alias("did"))
    store = Store(spark, str(tmp_path / "store"))
    integrate(changing, mapping, catalog, store, 1, on_bad_value="reject", shown=["user"])
    keys = {(r.entity_set, r.key_id) for r in store.entities().collect()}
    edges = store.edges().collect()
    assert len(edges) == 40 and len(keys) == 120
    assert {(r.src_set, r.src_key_id) for r in edges} | {(r.dst_set, r.dst_key_id) for r in edges} | {("does", r.edge_key_id) for r in edges} == keys
    users = {r.value for r in store.current().where("property = 'u.k'").collect()}
    assert {(r.row, r.value) for r in store.rejects().collect()} == {(u, u) for u in users}


def test_a_replay_that_fails_leaves_the_first_try(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("1", "a")], EVENTS)
    integrate(rows, MAPPING, CATALOG, store, 10)
    before = shown(store.state()), store.edges().count(), store.entities().count()
    values = frame(spark, [("users", "k", "u.did", "new")])
    broken = store.edges().withColumn("edge_set", F.raise_error(F.lit("lost executor")).cast("string"))
    with pytest.raises(Exception, match="lost executor"):
        store.write(10, values, broken)
    assert (shown(store.state()), store.edges().count(), store.entities().count()) == before
    store.write(10, values)  # a whole second try, without edges
    assert set(shown(store.state())) == {("users", "k", "u.did", "new")} and store.edges().count() == 0


def test_a_replace_opens_only_files_that_may_hold_its_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a store"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "256"}
    before = {k: spark.conf.get(k) for k in conf}
    batches = [[("users of", f"{b}-{i}", "u.did", str(i)) for i in range(1000)] for b in range(4)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for number, batch in enumerate(batches):
            store.write(10 * (number + 1), frame(spark, batch).repartition(4))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = list((tmp_path / "a store" / "values").rglob("*.parquet"))
    assert len(files) > 900
    touched = [("users of", f"{i % 4}-{i * 7}", "u.did", "new") for i in range(100)]
    opened = []
    holding = store.holding
    store.holding = lambda *a: opened.append(holding(*a)) or opened[-1]
    store.write(100, frame(spark, touched), update_types={"users of": "Replace"})
    assert len(opened) == 1 and 50 < len(opened[0]) <= 102 + len(files) // 100
    found = shown(store.state())
    for _, key, _, _ in touched:
        old = key.split("-")
        assert found["users of", key, "u.did", old[1]] == [10 * (int(old[0]) + 1) + 1, -100]
    assert sum(v[-1] < 0 for v in found.values()) == 100 and len(found) == 4100


@pytest.mark.parametrize("after", [2, 4, 5, 6])
def test_no_batch_is_lost_after_compactions(spark, tmp_path, after):
    store = Store(spark, str(tmp_path / "store"))
    for version in (1, 3):
        store.write(version, frame(spark, [("users", f"k{version}", "u.did", "x")]))
    store.compact()
    store.compact()
    more = frame(spark, [("users", "k5", "u.did", "x")])
    if after < 5:
        with pytest.raises(ValueError, match="older|overlaps"):
            store.write(after, more)
    else:
        store.write(after, more)
    store.remove_dead()
    assert {r.key_id for r in store.current().collect()} == {"k1", "k3"} | ({"k5"} if after >= 5 else set())


def test_two_writers(spark, tmp_path):
    """The slower of two stores on one path sees what the faster one wrote, or is refused."""
    path = str(tmp_path / "store")
    slow, fast = Store(spark, path), Store(spark, path)
    slow.write(1, frame(spark, [("users", "k", "u.did", "first")]))
    change = slow._commits.change

    def late(made, version, rows, kinds):
        slow._commits.change = change
        fast.write(version, frame(spark, rows), update_types=kinds)
        return change(made)

    # The faster one adds an older batch: the values that it wrote are ended by the replace as well.
    slow._commits.change = lambda made: late(made, 3, [("users", "k", "u.did", "second")], {})
    slow.write(5, frame(spark, [("users", "k", "u.did", "third")]), update_types={"users": "Replace"})
    expected = {("users", "k", "u.did", "first"): [2, -5], ("users", "k", "u.did", "second"): [4, -5], ("users", "k", "u.did", "third"): [6]}
    assert shown(slow.state()) == shown(fast.state()) == expected
    # The faster one replaces under a later version: the slower one came too late.
    slow._commits.change = lambda made: late(made, 9, [("users", "k", "u.did", "fifth")], {"users": "Replace"})
    with pytest.raises(ValueError, match="has replaced"):
        slow.write(7, frame(spark, [("users", "k", "u.did", "fourth")]))
    assert {r.value for r in Store(spark, path).current().collect()} == {"fifth"}
    # Merging and writing at once: the merger is given up, nothing is lost.
    slow._commits.change = lambda made: late(made, 9, [("users", "k", "u.did", "fifth"), ("users", "l", "u.did", "x")], {"users": "Replace"})
    assert slow.compact() is None
    assert {r.value for r in slow.current().collect()} == {"fifth", "x"} and slow.compact()
    assert {r.value for r in fast.current().collect()} == {"fifth", "x"}


def test_a_commit_is_made_once(spark, tmp_path):
    path = f"{tmp_path}/commits/1.json"
    assert create_text(spark, path, "one") and not create_text(spark, path, "two")
    assert read_text(spark, path) == "one" and [p.name for p in (tmp_path / "commits").glob("[!.]*")] == ["1.json"]
    assert as_runs([1, 3, 5, 7, 20, 21, 22, 40]) == [(1, 7, 2), (20, 22, 1), (40, 40, 1)] and as_runs([]) == []
    for versions in ([1], [1, 3, 5], [1, 2, 9, 11, 13]):
        assert [v for v in range(20) if in_runs(v, as_runs(versions))] == versions


def test_totals_come_from_sketches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    for version, ids_from in ((1, 0), (3, 400), (5, 800), (3, 400)):  # the second batch comes twice
        rows = [("users", f"k{i}", "p", "v", None) for i in range(ids_from, ids_from + 600)] + [("things", "t", "p", str(version), None)]
        content = [("users", f"k{i}", "b", None, b"x") for i in range(ids_from, ids_from + 20)]
        edges = [("e", f"e{i}", "users", f"k{i}", "things", "t") for i in range(ids_from, ids_from + 600)]
        ends = spark.createDataFrame(edges, ", ".join(f"{c} string" for c in ids.EDGE_KEY))
        store.write(version, spark.createDataFrame(rows, VALUES), ends, {"users": "Replace"}, spark.createDataFrame(content, VALUES))

    def totals():
        return {(r.destination, r.counted, r.name): (r.rows, r.distinct) for r in store.totals().collect()}

    found = totals()
    assert {k: n for k, (n, _) in found.items()} == {
        (TABLES, "entities", "users"): 1800, (TABLES, "entities", "things"): 3, (TABLES, "edges", "e"): 1800,
        (BINARIES, "entities", "users"): 60}
    exact = {"users": 1400, "things": 1, "e": 1400}
    for (destination, _, name), (_, distinct) in found.items():
        wanted = 60 if destination == BINARIES else exact[name]
        assert abs(distinct - wanted) <= 0.02 * wanted
    # Neither values nor edges are read for it, and mergers keep it as it is.
    assert all("/totals/" in f for f in store.totals().inputFiles())
    store.compact()
    store.remove_dead()
    assert totals() == found


def test_many_batches_stay_few(spark, tmp_path):
    rng, store, expected = random.Random(5), Store(spark, str(tmp_path / "store")), {}
    kinds = {"m": "Merge", "r": "Replace", "p": "PartialReplace"}
    views = {}
    for number in range(16):
        version = 1 + 2 * number
        batch = [(rng.choice("mrp"), rng.choice("ab"), rng.choice("xy"), str(rng.randint(1, 3))) for _ in range(rng.randint(1, 5))]
        store.write(version, frame(spark, batch), update_types=kinds)
        expected = model(expected, batch, version, kinds)
        views[version] = {k for k, v in expected.items() if v[-1] > 0}
        if number % 2:
            store.tidy()
        assert len(store.live()) <= 8
    assert shown(store.state()) == expected
    store.remove_dead()
    for version in (*random.Random(1).sample(sorted(views), 3), 31):
        rows = store.current(as_of=version).collect()
        assert {(r.entity_set, r.key_id, r.property, r.value) for r in rows} == views[version], version
        assert len(rows) == len(views[version])
    assert len(store.current().collect()) == len(views[31])
    # A snapshot and what came later are all that is read.
    store.snapshot()
    store.write(101, frame(spark, [("m", "c", "x", "9")]))
    read = store.current().inputFiles()
    folders = {f.split("/")[-4 if "entity_set=" in f else -3] for f in read}
    assert folders == {"current", "values"} and len({f.split("attempt=")[1].split("/")[0] for f in read}) == 2
    assert store.write(5, frame(spark, [])) == {}
    # A batch that is written again, or late, is not hidden by a snapshot.
    store.snapshot()
    store.write(101, frame(spark, [("m", "c", "x", "10")]))
    store.write(99, frame(spark, [("m", "c", "x", "late")]))
    assert {r.value for r in store.current().where("key_id = 'c'").collect()} == {"10", "late"}


def test_bad_values_end_the_run_or_are_listed(spark, tmp_path):
    catalog = Catalog.of([PropertyType("u.k"), PropertyType("u.day", "Date")], [EntityType("user", ("u.k",), ("u.k", "u.day"))], [EntitySet("users", "user")])
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"), prop("u.day", "day"), prop("@id", "given"))),))
    good = ("1", "2020-01-02", "00000000-0000-0000-0000-00000000000a")
    schema = "user string, day string, given string"
    store = Store(spark, str(tmp_path / "store"))
    for bad in (("2", "not a day", None), ("3", None, "no id")):
        rows = spark.createDataFrame([good, bad], schema)
        with pytest.raises(Exception, match="not a (Date|Guid)"):
            integrate(rows, mapping, catalog, store, 10)
        assert not store.state().count()
    rows = spark.createDataFrame([good, ("2", "not a day", None), ("3", None, "no id"), (" ", "2020-01-01", None)], schema)
    log = str(tmp_path / "log")
    run_all([(mapping, rows)], catalog, store, 10, "job", log, ["user"], "user", stage=True, on_bad_value="reject")
    found = {(r.row, r.property, r.value, r.reason) for r in store.rejects(10).collect()}
    assert found == {("2", "u.day", "not a day", "not a Date"), ("3", "@id", "no id", "not a Guid"), (" ", None, None, "blank id")}
    lines = [line for r in read_log(spark, log).where("status = 'SUCCEEDED'").collect() for line in r.log]
    assert "rejected 3 values and rows" in lines and "POSTGRES: 3 entities, 4 property values, 0 edges" in lines
    assert "first rejected row:  " in lines
    with pytest.raises(ValueError):
        integrate(rows, mapping, catalog, store, 20, on_bad_value="ignore")


def test_text_cannot_be_routed_to_the_binary_store(spark, tmp_path):
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"), prop("u.did", "did", destination="S3"))),))
    with pytest.raises(ValueError, match="not binary"):
        integrate(spark.createDataFrame([("1", "a")], EVENTS), mapping, CATALOG, Store(spark, str(tmp_path / "store")), 10)


def test_given_ids_stay_given(spark, tmp_path):
    given, other = "00000000-0000-0000-0000-00000000000a", "00000000-0000-0000-0000-00000000000b"
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"), prop("@id", "did"))),))
    store = Store(spark, str(tmp_path / "store"))
    for version, did in ((1, given), (3, None), (5, other)):
        integrate(spark.createDataFrame([("1", did), ("2", None)], EVENTS), mapping, CATALOG, store, version)
        store.compact() if version == 3 else None
    keys = {(r.value, r.key_id) for r in store.current().collect()}
    assert ("1", given) in keys and len(keys) == 2


def test_unversioned_sets_are_kept_by_the_store(spark, tmp_path):
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"),), property_update_type="Unversioned"),
                            Entity("thing", "things", (prop("t.k", "did"),))))
    store = Store(spark, str(tmp_path / "store"))
    for version in (10, 20):
        integrate(spark.createDataFrame([("1", "a")], EVENTS), mapping, CATALOG, store, version)
    expected = {"1": [21], "a": [11, 21]}
    assert {r.value: list(r.versions) for r in store.state().collect()} == expected
    store.compact()
    assert {r.value: list(r.versions) for r in store.state().collect()} == expected


def test_missing_sets_are_added_before_a_run(spark, tmp_path):
    mapping = Mapping("m", (Entity("user", "guests", (prop("u.k", "user"),), entity_type="user"),), organization_id="org")
    store, log = Store(spark, str(tmp_path / "store")), str(tmp_path / "log")
    assert run_all([(mapping, spark.createDataFrame([("1", "a")], EVENTS))], CATALOG, store, 10, "job", log) == 1
    assert any("added entity set guests" in r.log for r in read_log(spark, log).collect())


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, tmp_path):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = Conf(conf)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master), "x")
        assert shared_folder(Session(master, **{"spark.checkpoint.dir": "hdfs:///d/"}), "x").startswith("hdfs:///d/x-")
    staged = tmp_path / "local"
    spark.range(1).write.parquet(str(staged))
    discard(spark, str(staged))
    assert not staged.exists()


def test_stream_equals_batches(spark, tmp_path):
    data = [(str(i % 5), f"d{i}") for i in range(40)]
    for part in range(4):
        spark.createDataFrame(data[part::4], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    merge = Mapping("events", (Entity("user", "users", (prop("u.k", "user"), prop("u.did", "did"))),))
    streamed = Store(spark, str(tmp_path / "streamed"))
    for _ in range(2):  # the second run finds nothing new
        stream_into(stream, merge, CATALOG, streamed, str(tmp_path / "progress")).awaitTermination()
    batch = Store(spark, str(tmp_path / "batch"))
    integrate(spark.createDataFrame(data, EVENTS), merge, CATALOG, batch, 1)
    key = ("key_id", "property", "value")
    assert {r[:] for r in streamed.current().select(*key).collect()} == {r[:] for r in batch.current().select(*key).collect()}
    assert {r[0] for r in streamed.log().select("version").distinct().collect()} == {2, 4, 6, 8}


def test_store_with_a_registry_and_explicit_ids(spark, tmp_path):
    given = "00000000-0000-0000-0000-00000000000a"
    catalog = CATALOG
    mapping = Mapping("m", (Entity("user", "users", (prop("u.k", "user"), prop("@id", "did"))),
                            Entity("thing", "things", (prop("t.k", "user"),))),
                      (Association("does", "does", (prop("d.k", "user"),), src="user", dst="thing"),))
    store = Store(spark, str(tmp_path / "store"))
    integrate(spark.createDataFrame([("1", given), ("1", None), ("2", None)], EVENTS), mapping, catalog, store, 1)
    users = {r.value: r.key_id for r in store.current().where("entity_set = 'users'").collect()}
    assert users["1"] == given and len(users) == 2
    ends = {r.src_key_id for r in store.edges().collect()}
    assert ends == set(users.values())


def test_binaries(spark, tmp_path):
    rows = [("s", "k", "p", None, bytearray(b"x")), ("s", "k", "p", None, bytearray(b"x")), ("s", "k", "p", "text", None)]
    values = spark.createDataFrame(rows, VALUES)
    write_binaries(values, str(tmp_path / "b"))
    found = read_binaries(spark, str(tmp_path / "b")).collect()
    assert [(r.entity_set, r.hash, bytes(r.content)) for r in found] == [("s", hashlib.sha256(b"x").hexdigest(), b"x")]
    with pytest.raises(ValueError):
        binary_rows(values.withColumn("content", F.lit("text")))


def test_targets_and_log(spark, tmp_path):
    config = {"aurora": {"path": str(tmp_path / "a")}, "postgres": {"path": str(tmp_path / "p"), "format": "json"}}
    rows = spark.range(3)
    write_target(rows, "AURORA", config)
    write_target(rows, "POSTGRES", config)
    write_target(rows, "NONE", config)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3 and spark.read.json(str(tmp_path / "p")).count() == 3
    assert target_options("ALPR", config) == {} and write_nothing(rows) == 0
    with pytest.raises(ValueError):
        target_options("OTHER", config)
    path = str(tmp_path / "log")
    append_log(spark, path, "job", "events", ["started", "started"], "IN_PROGRESS")
    append_log(spark, path, "job", "events", ["done"], "SUCCEEDED")
    assert {(r.name, tuple(r.log), r.status) for r in read_log(spark, path).collect()} == {
        ("events", ("started",), "IN_PROGRESS"), ("events", ("done",), "SUCCEEDED")}
    with pytest.raises(ValueError):
        append_log(spark, path, "job", "events", [], "UNKNOWN")


def test_dangling_edges(spark):
    edges = spark.createDataFrame([("e", "1", "s", "a", "t", "x"), ("e", "2", "s", "b", "t", "x"), ("e", "3", "s", "a", "t", "y")],
                                  "edge_set string, edge_id string, src_set string, src_id string, dst_set string, dst_id string")
    keys = spark.createDataFrame([("s", "a"), ("t", "x")], "entity_set string, entity_id string")
    assert sorted(r.edge_id for r in ids.dangling_edges(edges, keys).collect()) == ["2", "3"]
    assert sorted(tuple(r) for r in ids.dangling_ends(edges, keys).collect()) == [("dst", "t", "y"), ("src", "s", "b")]


def test_run_of_several_sources(spark, tmp_path):
    store, log = Store(spark, str(tmp_path / "store")), str(tmp_path / "log")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], EVENTS)
    more = spark.createDataFrame([("3", "a")], EVENTS)
    assert run_all([(MAPPING, rows), (MAPPING, more)], CATALOG, store, 10, "job", log) == (2 + 2 + 2) + (1 + 1 + 1)
    assert [r.status for r in read_log(spark, log).where("status = 'SUCCEEDED'").collect()] == ["SUCCEEDED"] * 2
    broken = rows.select("user", F.when(F.col("user") == "9", "x").otherwise(F.raise_error(F.lit("broken source"))).cast("string").alias("did"))
    with pytest.raises(Exception, match="broken source"):
        run_all([(MAPPING, broken)], CATALOG, store, 20, "job", log)
    failed = read_log(spark, log).where("status = 'FAILED'").collect()
    assert len(failed) == 1 and "broken source" in failed[0].log[0]
    assert {r.value for r in store.current().where("property = 'u.k'").collect()} == {"1", "2", "3"}


def test_binaries_go_to_their_own_table(spark, tmp_path):
    catalog = Catalog.of([PropertyType("d.k"), PropertyType("d.b", "Binary")],
                         [EntityType("d", ("d.k",), ("d.k", "d.b"))], [EntitySet("ds", "d")])
    mapping = Mapping("m", (Entity("d", "ds", (prop("d.k", "k"), prop("d.b", "b"))),))
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("1", bytearray(b"x")), ("1", bytearray(b"x")), ("2", None)], "k string, b binary")
    for version in (1, 3):
        integrate(rows, mapping, catalog, store, version)
    assert sorted(r.value for r in store.current().collect()) == ["1", "2"]
    assert [(r.entity_set, bytes(r.content)) for r in store.binaries().collect()] == [("ds", b"x")]


def test_a_large_log_is_not_broadcast_to_a_view(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.write(10, frame(spark, [("a", "k", "p", "x"), ("a", "k", "p", "y")]))
    store.snapshot()
    store.write(20, frame(spark, [("a", "k", "p", "y"), ("a", "l", "p", "z")]))
    expected = {("k", "x", 11), ("k", "y", 21), ("l", "z", 21)}
    for most, joined in ((50, True), (1, False)):
        monkeypatch.setattr("graphloom.sinks.store.FEW_ROWS", most)
        view = store.current()
        assert {(r.key_id, r.value, r.version) for r in view.collect()} == expected
        assert ("Join" in view._jdf.queryExecution().executedPlan().toString()) == joined


def test_rows_of_one_file_are_mapped_in_several_tasks(spark, tmp_path, monkeypatch):
    given = []
    made = graph.FanOut.__init__
    monkeypatch.setattr(graph.FanOut, "__init__", lambda self, df, *a: given.append(df) or made(self, df, *a))
    catalog = Catalog.of([PropertyType("p.key")], [EntityType("p", ("p.key",), ("p.key",))], [EntitySet("people", "p")])
    rows = spark.range(50_000).selectExpr("sha2(cast(id AS string), 256) AS k").coalesce(1)
    store = Store(spark, str(tmp_path / "s"))
    integrate(rows, Mapping("people", (Entity("p", "people", (prop("p.key", "k"),)),)), catalog, store, 1)
    assert store.current().count() == 50_000
    assert given[0].rdd.getNumPartitions() > 1


def test_versions_as_bits_are_those_as_lists(spark):
    rng = random.Random(3)
    known = [s * v for v in (rng.sample(range(1, 10**12, 3), 100)) for s in (1, -1)]
    rows = []
    for n in range(60):
        versions = sorted(rng.sample(known, rng.randint(1, 9)), key=lambda v: (abs(v), v))
        latest = max(abs(v) for v in versions)
        versions = [v for v in versions if abs(v) != latest or v == versions[-1]]
        rows.append(("ab"[n % 2], f"k{n % 7}", "p", b"h", "v", None, versions[-1], versions))
    log = spark.createDataFrame(rows, update.LOG_SCHEMA)
    lists, bits = update.state_of(log, ["b"]), update.state_of(log, ["b"], known)
    same = lambda df: sorted((r.entity_set, r.key_id, tuple(r.versions)) for r in df.collect())
    assert same(lists) == same(bits)
    assert "ObjectHashAggregate" not in bits._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="a version that no batch has"):
        update.state_of(log, [], known[:2]).collect()
