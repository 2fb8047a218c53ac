"""Versioned updates of a property store.

The store is a log of rows (entity_set, key_id, property, value_hash, value, content,
version, versions). A write adds rows with a positive version and a tombstone adds rows
with a negative one; the state of a value is the row with the largest absolute version.
A merge adds its rows without a look at the log. The two replacing updates read the
log of the touched entities only. Rows of one value are few, and the rows of a hot
entity are spread by value, so no task holds a whole entity.

Versions are given by the caller: the tombstones of an update with version ``v`` carry
``-v`` and its writes ``v + 1``. The same update applied twice changes nothing more.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping as MappingType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashes import value_hash
from graphloom.operators.ids import EDGE_KEY

VALUE_KEY = ("entity_set", "key_id", "property", "value_hash")
LOG_SCHEMA = (
    "entity_set string, key_id string, property string, value_hash binary, "
    "value string, content binary, version bigint, versions array<bigint>"
)
_COLUMNS = (*VALUE_KEY, "value", "content", "version", "versions")


def incoming_rows(values: DataFrame, version: int) -> DataFrame:
    """Log rows of values with key ids, each value of an entity and property once."""
    distinct = values.select("entity_set", "key_id", "property", "value", "content").distinct()
    hashed = F.coalesce(value_hash(F.col("content")), value_hash(F.col("value")))
    return _stamped(distinct.withColumn("value_hash", hashed), version + 1)


def _stamped(rows: DataFrame, version: int) -> DataFrame:
    stamp = F.lit(version).cast("bigint")
    return rows.withColumn("version", stamp).withColumn("versions", F.array(stamp)).select(*_COLUMNS)


def tombstones(log: DataFrame, touched: DataFrame, version: int) -> DataFrame:
    """Log rows that end the current values of the touched keys.

    ``touched`` has the columns entity_set and key_id, and property where only some
    properties are ended. The values of a hot entity are on the left, where they can be split.
    """
    keys = [c for c in ("entity_set", "key_id", "property") if c in touched.columns]
    met = log.join(touched.select(*keys).distinct(), keys, "left_semi")
    return _stamped(current(met), -version)


def changes(
    log: DataFrame, values: DataFrame, version: int, update_types: MappingType[str, str]
) -> DataFrame:
    """Log rows that an update adds. Entity sets without an update type merge."""
    incoming = incoming_rows(values, version)
    ended = endings(log, incoming, version, update_types)
    return incoming if ended is None else incoming.unionByName(ended)


def endings(
    log: DataFrame, incoming: DataFrame, version: int, update_types: MappingType[str, str]
) -> DataFrame | None:
    """Tombstones for what the incoming rows replace; None where every set merges."""
    scopes = {"Replace": ("entity_set", "key_id"), "PartialReplace": ("entity_set", "key_id", "property")}
    found = None
    for kind, scope in scopes.items():
        sets = [s for s, given in update_types.items() if given == kind]
        if not sets:
            continue
        of_sets = F.col("entity_set").isin(sets)
        ended = tombstones(log.where(of_sets), incoming.where(of_sets).select(*scope), version)
        found = ended if found is None else found.unionByName(ended)
    return found


#: Versions that a bigint has bits for, and versions up to which they are gathered as bits.
_BITS, MOST_BITS = 62, 248


def state_of(log: DataFrame, unversioned: Iterable[str] = (), known: Iterable[int] | None = None) -> DataFrame:
    """One row per value with its version and all its versions, oldest first.

    Entity sets in ``unversioned`` keep the last version only, and no list is gathered for them. Where all versions that may
    occur are ``known`` and no more than ``MOST_BITS``, they are gathered as bits of numbers, which takes a hash aggregate and
    no sort; a version that is not among them ends the query.
    """
    sets = list(unversioned)
    of_sets = F.col("entity_set").isin(sets) if sets else F.lit(False)
    given = sorted(set(known or ()), key=lambda v: (abs(v), v))
    if given and len(given) <= MOST_BITS:
        return _state_by_bits(log, of_sets, given)
    # Equal hashes mean equal values, so grouping by these too costs no group and keeps them out of buffers.
    state = log.groupBy(*VALUE_KEY, "value", "content").agg(
        F.max_by("version", F.abs("version")).alias("version"),
        F.flatten(F.collect_list(F.when(~of_sets, F.col("versions")))).alias("versions"),
    )
    ordered = F.when(of_sets, F.array("version")).otherwise(_by_age(F.col("versions")))
    return state.withColumn("versions", ordered).select(*_COLUMNS)


def _state_by_bits(log: DataFrame, of_sets: Column, known: list[int]) -> DataFrame:
    """:func:`state_of` with a bit for each of the versions ``known``, which are in order of age."""
    parts = [known[i : i + _BITS] for i in range(0, len(known), _BITS)]
    number = F.create_map(*[F.lit(x) for i, v in enumerate(known) for x in (str(v), i)])

    def place(version: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("a version that no batch has: "), version.cast("string"))).cast("int")
        return F.coalesce(F.try_element_at(number, version.cast("string")), unknown)

    places = log.withColumn("places", F.transform("versions", place)).drop("versions")

    def bits_of(first: int) -> Column:
        own = F.filter("places", lambda p: (p >= first) & (p < first + _BITS))
        one = F.lit(1).cast("bigint")
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda found, p: found.bitwiseOR(F.call_function("shiftleft", one, p - first)))

    def versions_of(i: int, part: list[int]) -> Column:
        held = F.array(*[F.lit(v).cast("bigint") for v in part])
        return F.filter(held, lambda _, at: F.getbit(F.col(f"bits{i}"), at) == 1)

    bits = [bits_of(i * _BITS).alias(f"bits{i}") for i in range(len(parts))]
    state = places.select(*VALUE_KEY, "value", "content", "version", *bits).groupBy(*VALUE_KEY, "value", "content").agg(
        F.max_by("version", F.abs("version")).alias("version"), *[F.bit_or(f"bits{i}").alias(f"bits{i}") for i in range(len(parts))]
    )
    lists = [versions_of(i, part) for i, part in enumerate(parts)]
    versions = F.when(of_sets, F.array("version")).otherwise(F.concat(*lists))
    return state.withColumn("versions", versions).select(*_COLUMNS)


def _by_age(versions: Column) -> Column:
    aged = F.transform(versions, lambda v: F.struct(F.abs(v).alias("age"), v.alias("version")))
    ordered = F.transform(F.array_sort(F.array_distinct(aged)), lambda a: a["version"])
    return F.when(F.size(versions) == 1, versions).otherwise(ordered)


def current(log: DataFrame) -> DataFrame:
    """The values in force: those whose latest version is positive."""
    latest = log.groupBy(*VALUE_KEY, "value", "content").agg(
        F.max_by("version", F.abs("version")).alias("version")
    )
    return latest.where(F.col("version") > 0)


def as_of(log: DataFrame, until: int | None = None, after: int | None = None) -> DataFrame:
    """Log rows as they were when ``until`` was the last version, without those whose last one is not above ``after``."""
    rows = log
    if until is not None:
        then = F.filter("versions", lambda v: F.abs(v) <= until)
        rows = rows.withColumn("versions", then).where(F.size("versions") > 0).withColumn("version", F.element_at("versions", -1))
    return rows if after is None else rows.where(F.abs("version") > after)


def patched(view: DataFrame, log: DataFrame, few: bool = False) -> DataFrame:
    """Values in force after the rows of a log: those of a ``view`` that the log doesn't touch, and the log's own.

    All versions of the log are younger than those of the view. Where the log is known to have ``few`` rows, the view is not
    grouped and its rows are on the left of a join with the touched values, which Spark may broadcast. Otherwise both are
    grouped at once: files of a log are so much smaller than its rows that Spark would take it for few and send it to the driver.
    """
    if not few:
        return current(view.unionByName(log.select(*view.columns)))
    latest = log.groupBy(*VALUE_KEY, "value", "content").agg(F.max_by("version", F.abs("version")).alias("version"))
    kept = view.join(log.select(*VALUE_KEY).distinct(), list(VALUE_KEY), "left_anti")
    return kept.unionByName(latest.where(F.col("version") > 0))


def update(
    state: DataFrame,
    values: DataFrame,
    version: int,
    update_types: MappingType[str, str],
    unversioned: Iterable[str] = (),
) -> DataFrame:
    """The state after an update."""
    return state_of(state.unionByName(changes(state, values, version, update_types)), unversioned)


def committed_entities(log: DataFrame) -> DataFrame:
    """Rows (entity_set, key_id, version): the last write of each entity."""
    return log.where(F.col("version") > 0).groupBy("entity_set", "key_id").agg(
        F.max("version").alias("version")
    )


def edge_rows(edges: DataFrame, version: int) -> DataFrame:
    """Log rows of edges: each (edge, source, destination) once, with the write version."""
    stamp = F.lit(version + 1).cast("bigint")
    return edges.select(*EDGE_KEY).distinct().withColumn("version", stamp)


def edge_state(log: DataFrame) -> DataFrame:
    """One row per edge with its last version."""
    return log.groupBy(*EDGE_KEY).agg(F.max("version").alias("version"))
