"""A property and edge store as append-only Parquet tables.

Each write of a batch is an attempt with a folder of its own below each table, and a batch counts once a commit
names its attempt. So a batch that was cut short is not seen, and one that is written again takes the place of its
first try as a whole, tables that are not written again included. Commits are described in
:mod:`graphloom.sinks.commits`; the check of a batch is made again when another writer was faster.

``values`` lie by entity set and, within, by key. An ``index`` says which keys a file may hold, as
bitmaps over hashes of keys: a replacing update opens only files that may hold one of its keys. Neighbouring batches of like
size are merged (:meth:`Store.tidy`), so few are live and each value is written again a few times only. The
values in force are kept as snapshots, and what has come since is put on top when they are read.
"""

from __future__ import annotations

import urllib.parse
import uuid
from collections.abc import Iterable, Mapping as MappingType, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import update
from graphloom.operators.counts import observed
from graphloom.operators.ids import EDGE_KEY, KEY
from graphloom.operators.key_filters import filter_of, key_slice, kept_by, met
from graphloom.plans.mapping import BINARIES, REPLACING, TABLES
from graphloom.sinks.binaries import binary_rows
from graphloom.sinks.commits import Batch, Commits, Snapshot, State, as_runs
from graphloom.sources.scratch import discard, found_by

#: Slices of keys that files are made of and that have one bitmap each.
SLICES = 1024
#: Bits of a bitmap, as Spark's bitmap functions have them.
_BITS = 32768
#: So many neighbouring batches of like size are merged; sizes are alike within this factor.
FAN = 4
#: Sketches of distinct keys have 2 to this power of registers, for a standard error of 0.6 percent in at most 32 KB.
SKETCH_POWER = 15
#: Rows since a snapshot that may be broadcast to it.
FEW_ROWS = 50_000
#: A snapshot is made anew when this part of its rows has been written since, and so many are kept.
STALE, KEPT_SNAPSHOTS = 0.25, 8

_SCHEMAS = {
    "values": update.LOG_SCHEMA,
    "index": "entity_set string, slice int, bits binary, file string",
    "current": "entity_set string, key_id string, property string, value_hash binary, value string, content binary, version bigint",
    "binaries": "entity_set string, key_id string, property string, hash string, content binary",
    "edges": ", ".join(f"{c} string" for c in EDGE_KEY) + ", version bigint",
    "entities": "entity_set string, key_id string, version bigint",
    "given_ids": "entity_set string, entity_id string, key_id string",
    "totals": "destination string, counted string, name string, rows bigint, sketch binary",
    "ids_index": "slice int, bits binary, file string",
    "rejects": "row string, alias string, property string, value string, reason string, batch bigint",
}
#: Tables of which a batch is merged with others, and how they lie.
_MERGED = ("values", "edges", "binaries", "entities", "given_ids", "rejects", "totals")
#: Tables for the store itself, whose rows are no rows of a batch.
_OWN = ("index", "ids_index", "totals")
#: Tables whose rows come from a grouping, the shuffle of which has cut them to size.
_GROUPED = ("edges", "entities")
_PARTITIONS = {"values": ["entity_set"], "binaries": ["entity_set"], "current": ["entity_set"]}


def _columns(table: str) -> list[str]:
    return [c.split(" ")[0] for c in _SCHEMAS[table].split(", ")]


class Store:
    """The store at a path. Nothing is written before the first batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._commits = Commits(spark, f"{self.path}/commits")

    # Reading

    def _folder(self, table: str, attempt: str) -> str:
        return f"{self.path}/{table}/attempt={attempt}"

    def _files(self, table: str, paths: Sequence[str]) -> DataFrame:
        """Rows of folders or files of a table."""
        schema = _SCHEMAS[table]
        if not paths:
            return self._no_rows(table)
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*paths)
        return found.select(*_columns(table))

    def _no_rows(self, table: str) -> DataFrame:
        """An empty table that no Python worker is started for."""
        columns = (c.split(" ") for c in _SCHEMAS[table].split(", "))
        return self.spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])

    def _read(self, table: str, batches: Iterable[Batch] | None = None) -> DataFrame:
        """Rows of some batches, by default of all that are live."""
        chosen = self._commits.last().batches if batches is None else batches
        return self._files(table, [self._folder(table, b.attempt) for b in chosen if table in b.counts])

    def live(self) -> list[tuple[int, int]]:
        """The first and the last version of each live batch."""
        return [(b.first, b.last) for b in self._commits.last().batches]

    def log(self, before: int | None = None) -> DataFrame:
        return self._read("values", [b for b in self._commits.last().batches if before is None or b.last < before])

    def unversioned_sets(self) -> list[str]:
        """Entity sets of which only the last version of a value is kept, by their last write."""
        return _unversioned(self._commits.last().batches)

    def state(self, unversioned: Iterable[str] | None = None) -> DataFrame:
        """Each value with its versions; sets that were written as unversioned have the last one."""
        batches = self._commits.last().batches
        sets = _unversioned(batches) if unversioned is None else unversioned
        return update.state_of(self._read("values", batches), sets, _stamps(batches))

    def current(self, as_of: int | None = None) -> DataFrame:
        """The values in force, now or after the batch ``as_of`` and those before it.

        The newest snapshot that is not younger is read as it is, without the values that later batches touch. Of entity
        sets that keep no versions, a value that was written again since does not show in a view of before.
        """
        state = self._commits.last()
        base = max((s for s in state.snapshots if as_of is None or s.version <= as_of), key=lambda s: s.version, default=None)
        since = None if base is None else base.version + 1
        later = [b for b in state.batches if (base is None or b.last > base.version) and (as_of is None or b.first <= as_of)]
        log = update.as_of(self._read("values", later), None if as_of is None else as_of + 1, since)
        if base is None:
            return update.current(log)
        # What a batch ends is not among the rows that it counts.
        few = sum(b.counts["values"] for b in later) <= FEW_ROWS and not any(b.replacing for b in later)
        return update.patched(self._files("current", [self._folder("current", base.attempt)]), log, few)

    def edges(self) -> DataFrame:
        return update.edge_state(self._read("edges"))

    def binaries(self) -> DataFrame:
        """Each binary value of an entity and property once, with its hash."""
        return self._read("binaries").dropDuplicates(["entity_set", "key_id", "property", "hash"])

    def entities(self) -> DataFrame:
        """Each entity with the version of its last write."""
        return self._read("entities").groupBy("entity_set", "key_id").agg(F.max("version").alias("version"))

    def given_ids(self, before: int | None = None) -> DataFrame | None:
        """Ids that came with the data, one row for each key; None where no batch had any."""
        batches = [b for b in self._commits.last().batches if "given_ids" in b.counts and (before is None or b.last < before)]
        if not batches:
            return None
        return self._read("given_ids", batches).groupBy("entity_set", "entity_id").agg(F.min("key_id").alias("key_id"))

    def has_given_ids(self, before: int) -> bool:
        return any("given_ids" in b.counts and b.last < before for b in self._commits.last().batches)

    def given_ids_of(self, asked: DataFrame, before: int) -> DataFrame:
        """Ids that came with earlier batches, of the keys that the filter ``asked`` may hold.

        Only the files that may hold one of these keys are opened, and nothing is grouped. A key is there more than
        once if batches came out of order.
        """
        batches = [b for b in self._commits.last().batches if "given_ids" in b.counts and b.last < before]
        files = self._named("given_ids", met(self._read("ids_index", batches), asked, "file"))
        return kept_by(self._files("given_ids", files), KEY, asked)

    def rejects(self, version: int | None = None) -> DataFrame:
        """What could not be integrated, of one batch or of all."""
        found = self._read("rejects")
        return (found if version is None else found.where(F.col("batch") == version)).drop("batch")

    def totals(self) -> DataFrame:
        """Rows (destination, counted, name, rows, distinct) over all batches, by entity set and edge set.

        ``counted`` is entities or edges. ``rows`` is how many rows batches brought for them, which is exact, a batch that
        was written again counting once. ``distinct`` is how many entities or edges these are of, from sketches that
        were kept with the batches; neither the log nor the edges are read.
        """
        whole = _united_totals(self._read("totals"))
        return whole.select("destination", "counted", "name", "rows", F.hll_sketch_estimate("sketch").alias("distinct"))

    def batch_counts(self, version: int) -> tuple[int, int]:
        """How many entities and edges a committed batch wrote."""
        counts = next(b.counts for b in self._commits.last().batches if not b.merged and b.first == version)
        return counts.get("entities", 0), counts.get("edges", 0)

    # Writing

    def _write(self, rows: DataFrame, table: str, attempt: str, mode: str = "error") -> int:
        """Write rows of an attempt; the number of rows."""
        partitions = _PARTITIONS.get(table, [])
        # Rebalancing cuts the files to size, also where one entity set holds most rows.
        if table == "values":
            dealt = rows.withColumn("slice", _slice()).hint("rebalance", "entity_set", "slice")
            laid = dealt.sortWithinPartitions("entity_set", "key_id").drop("slice")
        elif table == "given_ids":
            laid = rows.withColumn("slice", key_slice(KEY)).hint("rebalance", "slice").sortWithinPartitions("slice").drop("slice")
        elif table in _GROUPED:
            laid = rows
        else:
            laid = rows.hint("rebalance", *partitions)
        counted, counter = observed(laid, f"{table}-{uuid.uuid4().hex}")
        counted.write.mode(mode).partitionBy(*partitions).parquet(self._folder(table, attempt))
        return int(counter.get["rows"])

    def write(
        self,
        version: int,
        values: DataFrame,
        edges: DataFrame | None = None,
        update_types: MappingType[str, str] | None = None,
        binaries: DataFrame | None = None,
        property_update_types: MappingType[str, str] | None = None,
        given_ids: DataFrame | None = None,
        rejects: DataFrame | None = None,
    ) -> dict[str, int]:
        """Apply a batch of values, edges and binary values with ids; the rows written by table.

        Versions of batches must be above 0 and at least 2 apart. A batch that has been merged with others is in already,
        and is not written again. A batch can't come in below a later one that replaced values of the same sets.
        """
        state = self._commits.last()
        replacing = {s: k for s, k in (update_types or {}).items() if k in REPLACING}
        if not _check(version, state, ()):
            return {}
        attempt, counts = uuid.uuid4().hex, {}
        incoming = update.incoming_rows(values, version)
        counts["values"] = self._write(incoming, "values", attempt)
        # From here on the written rows are read, so the source is mapped once.
        own = self._files("values", [self._folder("values", attempt)])
        asked = self._bitmaps(own.where(F.col("entity_set").isin(list(replacing)))) if replacing else None
        seen: set[str] = set()

        def end(batches: Iterable[Batch]) -> None:
            """Add the ends of what the batch replaces in other batches, which were not seen before."""
            new = [b for b in batches if b.last < version and b.attempt not in seen]
            seen.update(b.attempt for b in new)
            if new and asked is not None and (files := self.holding(asked, new)):
                ended = update.endings(self._files("values", files), own, version, replacing)
                self._write(ended, "values", attempt, "append")

        end(state.batches)
        written = {
            "edges": None if edges is None else update.edge_rows(edges, version),
            "binaries": None if binaries is None else binary_rows(binaries),
            "given_ids": None if given_ids is None else given_ids.select("entity_set", "entity_id", "key_id"),
            "rejects": None if rejects is None else rejects.select("row", "alias", "property", "value", "reason", F.lit(version).cast("long").alias("batch")),
            "entities": update.committed_entities(own),
        }
        for table, rows in written.items():
            if rows is not None:
                counts[table] = self._write(rows, table, attempt)
        self._write(self._sketched(attempt, own, counts), "totals", attempt)
        counts["totals"] = 0
        if given_ids is not None:
            self._index_ids(attempt)
            counts["ids_index"] = 0
        kinds = property_update_types or {}
        sets = self._sets(attempt)

        def committed(last: State) -> State | None:
            if not _check(version, last, sets):
                return None
            end(last.batches)
            batch = Batch(
                attempt, as_runs([version]), counts, [s for s, k in kinds.items() if k == "Unversioned"],
                [s for s, k in kinds.items() if k != "Unversioned"], sorted(replacing),
            )
            # Snapshots that have what this batch was before, or don't have it, are of no use.
            last = replace(last, snapshots=tuple(s for s in last.snapshots if s.version < version))
            return last.without(b.attempt for b in last.batches if b.first == version and not b.merged).plus(batch)

        self._index(attempt)
        counts["index"] = 0
        indexed = len(seen)

        def with_index(last: State) -> State | None:
            nonlocal indexed
            made = committed(last)
            if len(seen) > indexed:  # ends were added since
                indexed = len(seen)
                self._index(attempt)
            return made

        return {t: n for t, n in counts.items() if t not in _OWN} if self._commits.change(with_index) else {}

    def _sketched(self, attempt: str, own: DataFrame, counts: MappingType[str, int]) -> DataFrame:
        """Rows and sketches of distinct keys of what an attempt brought, by destination and set."""

        def part(rows: DataFrame, destination: str, counted: str, name: str, *key: str) -> DataFrame:
            one = key[0] if len(key) == 1 else F.sha2(F.to_json(F.array(*key)), 256)
            return rows.groupBy(F.lit(destination).alias("destination"), F.lit(counted).alias("counted"), F.col(name).alias("name")).agg(
                F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(one, F.lit(SKETCH_POWER)).alias("sketch"))

        made = part(own.where("version > 0"), TABLES, "entities", "entity_set", "key_id")
        if "binaries" in counts:
            made = made.unionByName(part(self._files("binaries", [self._folder("binaries", attempt)]), BINARIES, "entities", "entity_set", "key_id"))
        if "edges" in counts:
            made = made.unionByName(part(self._files("edges", [self._folder("edges", attempt)]), TABLES, "edges", "edge_set", *EDGE_KEY))
        return made

    # Files that may hold keys

    def _sets(self, attempt: str) -> list[str]:
        """Entity sets that an attempt has values of, by their folders."""
        folders = found_by(self.spark, f"{self._folder('values', attempt)}/entity_set=*")
        return [urllib.parse.unquote(f.rpartition("/entity_set=")[2]) for f in folders]

    def _bitmaps(self, rows: DataFrame, *by: str) -> DataFrame:
        """The keys of rows as one bitmap for each entity set and slice, and whatever else it is ``by``."""
        bit = F.pmod(F.shiftright(F.xxhash64("key_id"), 20), F.lit(_BITS)).alias("bit")
        keys = rows.select("entity_set", _slice().alias("slice"), bit, *by)
        return keys.groupBy("entity_set", "slice", *by).agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _index(self, attempt: str) -> None:
        """Write what keys the value files of an attempt may hold."""
        folder = self._folder("values", attempt)
        if not found_by(self.spark, f"{folder}/*/*"):
            rows = self._no_rows("index")
        else:
            read = self.spark.read.schema(_SCHEMAS["values"]).parquet(folder)
            file = F.regexp_extract("_metadata.file_path", r"/values/(attempt=[^/]*/.*)$", 1).alias("file")
            rows = self._bitmaps(read.select("entity_set", "key_id", file), "file").select(*_columns("index"))
        rows.hint("rebalance").write.mode("overwrite").parquet(self._folder("index", attempt))

    def holding(self, asked: DataFrame, batches: Iterable[Batch]) -> list[str]:
        """Value files of batches that may hold one of the keys in the bitmaps ``asked``."""
        return self._named("values", met(self._read("index", batches), asked, "file", "entity_set"))

    def _named(self, table: str, files: DataFrame) -> list[str]:
        """Paths of the files of a table that an index names."""
        return sorted(f"{self.path}/{table}/{urllib.parse.unquote(r[0])}" for r in files.collect())

    def _index_ids(self, attempt: str) -> None:
        """Write which keys the files of given ids of an attempt may hold."""
        folder = self._folder("given_ids", attempt)
        read = self.spark.read.schema(_SCHEMAS["given_ids"]).parquet(folder)
        file = F.regexp_extract("_metadata.file_path", r"/given_ids/(attempt=[^/]*/.*)$", 1).alias("file")
        rows = filter_of(read.select(*KEY, file), KEY, "file").select(*_columns("ids_index"))
        rows.hint("rebalance").write.mode("overwrite").parquet(self._folder("ids_index", attempt))

    # Keeping in order

    def tidy(self) -> bool:
        """Merge neighbouring batches of like size as long as there are ``FAN`` of them, and bring the
        snapshot up to date where much has been written since; whether there was anything to do."""
        done = False
        while run := _like_sized(self._commits.last().batches):
            if self._merge(run) is None:
                break
            done = True
        state = self._commits.last()
        if state.batches:
            newest = max(state.snapshots, key=lambda s: s.version, default=None)
            since = sum(b.counts["values"] for b in state.batches if newest is None or b.last > newest.version)
            if newest is None or since > STALE * newest.rows:
                done |= self.snapshot() is not None
        return done

    def compact(self) -> int | None:
        """Write all batches as one, whose commit takes their place; the number of the commit, or None without a batch.

        Readers and a running stream see it with their next read, and plans made before keep reading the old
        folders until :meth:`remove_dead`.
        """
        batches = self._commits.last().batches
        return self._merge(batches) if batches else None

    def _merge(self, batches: Sequence[Batch]) -> int | None:
        """Neighbouring batches as one; None where another writer has changed one of them meanwhile."""
        attempt, counts = uuid.uuid4().hex, {}
        unversioned = _unversioned(self._commits.last().batches)

        def merged(table: str) -> DataFrame:
            rows = self._read(table, batches)
            if table == "values":
                return update.state_of(rows, unversioned, _stamps(batches))
            if table == "edges":
                return update.edge_state(rows)
            if table == "entities":
                return rows.groupBy("entity_set", "key_id").agg(F.max("version").alias("version"))
            if table == "given_ids":
                return rows.groupBy("entity_set", "entity_id").agg(F.min("key_id").alias("key_id"))
            if table == "totals":
                return _united_totals(rows)
            return rows.dropDuplicates(["entity_set", "key_id", "property", "hash"]) if table == "binaries" else rows

        for table in _MERGED:
            if any(table in b.counts for b in batches):
                counts[table] = self._write(merged(table), table, attempt)
        self._index(attempt)
        counts["index"] = 0
        if "given_ids" in counts:
            self._index_ids(attempt)
            counts["ids_index"] = 0
        kinds: dict[str, str] = {}
        for b in batches:
            kinds.update(dict.fromkeys(b.versioned, "versioned") | dict.fromkeys(b.unversioned, "unversioned"))
        batch = Batch(
            attempt, as_runs(v for b in batches for v in b.versions()), counts, [s for s, k in kinds.items() if k == "unversioned"],
            [s for s, k in kinds.items() if k == "versioned"], sorted({s for b in batches for s in b.replacing}), merged=True,
        )
        old = {b.attempt for b in batches}

        def taken(last: State) -> State | None:
            between = [b for b in last.batches if b.attempt not in old and batch.first < b.last and b.first < batch.last]
            if between or not old <= {b.attempt for b in last.batches}:
                return None
            return last.without(old).plus(batch)

        made = self._commits.change(taken)
        return None if made is None else made.number

    def snapshot(self) -> int | None:
        """Keep the values in force now as a table of their own; the version they are of, or None without a batch."""
        state = self._commits.last()
        if not state.batches:
            return None
        attempt, version = uuid.uuid4().hex, max(b.last for b in state.batches)
        rows = self._write(self.current(as_of=version), "current", attempt)
        read = {b.attempt for b in state.batches}

        def kept(last: State) -> State | None:
            # What was read must still be what counts up to that version, whether merged since or not.
            changed = [b for b in last.batches if b.attempt not in read and not b.merged and b.first <= version]
            if changed:
                return None
            others = [s for s in last.snapshots if s.version != version]
            return replace(last, snapshots=(*others, Snapshot(attempt, version, rows))[-KEPT_SNAPSHOTS:])

        return version if self._commits.change(kept) else None

    def remove_dead(self) -> int:
        """Delete the folders of attempts that the last commit doesn't name. No write may be under way."""
        state = self._commits.last()
        kept = {x.attempt for x in (*state.batches, *state.snapshots)}
        there = (p for t in _SCHEMAS for p in found_by(self.spark, f"{self.path}/{t}/attempt=*"))
        dead = [p for p in there if p.rpartition("attempt=")[2] not in kept]
        for path in dead:
            discard(self.spark, path)
        self._commits.remove_old()
        return len(dead)


def _check(version: int, state: State, sets: Iterable[str]) -> bool:
    """Whether a batch is to be written; an error where it can't be."""
    if version < 1:
        raise ValueError("versions start at 1")
    if state.taken_up(version):
        return False
    again = any(b.first == version for b in state.batches)
    for b in state.batches:
        if b.merged and version <= b.last + 1:
            raise ValueError(f"version {version} is older than the merger of batches up to {b.last}, or overlaps with it")
        if not b.merged and b.first != version and abs(b.first - version) < 2:
            raise ValueError(f"version {version} overlaps with that of batch {b.first}")
        late = b.first > version and set(b.replacing) & set(sets)
        if late and not again:
            raise ValueError(f"batch {b.first} has replaced values of {', '.join(sorted(late))}, and version {version} is older")
    return True


def _united_totals(rows: DataFrame) -> DataFrame:
    united = rows.groupBy("destination", "counted", "name")
    return united.agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))


def _stamps(batches: Iterable[Batch]) -> list[int] | None:
    """All versions that values of some batches may have, unless there are many."""
    versions = {v for b in batches for v in b.versions()}
    return [stamp for v in versions for stamp in (-v, v + 1)] if 2 * len(versions) <= update.MOST_BITS else None


def _unversioned(batches: Iterable[Batch]) -> list[str]:
    kind: dict[str, bool] = {}
    for b in batches:
        kind.update(dict.fromkeys(b.versioned, False) | dict.fromkeys(b.unversioned, True))
    return sorted(s for s, alone in kind.items() if alone)


def _tier(batch: Batch) -> int:
    rows, tier = max(1, batch.counts["values"]), 0
    while rows >= FAN:
        rows, tier = rows // FAN, tier + 1
    return tier


def _like_sized(batches: Sequence[Batch]) -> list[Batch]:
    """Neighbours to merge: the longest run of the smallest size that ``FAN`` of them don't exceed."""
    for most in sorted({_tier(b) for b in batches}):
        run: list[Batch] = []
        for b in batches:
            if _tier(b) <= most:
                run.append(b)
            elif len(run) >= FAN:
                break
            else:
                run = []
        if len(run) >= FAN:
            return run
    return []


def _slice() -> Column:
    return F.pmod(F.xxhash64("key_id"), F.lit(SLICES)).cast("int")
