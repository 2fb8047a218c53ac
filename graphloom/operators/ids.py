"""Entity key ids, explicit ids, edge endpoints and address lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashes import key_id
from graphloom.functions.numbers import parse_uuid
from graphloom.operators.key_filters import filter_of, kept_by, marked
from graphloom.plans.catalog import ID_PROPERTY

KEY = ("entity_set", "entity_id")


def entity_keys(values: DataFrame) -> DataFrame:
    """Distinct entity keys."""
    return values.select(*KEY).distinct()


def explicit_ids(values: DataFrame) -> DataFrame:
    """Ids given as a property, one per key; of several the smallest text is taken."""
    given = values.where(F.col("property") == ID_PROPERTY)
    return given.groupBy(*KEY).agg(F.min(parse_uuid(F.col("value"))).alias("key_id"))


def registry_with(registry: DataFrame, overrides: DataFrame) -> DataFrame:
    """A registry of ids in which the overrides win; one row per key."""
    both = registry.select(*KEY, "key_id", F.lit(1).alias("rank")).unionByName(
        overrides.select(*KEY, "key_id", F.lit(0).alias("rank"))
    )
    return both.groupBy(*KEY).agg(F.min(F.struct("rank", "key_id"))["key_id"].alias("key_id"))


def with_ids(
    rows: DataFrame,
    registry: DataFrame | None = None,
    entity_set: str = "entity_set",
    entity_id: str = "entity_id",
    out: str = "key_id",
) -> DataFrame:
    """Add the id of an entity key.

    The id is a hash of the key, which takes no shuffle. Keys of a registry
    (entity_set, entity_id, key_id), one row each, keep the id they have there. The rows of a hot key
    are on the left of a left join, where adaptive execution splits them between tasks.
    """
    assigned = key_id(F.col(entity_set), F.col(entity_id))
    if registry is None:
        return rows.withColumn(out, assigned)
    known = registry.select(
        F.col("entity_set").alias(entity_set),
        F.col("entity_id").alias(entity_id),
        F.col("key_id").alias("__known"),
    )
    joined = rows.join(known, [entity_set, entity_id], "left")
    return joined.withColumn(out, F.coalesce("__known", assigned)).drop("__known")


def assign_ids(values: DataFrame, registry: DataFrame | None = None, explicit: bool = True) -> DataFrame:
    """Values with ``key_id``. Explicit ids win, and their property is taken out of the data.

    ``explicit=False`` saves the shuffles where the mapping has no explicit ids. With
    explicit ids or a registry each value comes out once.
    """
    if explicit or registry is not None:
        values = values.distinct()
    if explicit:
        given = explicit_ids(values)
        registry = given if registry is None else registry_with(registry, given)
        values = values.where(F.col("property") != ID_PROPERTY)
    return with_ids(values, registry)


# Ids that a batch does not make from hashes: where they are from, the first of them winning.
KNOWN, GIVEN, REGISTERED = 0, 1, 2


def ids_of_keys(asked: DataFrame, sources: Iterable[tuple[int, DataFrame]]) -> DataFrame:
    """Rows (entity_set, entity_id, key_id, origin), one for each key that a source has an id for.

    ``asked`` is a filter of the keys that ids are wanted for; it goes to the sources first, so what is grouped is as
    much as the keys asked for and not as all ids ever given.
    """
    found = [
        kept_by(rows.select(*KEY, "key_id"), KEY, asked).withColumn("origin", F.lit(origin)) for origin, rows in sources
    ]
    first = F.min(F.struct("origin", "key_id")).alias("first")
    return reduce(DataFrame.unionByName, found).groupBy(*KEY).agg(first).select(*KEY, "first.key_id", "first.origin")


def with_few_ids(values: DataFrame, few: DataFrame) -> DataFrame:
    """Values with ``key_id``, where few keys have an id of their own; ``few`` has one row for each of these.

    Only values that a filter of these keys lets through are joined. All others get the hash of their key
    where they are, without a shuffle.
    """
    seen = marked(values, KEY, filter_of(few, KEY), "__few")
    met = with_ids(seen.where("__few").drop("__few"), few)
    return met.unionByName(with_ids(seen.where("not __few").drop("__few")).select(*met.columns))


def edges_with_few_ids(edges: DataFrame, few: DataFrame) -> DataFrame:
    """Edges with the ids of edge, source and destination; only those with an end among the keys of ``few`` are joined."""
    filters, ends = filter_of(few, KEY), ("edge", "src", "dst")
    for end in ends:
        edges = marked(edges, (f"{end}_set", f"{end}_id"), filters, f"__{end}")
    any_end = " or ".join(f"__{end}" for end in ends)
    flags = [f"__{end}" for end in ends]
    met = edge_ids(edges.where(any_end).drop(*flags), few)
    return met.unionByName(edge_ids(edges.where(f"not ({any_end})").drop(*flags)).select(*met.columns))


def end_keys(edges: DataFrame) -> DataFrame:
    """The keys (entity_set, entity_id) of all three ends of edges."""
    return edges.select(_ends("edge", "src", "dst").alias("e")).select("e.entity_set", "e.entity_id")


def edge_ids(edges: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Edges with the ids of edge, source and destination; distinct when a registry is joined.

    The registry is joined once, with the three ends of every edge as rows.
    """
    ends = ("edge", "src", "dst")
    if registry is None:
        for end in ends:
            edges = with_ids(edges, None, f"{end}_set", f"{end}_id", f"{end}_key_id")
        return edges
    columns = edges.columns
    rows = edges.distinct().select(*columns, _ends(*ends).alias("e")).select(*columns, "e.*")
    found = with_ids(rows, registry)
    ids = [F.max(F.when(F.col("end") == end, F.col("key_id"))).alias(f"{end}_key_id") for end in ends]
    return found.groupBy(*columns).agg(*ids)


def _ends(*ends: str) -> Column:
    """Rows (end, entity_set, entity_id) of the given ends of an edge."""
    return F.explode(
        F.array(*[
            F.struct(
                F.lit(end).alias("end"),
                F.col(f"{end}_set").alias("entity_set"),
                F.col(f"{end}_id").alias("entity_id"),
            )
            for end in ends
        ])
    )


EDGE_KEY = ("edge_set", "edge_key_id", "src_set", "src_key_id", "dst_set", "dst_key_id")


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select(*EDGE_KEY).distinct()


def dangling_ends(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (end, entity_set, entity_id): distinct ends of edges that are no known entity.

    Ends are made distinct before the join, so an end that many edges share is one row there.
    """
    found = edges.select(_ends("src", "dst").alias("e")).select("e.*").distinct()
    return found.join(entity_keys(keys), list(KEY), "left_anti").select("end", *KEY)


def dangling_edges(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct edges of which the source or the destination is no known entity."""
    known, flagged = entity_keys(keys), edges.distinct()
    for end in ("src", "dst"):
        side = known.select(
            F.col("entity_set").alias(f"{end}_set"), F.col("entity_id").alias(f"{end}_id"), F.lit(True).alias(f"__{end}")
        )
        flagged = flagged.join(side, [f"{end}_set", f"{end}_id"], "left")
    lost = F.col("__src").isNull() | F.col("__dst").isNull()
    return flagged.where(lost).select(*edges.columns)


def normal_address(c: Column) -> Column:
    """Lower case, with runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def look_up_address(
    rows: DataFrame, address: str, gazetteer: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """Add fields of a gazetteer to rows by normal address; no match gives nulls.

    The gazetteer has a column ``address`` and the fields; the first of several entries
    for an address, in the order of the fields, is taken.
    """
    entries = (
        gazetteer.where(normal_address(F.col("address")) != "")
        .groupBy(normal_address(F.col("address")).alias("__address"))
        .agg(F.min(F.struct(*fields)).alias("__entry"))
    )
    # An empty address is null here and matches nothing.
    wanted = F.nullif(normal_address(F.col(address)), F.lit(""))
    joined = rows.withColumn("__address", wanted).join(entries, "__address", "left")
    return joined.select(*rows.columns, *[F.col(f"__entry.{f}").alias(f) for f in fields])
