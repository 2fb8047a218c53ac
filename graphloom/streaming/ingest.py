"""Ingest of a source into a store, once or as a stream of batches."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from graphloom.operators import graph, ids
from graphloom.operators.counts import earliest_reject
from graphloom.operators.key_filters import filter_of
from graphloom.plans.catalog import ID_PROPERTY, Catalog
from graphloom.plans.mapping import BINARIES, NO_OP, TABLES, Mapping
from graphloom.sinks.store import Store
from graphloom.sinks.targets import append_log
from graphloom.sources.scratch import discard, shared_folder, written_to

# What becomes of values that are not of their datatype: they end the run, or are listed with the batch.
FAIL, REJECT = "fail", "reject"


def integrate(
    rows: DataFrame,
    mapping: Mapping,
    catalog: Catalog,
    store: Store,
    version: int,
    registry: DataFrame | None = None,
    stage: bool = False,
    on_bad_value: str = FAIL,
    shown: Sequence[str] = (),
) -> dict[str, int]:
    """Map rows, give ids, and write values and edges as one batch of the store; rows written by table.

    A value that is not of its datatype, a bad explicit id included, ends the run. With
    ``on_bad_value="reject"`` it is left out and listed in the batch's ``rejects``, with the ``shown``
    columns of its row, all without any; so are rows whose id is blank.

    Ids that came with the data stay those of their keys in all later batches; they are looked up for the keys of this
    batch only. Each row is read and mapped once: where
    more than its values is taken from it, the mapped rows are written to a shared folder and all is taken from there, so
    edges, ids and rejects fit the values also if the source changes meanwhile. ``stage`` writes the source rows
    first, for those that are to be released early.
    """
    if on_bad_value not in (FAIL, REJECT):
        raise ValueError(f"on_bad_value is {FAIL!r} or {REJECT!r}")
    if not stage:
        return _integrate(rows, mapping, catalog, store, version, registry, on_bad_value, shown)
    path = shared_folder(store.spark, "staged-rows")
    try:
        return _integrate(written_to(rows, path), mapping, catalog, store, version, registry, on_bad_value, shown)
    finally:
        discard(store.spark, path)


def _integrate(
    rows: DataFrame,
    mapping: Mapping,
    catalog: Catalog,
    store: Store,
    version: int,
    registry: DataFrame | None,
    on_bad_value: str,
    shown: Sequence[str],
) -> dict[str, int]:
    # A batch may come in few files: its rows are dealt out before they are mapped, which makes several of each.
    rows = rows.hint("rebalance")
    properties = [p.type for d in mapping.definitions for p in d.properties]
    has_ids, has_binaries = ID_PROPERTY in properties, any(catalog.datatype(p) == "Binary" for p in properties)
    if on_bad_value == REJECT:
        fan = graph.with_printed_rows(rows, mapping, catalog, list(shown) or rows.columns)
    else:
        fan = graph.FanOut(rows, mapping, catalog, ())
    has_few = has_ids or registry is not None or store.has_given_ids(version)
    path = None
    if mapping.associations or has_few or has_binaries or on_bad_value == REJECT:
        path = shared_folder(store.spark, "mapped-rows")
    try:
        fan = fan.written_to(f"{path}/rows") if path else fan
        few_at = f"{path}/few-ids" if has_few else None
        return _written(fan, catalog, store, version, registry, on_bad_value, has_ids, has_binaries, few_at)
    finally:
        if path:
            discard(store.spark, path)


def _written(
    fan: graph.FanOut,
    catalog: Catalog,
    store: Store,
    version: int,
    registry: DataFrame | None,
    on_bad_value: str,
    has_ids: bool,
    has_binaries: bool,
    few_at: str | None,
) -> dict[str, int]:
    """Write all that mapped rows hold. ``few_at`` is a folder for the ids that are no hashes, where there may be any."""
    mapping = fan.mapping
    values = graph.values_of(fan, fail_on_bad_value=on_bad_value == FAIL).drop(graph.PRINTED)
    edges = graph.edges_of(fan) if mapping.associations else None
    edges = None if edges is None else edges.where(edges.destination != NO_OP)
    few = given = binaries = rejects = None
    if few_at is not None:
        few = _few_ids(values, edges, store, version, registry, has_ids, few_at)
    if has_ids:
        given = few.where(few.origin == ids.GIVEN)
        values = values.where(values.property != ID_PROPERTY)
    with_ids = ids.with_ids(values) if few is None else ids.with_few_ids(values, few.drop("origin"))
    if edges is not None:
        edges = ids.edge_ids(edges) if few is None else ids.edges_with_few_ids(edges, few.drop("origin"))
    if has_binaries:
        binaries = graph.to_destination(with_ids, BINARIES)
    if on_bad_value == REJECT:
        rejects = graph.rejects_of(fan)
    to_tables = with_ids.where(~with_ids.destination.isin(NO_OP, BINARIES))
    return store.write(
        version, to_tables, edges, mapping.update_types(), binaries, mapping.property_update_types(), given, rejects
    )


def _few_ids(
    values: DataFrame,
    edges: DataFrame | None,
    store: Store,
    version: int,
    registry: DataFrame | None,
    has_ids: bool,
    path: str,
) -> DataFrame:
    """Ids of the batch's keys that are no hashes, written once: those of earlier batches, of its own data, and registered."""
    keys = values.select(*ids.KEY)
    keys = keys if edges is None else keys.unionByName(ids.end_keys(edges))
    asked = written_to(filter_of(keys, ids.KEY), f"{path}/asked")
    sources = []
    if store.has_given_ids(version):
        sources.append((ids.KNOWN, store.given_ids_of(asked, version)))
    if has_ids:
        sources.append((ids.GIVEN, ids.explicit_ids(values)))
    if registry is not None:
        sources.append((ids.REGISTERED, registry))
    return written_to(ids.ids_of_keys(asked, sources), f"{path}/ids")


def run_all(
    plan: Sequence[tuple[Mapping, DataFrame]],
    catalog: Catalog,
    store: Store,
    version: int,
    job_id: str,
    log: str,
    shown: Sequence[str] = (),
    order: str | None = None,
    stage: bool = False,
    on_bad_value: str = FAIL,
    contacts: Iterable[str] = (),
) -> int:
    """Integrate several sources, one after the other, and log how it goes.

    Entity sets that a mapping needs and the catalog lacks are added before its run. A run logs what it wrote to each
    destination. Returns how many entities and edges were written. A failure ends the run and is logged;
    then, and where rows were rejected, the ``shown`` columns of the first rejected row by ``order`` are
    logged as well, if these are given. The rejects themselves are in the store.
    """
    spark, total = store.spark, 0
    for number, (mapping, rows) in enumerate(plan):
        batch = version + 2 * number
        missing = catalog.missing_sets(mapping, contacts)
        catalog = catalog.with_sets(missing)
        lines = ["started", *[f"added entity set {s.name}" for s in missing]]
        append_log(spark, log, job_id, mapping.name, lines, "IN_PROGRESS")

        def first_reject(mapping: Mapping = mapping, rows: DataFrame = rows, catalog: Catalog = catalog) -> list[str]:
            if not (shown and order):
                return []
            found = graph.rejects(rows, mapping, catalog, shown, keep=[order])
            return [f"first rejected row: {r.row}" for r in earliest_reject(found, order).collect()]

        try:
            counts = integrate(rows, mapping, catalog, store, batch, stage=stage, on_bad_value=on_bad_value, shown=shown)
        except Exception as e:
            append_log(spark, log, job_id, mapping.name, [f"{type(e).__name__}: {e}", *first_reject()], "FAILED")
            raise
        entities, edges = counts.get("entities", 0), counts.get("edges", 0)
        done = [
            f"integrated {entities} entities and {edges} edges",
            f"{TABLES}: {entities} entities, {counts.get('values', 0)} property values, {edges} edges",
        ]
        if "binaries" in counts:
            done.append(f"{BINARIES}: {counts['binaries']} property values")
        if counts.get("rejects"):
            done += [f"rejected {counts['rejects']} values and rows", *first_reject()]
        append_log(spark, log, job_id, mapping.name, done, "SUCCEEDED")
        total += entities + edges
    return total


def stream_into(
    rows: DataFrame,
    mapping: Mapping,
    catalog: Catalog,
    store: Store,
    checkpoint: str,
    first_version: int = 1,
    registry: DataFrame | None = None,
    available_now: bool = True,
    stage: bool = False,
    on_bad_value: str = FAIL,
    tidy: bool = True,
) -> StreamingQuery:
    """Start a query that integrates each batch of a streaming source.

    The version of a batch follows from its number, so a batch that is run again after a
    failure writes the same rows in the same place. How large a batch gets is set at
    the source, as with ``maxFilesPerTrigger``. ``stage`` and ``on_bad_value`` are those of
    :func:`integrate`. With ``tidy`` the stream merges batches of like size as it goes, so few are live however
    long it runs, and keeps the view of current values up.
    """

    def write(batch: DataFrame, number: int) -> None:
        integrate(batch, mapping, catalog, store, first_version + 2 * number, registry, stage, on_bad_value)
        if tidy:
            store.tidy()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
