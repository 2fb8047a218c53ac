"""Counts per destination, duplicate handling, and the earliest rejected row."""

from __future__ import annotations

from collections.abc import Mapping as MappingType, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.operators.ids import KEY


def distinct_values(values: DataFrame) -> DataFrame:
    """Union of the value sets of all rows: each value of an entity and property once."""
    return values.select(*KEY, "property", "destination", "value", "content").distinct()


def last_row_wins(values: DataFrame, order: str | Sequence[str]) -> DataFrame:
    """Of each entity keep the values of its last row by the columns of ``order``.

    The columns are compared one after the other, and a null comes before any value, so an entity
    without an order keeps its values. Rows that tie in all of them count as one row: to have one
    of several rows win, let the last columns be ones that tell rows apart, in the end all of a row's.
    The join is on key and order, which spreads the rows of a hot entity.
    """
    columns = [order] if isinstance(order, str) else list(order)
    last = values.groupBy(*KEY).agg(F.max(F.struct(*columns)).alias("last"))
    ends = last.select(*[F.col(c).alias(f"__{c}") for c in KEY], *[F.col("last").getField(c).alias(f"__{c}") for c in columns])
    same = [values[c].eqNullSafe(ends[f"__{c}"]) for c in (*KEY, *columns)]
    return values.join(ends, reduce(and_, same), "left_semi")


def counts_by_destination(values: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Rows (destination, entities, property_values, edges)."""
    per_entity = values.groupBy("destination", *KEY).agg(F.count("*").alias("n"))
    totals = per_entity.groupBy("destination").agg(
        F.count("*").alias("entities"), F.sum("n").alias("property_values")
    )
    if edges is None:
        return totals.withColumn("edges", F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    edge_totals = edges.distinct().groupBy("destination").agg(F.count("*").alias("edges"))
    both = totals.withColumn("edges", zero).unionByName(
        edge_totals.select("destination", zero.alias("entities"), zero.alias("property_values"), "edges")
    )
    return both.groupBy("destination").agg(
        *[F.sum(c).alias(c) for c in ("entities", "property_values", "edges")]
    )


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows with a counter that is filled when they are written."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def batch_counts(df: DataFrame, rows_per_batch: int) -> DataFrame:
    """One row (rows, batches): how many rows there are, and batches of the given size."""
    rows = df.agg(F.count("*").alias("rows"))
    return rows.withColumn("batches", F.ceil(F.col("rows") / rows_per_batch))


def earliest_reject(rejects: DataFrame, order: str) -> DataFrame:
    """The rejected row that comes first by ``order``, as one row."""
    first = F.min(F.struct(order, "row", "alias", "property", "reason"))
    return rejects.agg(first.alias("first")).where("first is not null").select("first.*")


def labelled(entity_set: Column, labels: MappingType[str, str]) -> Column:
    """A label per entity set, such as its update type; null for a set without one."""
    if not labels:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), entity_set)


def binaries_by_update_type(values: DataFrame, property_update_types: MappingType[str, str]) -> DataFrame:
    """Rows (property_update_type, binaries, bytes) over the binary values."""
    return (
        values.where(F.col("content").isNotNull())
        .groupBy(labelled(F.col("entity_set"), property_update_types).alias("property_update_type"))
        .agg(F.count("*").alias("binaries"), F.sum(F.length("content")).alias("bytes"))
    )
