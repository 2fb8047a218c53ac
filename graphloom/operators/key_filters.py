"""Filters of keys: bitmaps over their hashes, of a fixed size whatever the number of keys.

A filter is a table (slice, bits) of at most ``SLICES`` rows with ``BITS`` bits each, 4 MB in all, so it is
broadcast to any number of rows. It never misses a key; keys that it wrongly lets through are
sorted out by the join that follows. It tells keys apart well up to some ten million of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 1024
#: As many bits as Spark's bitmap functions have.
BITS = 32768


def key_slice(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLICES)).cast("int")


def key_bit(key: Sequence[str]) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(*key), 20), F.lit(BITS))


def filter_of(rows: DataFrame, key: Sequence[str], *by: str) -> DataFrame:
    """The keys of rows as one bitmap for each slice, and whatever else it is ``by``."""
    bits = rows.select(key_slice(key).alias("slice"), key_bit(key).alias("bit"), *by)
    return bits.groupBy("slice", *by).agg(F.bitmap_construct_agg("bit").alias("bits"))


def united(filters: DataFrame) -> DataFrame:
    """Filters of parts as the filter of all."""
    return filters.groupBy("slice").agg(F.bitmap_or_agg("bits").alias("bits"))


def met(parts: DataFrame, asked: DataFrame, by: str, *on: str) -> DataFrame:
    """The distinct ``by`` of the filters of parts that may share a key with the filter ``asked``."""
    both = parts.join(asked.withColumnRenamed("bits", "asked"), [*on, "slice"])
    # Two bitmaps meet where their union has fewer bits than both together.
    each = both.select(by, "slice", F.explode(F.array("bits", "asked")).alias("bits"))
    sizes = each.groupBy(by, "slice").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("together"), F.sum(F.bitmap_count("bits")).alias("apart")
    )
    return sizes.where(F.col("together") < F.col("apart")).select(by).distinct()


def marked(rows: DataFrame, key: Sequence[str], filters: DataFrame, out: str) -> DataFrame:
    """Rows with a boolean column: whether a filter (one row for each slice) may hold their key."""
    held = filters.select(F.col("slice").alias("__slice"), F.col("bits").alias("__bits"))
    bit = key_bit(key)
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    joined = rows.withColumn("__slice", key_slice(key)).join(F.broadcast(held), "__slice", "left")
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__slice", "__bits")


def kept_by(rows: DataFrame, key: Sequence[str], filters: DataFrame) -> DataFrame:
    """Rows whose key a filter may hold."""
    return marked(rows, key, filters, "__held").where("__held").drop("__held")
