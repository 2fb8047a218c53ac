"""Hashes: of columns, of property values, and of keys as UUID text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "\x1f"


def hash_columns(columns: Sequence[Column], kind: str = "murmur128", separator: str = "") -> Column:
    """Hash of joined columns.

    Spark has no 128-bit murmur hash; ``murmur128`` gives the 128-bit MD5 instead.
    """
    text = F.concat_ws(separator, *columns)
    if kind in ("murmur128", "md5"):
        return F.md5(text)
    if kind == "sha256":
        return F.sha2(text, 256)
    if kind == "xxhash64":
        return F.lower(F.hex(F.xxhash64(text)))
    raise ValueError(f"unknown hash {kind!r}")


def value_hash(c: Column) -> Column:
    """Identity of a property value, as 32 bytes."""
    return F.unhex(F.sha2(c, 256))


def key_id(entity_set: Column, entity_id: Column) -> Column:
    """UUID text of an entity key; the same key has the same id on every run and node."""
    digest = F.md5(F.concat(entity_set, F.lit(KEY_SEPARATOR), entity_id))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
