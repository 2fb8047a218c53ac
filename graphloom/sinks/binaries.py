"""Binary values stored under their hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def binary_rows(values: DataFrame) -> DataFrame:
    """Rows (entity_set, key_id, property, hash, content), each binary of a property once."""
    if not isinstance(values.schema["content"].dataType, T.BinaryType):
        raise ValueError("binary values must be bytes")
    rows = values.where(F.col("content").isNotNull()).select(
        "entity_set", "key_id", "property", F.sha2("content", 256).alias("hash"), "content"
    )
    return rows.distinct()


def write_binaries(values: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows = binary_rows(values).hint("rebalance", "entity_set")
    rows.write.mode(mode).partitionBy("entity_set").parquet(path)


def read_binaries(spark: SparkSession, path: str) -> DataFrame:
    schema = "key_id string, property string, hash string, content binary, entity_set string"
    return spark.read.schema(schema).parquet(path)
