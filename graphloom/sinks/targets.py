"""Named targets, the sink that writes nothing, and the run log."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The stores a run can name.
STORES = ("ALPR", "AURORA", "NONE", "POSTGRES")
LOG_SCHEMA = (
    "job_id string, name string, log array<string>, time_logged timestamp, status string"
)
STATUSES = ("IN_PROGRESS", "SUCCEEDED", "FAILED")


def target_options(store: str, config: Mapping[str, Mapping[str, Any]]) -> Mapping[str, Any]:
    """Write options of a store: ALPR and AURORA have their own, all others share POSTGRES."""
    if store not in STORES:
        raise ValueError(f"unknown store {store!r}")
    return config.get(store.lower() if store in ("ALPR", "AURORA") else "postgres", {})


def write_target(rows: DataFrame, store: str, config: Mapping[str, Mapping[str, Any]]) -> None:
    """Append rows to a named store. ``format`` and ``path`` or JDBC options come from its
    configuration; ``NONE`` writes nothing."""
    if store == "NONE":
        write_nothing(rows)
        return
    options = dict(target_options(store, config))
    kind = options.pop("format", "parquet")
    rows.write.format(kind).mode("append").options(**options).save()


def write_nothing(rows: DataFrame) -> int:
    """Compute all rows and write none; the count of written rows is 0."""
    rows.write.format("noop").mode("overwrite").save()
    return 0


def log_rows(job_id: Column, name: Column, log: Column, time_logged: Column, status: Column) -> list[Column]:
    """The columns of a run log record; ``log`` is a list of lines."""
    return [
        job_id.cast("string").alias("job_id"),
        name.alias("name"),
        F.array_distinct(log).alias("log"),
        time_logged.alias("time_logged"),
        status.alias("status"),
    ]


def append_log(
    spark: SparkSession, path: str, job_id: str, name: str, lines: list[str], status: str
) -> None:
    """Append one record to the run log."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    made = spark.range(1).select(
        *log_rows(
            F.lit(job_id), F.lit(name), F.array(*map(F.lit, lines)), F.current_timestamp(), F.lit(status)
        )
    )
    made.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
