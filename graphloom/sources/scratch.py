"""A fresh folder that every executor can reach, for tables that a query writes and reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a session in one process may do without that setting: its tasks share the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="graphloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in a shared folder, which outlives the loss of executors."""
    return written_to(rows, shared_folder(rows.sparkSession, name))


def written_to(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def found_by(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with wildcards."""
    there, fs = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(there) or ()]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    there, fs = _file_system(spark, path)
    fs.delete(there, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    there, fs = _file_system(spark, path)
    stream = fs.open(there)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small text file as a whole, or leave things as they are where there is one; whether it was made.

    The text is written aside and renamed, and a rename does not replace a file. Two writers can't both succeed
    where the file system renames in one step, as HDFS does.
    """
    there, fs = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.exists(there):
        return False
    aside = jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    plain = spark.sparkContext._gateway.new_array(kind, 1)
    plain[0] = kind.NONE
    try:
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), fs.getConf())
        files.rename(aside, there, plain)
    except Exception:
        if fs.exists(aside):
            fs.delete(aside, False)
        if fs.exists(there):
            return False
        raise
    return True
