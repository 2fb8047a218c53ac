"""CSV and XML files, on a local path or in an object store."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.steps import Condition
from graphloom.sources.rows import flattened, kept
from graphloom.sources.scratch import found_by, written


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *conditions: Condition,
    multi_line: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """CSV with a header row; every value is text, an empty field is the empty text.

    Rows with more or fewer fields than the header end the query, and so does a file whose
    header differs from that of the first one, or a data file with a name that Spark takes as hidden. Spark splits large files between tasks; where a
    quoted field holds line breaks, ``multi_line`` has to be set, and a file is one task.
    """
    for one in [path] if isinstance(path, str) else path:
        _refuse_hidden(spark, one, below=False)
    reader = spark.read.option("header", True).option("inferSchema", False)
    reader = reader.option("mode", "FAILFAST").option("enforceSchema", False)
    # Only a parser that looks at all fields sees that a row has too many.
    reader = reader.option("columnPruning", False)
    reader = reader.option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.csv(path)
    names = [("`" + n.replace("`", "``") + "`", n) for n in rows.columns]
    texts = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in names])
    return kept(texts, *conditions)


def _xml_reader(spark: SparkSession, row_tag: str, schema: T.StructType | str | None):
    """A reader that a broken file ends, and that knows no column but the elements'."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    reader = reader.option("attributePrefix", "").option("inferSchema", False).option("mode", "FAILFAST")
    return reader if schema is None else reader.schema(schema)


def _refuse_hidden(spark: SparkSession, pattern: str, below: bool, region: str | None = None) -> None:
    """Raise where Spark would pass over a file because a part of its name starts with a dot or underscore.

    Markers and checksums that writers leave are no data and may be there. The file system looks for such names
    itself, level by level; only those that it finds come to the driver's Python.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    if region is not None:
        conf.set("fs.s3a.endpoint.region", region)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = make(pattern).getFileSystem(conf)

    def own(name: str) -> bool:
        return name[:1] in ("_", ".") and name != "_SUCCESS" and not (name[0] == "." and name.endswith(".crc"))

    def refuse(statuses) -> None:
        for status in statuses or ():
            if own(status.getPath().getName()):
                found = status.getPath().toString()
                raise ValueError(f"{found}: names that start with a dot or an underscore are not read; rename it")

    parent, _, last = pattern.rpartition("/")
    if last[:1] in ("_", "."):
        refuse(fs.globStatus(make(pattern)))
    elif last[:1] in ("*", "?", "["):
        refuse(fs.globStatus(make(f"{parent}/[._]*")))
    level = pattern
    while True:
        refuse(fs.globStatus(make(f"{level}/[._]*")))
        level += "/*"
        if not below or not len(fs.globStatus(make(level)) or ()):
            return


def read_xml(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    only: str | None = "*.xml",
    schema: T.StructType | str | None = None,
    keep_empty_files: bool = True,
) -> DataFrame:
    """XML whose elements ``row_tag`` are the rows: the root element for one row per file.

    A folder gives its own files that match ``only``, not those in folders below. Nested
    elements become columns with dotted names. Without a schema the files are read
    twice, the first time for the names of their elements. A file that is no XML ends the query, and so
    does a data file with a name that Spark takes as hidden. Spark does not split XML: a file is one task.
    """
    for one in [path] if isinstance(path, str) else path:
        _refuse_hidden(spark, one, below=False)
    reader = _xml_reader(spark, row_tag, schema).option("recursiveFileLookup", False)
    if only is not None:
        reader = reader.option("pathGlobFilter", only)
    rows = reader.load(path)
    if not keep_empty_files:
        rows = rows.where(F.col("_metadata.file_size") > 0)
    return flattened(rows)


def read_local(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A file, or all files right in a folder whatever their endings, as XML."""
    return read_xml(spark, path, row_tag, only=None, schema=schema)


def read_object_store(
    spark: SparkSession,
    root: str,
    row_tag: str,
    prefix: str = "",
    schema: T.StructType | str | None = None,
    region: str | None = None,
) -> DataFrame:
    """XML objects under ``root`` (such as ``s3a://bucket``) whose key starts with ``prefix``.

    Empty objects are left out. An empty prefix reads all of the bucket. An object that is no XML, or
    whose key has a part that Spark takes as hidden, ends the query.
    """
    path = _prefixed(root, prefix)
    _refuse_hidden(spark, path, below=True, region=region)
    # Keys have no folders: everything that starts with the prefix counts, at any depth.
    reader = _xml_reader(spark, row_tag, schema).option("recursiveFileLookup", True)
    if region is not None:
        reader = reader.option("fs.s3a.endpoint.region", region)
    return flattened(reader.load(path).where(F.col("_metadata.file_size") > 0))


def _prefixed(root: str, prefix: str) -> str:
    """A pattern for all keys that start with a prefix, in which nothing but the end stands for more."""
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", prefix)
    return f"{root.rstrip('/')}/{literal}*"


def list_objects(spark: SparkSession, root: str, prefix: str = "", region: str | None = None) -> DataFrame:
    """``key``, ``size`` and ``modified`` of the objects whose key starts with ``prefix``, without their content.

    Spark lists them, in tasks where there are many folders, and leaves out empty ones.
    """
    path = _prefixed(root, prefix)
    _refuse_hidden(spark, path, below=True, region=region)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if region is not None:
        reader = reader.option("fs.s3a.endpoint.region", region)
    return reader.load(path).select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


class Ledger:
    """Which objects have been read, as a table of their keys, sizes and times.

    An object that has changed since counts as a new one. Objects are added when what was made of them is safe, so after a
    failure they are read again.
    """

    _SCHEMA = "key string, size bigint, modified timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def objects(self) -> DataFrame:
        if not found_by(self.spark, f"{self.path}/part-*"):
            return self.spark.createDataFrame([], self._SCHEMA)
        return self.spark.read.schema(self._SCHEMA).parquet(self.path)

    def unread(self, listed: DataFrame) -> DataFrame:
        """The listed objects that are not in the ledger as they are now."""
        return listed.join(self.objects(), ["key", "size", "modified"], "left_anti")

    def add(self, objects: DataFrame) -> None:
        self.unread(objects).write.mode("append").parquet(self.path)


def read_new_objects(
    spark: SparkSession,
    root: str,
    row_tag: str,
    ledger: Ledger,
    schema: T.StructType | str,
    prefix: str = "",
    region: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of XML objects that the ledger does not have, and these objects, to be added to it in the end.

    What is new is settled now: objects that come later are left to the next read.
    """
    listed = written(ledger.unread(list_objects(spark, root, prefix, region)), "new-objects")
    keys = [r["key"] for r in listed.select("key").orderBy("key").toLocalIterator()]
    if not keys:
        rows = spark.createDataFrame([], T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    else:
        reader = _xml_reader(spark, row_tag, schema)
        if region is not None:
            reader = reader.option("fs.s3a.endpoint.region", region)
        # A name is no pattern here.
        rows = reader.load([re.sub(r"([\[\]{}*?\\])", r"\\\1", k) for k in keys])
    return flattened(rows), listed
