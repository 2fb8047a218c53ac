"""One entry for all sources."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from graphloom.sources.files import read_csv, read_local, read_object_store, read_xml
from graphloom.sources.jdbc import read_jdbc


def read_source(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """Read the source that a spec names; exactly one kind may be named.

    ``{"datasource": {...}, "sql": ..., "fetch_size": ...}``, with ``split_on``, ``lower``, ``upper`` and
    ``splits`` for a read in several tasks, ``{"csv": path, "multi_line": ...}``,
    ``{"xml": path, "row_tag": ...}``, or XML with an origin:
    ``{"xml": True, "row_tag": ..., "origin": ["S3", region, root, prefix]}`` and
    ``{"xml": True, "row_tag": ..., "origin": ["local", path]}``. A ``schema`` saves XML and CSV a
    look at the files for the names of their columns.
    """
    if "datasource" in spec or "sql" in spec:
        for needed in ("datasource", "sql"):
            if not spec.get(needed):
                raise ValueError(f"a JDBC source needs {needed}")
        for other in ("csv", "xml", "origin"):
            if other in spec:
                raise ValueError(f"a JDBC source excludes {other}")
        options = {k: spec[k] for k in ("fetch_size", "split_on", "lower", "upper", "splits") if k in spec}
        return read_jdbc(spark, spec["datasource"], spec["sql"], **options)
    schema = spec.get("schema")
    if "csv" in spec:
        for other in ("xml", "origin"):
            if other in spec:
                raise ValueError(f"a CSV source excludes {other}")
        return read_csv(spark, spec["csv"], multi_line=bool(spec.get("multi_line")), schema=schema)
    if "xml" in spec:
        if not spec.get("row_tag"):
            raise ValueError("an XML source needs row_tag")
        if "origin" not in spec:
            return read_xml(spark, spec["xml"], spec["row_tag"], schema=schema)
        kind, *rest = spec["origin"]
        if kind == "S3":
            if len(rest) < 2:
                raise ValueError("an S3 origin needs region, root and, if wanted, a prefix")
            return read_object_store(spark, rest[1], spec["row_tag"], *rest[2:3], schema=schema, region=rest[0])
        if kind == "local":
            if not rest:
                raise ValueError("a local origin needs a path")
            return read_local(spark, rest[0], spec["row_tag"], schema)
        raise ValueError(f"unknown origin {kind!r}")
    raise ValueError("a source needs one of datasource, csv and xml")
