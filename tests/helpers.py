"""Evaluate Columns on rows given in a test."""

from pyspark.sql import SparkSession


def evaluate(spark: SparkSession, rows, schema, *columns):
    """Results as a list of values, or of tuples for more than one column."""
    named = [c.alias(f"r{i}") for i, c in enumerate(columns)]
    found = [tuple(r) for r in spark.createDataFrame(rows, schema).select(*named).collect()]
    return [r[0] for r in found] if len(columns) == 1 else found


def on_texts(spark, column_of, *texts):
    """The results of ``column_of(c)`` on single texts."""
    from pyspark.sql import functions as F

    return evaluate(spark, [(t,) for t in texts], "c string", column_of(F.col("c")))
