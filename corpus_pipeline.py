"""A corpus pipeline over ``documents``: each stage works on what the one before has kept.

Stages get the session, the documents so far and the folder of tables, and return the columns of
``documents``, but for the last, which returns the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import table
from graphloom.llm.decontaminate import decontaminate
from graphloom.llm.language_id import UNKNOWN, fit, held_out, identify
from graphloom.llm.line_dedup import dedup_lines
from graphloom.llm.packing import pack
from graphloom.llm.pieces import vocabulary_path
from graphloom.llm.shingle_join import near_duplicates
from graphloom.sources.scratch import shared_folder, written

#: Documents whose language the network is less sure of are rejected.
MIN_SCORE = 0.4
#: Near duplicates share this many percent of their shingles of so many words.
PERCENT, SHINGLE_WORDS = 80, 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the network recognises; texts without letters go."""
    found = identify(docs, fit(docs, ~held_out()))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat in later ones; a document that had nothing else goes."""
    kept = dedup_lines(docs)
    rest = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\s]")
    columns = [_after_dedup(c) for c in docs.columns]
    return kept.where(rest).select(*columns)


def _after_dedup(name: str) -> Column:
    """A column of the documents; text and, where lines were dropped, its length are those after dedup."""
    before = F.col("row").getField(name)
    if name == "text":
        return F.col("text")
    if name == "n_chars":
        return F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(before.cast("long")).alias(name)
    return before.alias(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id; texts without words stay.

    Rows are numbered, so a group whose ids are null or repeat keeps one row as well: null ids come last, and of equal
    ids the first row stays.
    """
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    groups = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), SHINGLE_WORDS, PERCENT)
    named = groups.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"].alias("__row"))
    return rows.join(first.select("__row"), "__row", "left_semi").drop("__row")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens that all documents are packed into."""
    return pack(docs, vocabulary_path("byte_bpe_50k.json")).drop("ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: No SQL runs a trained network; each stage is tested against a plain version on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
