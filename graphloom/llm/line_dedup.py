"""Line dedup that can be taken back: exact reference counts with cuckoo filters before them.

Every line of some length is a key. A table holds how many documents refer to a key, and
which of them has the largest id; it follows from a log of references in which a document's
insertion is +1 and its deletion -1, so taking documents out gives the state as if they had never
been there. The keys that count as repeated are also put in cuckoo filters, one for each shard
of the key space. A scan asks the filters first, so that lines which do not repeat, nearly all
of them, never reach a join; what passes is verified in the exact table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import ASCII_LOWER, QUERIES, groups, mapped, on_workers, table
from graphloom.llm.cuckoo import CuckooFilter
from graphloom.sources.scratch import found_by, shared_folder, written

_SPACE = " \t\n\v\f\r"
#: Shortest line, in code points of its key, that is looked at, and documents that make a key repeated.
MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of one filter, which is one task's work, and bytes of filters that are sent to every task.
SHARD_KEYS, MOST_FILTER_BYTES = 1 << 20, 128 << 20

COUNTS = "key_high bigint, key_low bigint, n_docs bigint, last_doc bigint"


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte key of a line, or None for a line that is too short."""
    line = line.strip(_SPACE)
    if len(line) < min_chars:
        return None
    return hashlib.md5(line.encode().translate(ASCII_LOWER), usedforsecurity=False).digest()


def _words(keys: list[bytes]) -> np.ndarray:
    """Keys as rows of two 64-bit words."""
    return np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)


def _numbers(keys: list[bytes]) -> list[np.ndarray]:
    return list(_words(keys).view(np.int64).T) if keys else [np.empty(0, np.int64)] * 2


def line_references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """For the documents of each batch: how many hold a key, and the largest id among these.

    Rows of ``docs`` are documents, ``doc_id`` and ``text``; each counts once per key. A document
    without an id counts, but is never the largest.
    """

    def refer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(b)):
            count: dict[bytes, int] = {}
            last: dict[bytes, int | None] = {}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None or len(text) < min_chars:
                    continue
                keys = {line_key(line, min_chars) for line in text.split("\n")}
                keys.discard(None)
                for key in keys:
                    count[key] = count.get(key, 0) + 1
                    known = last.get(key)
                    last[key] = doc if known is None or (doc is not None and doc > known) else known
            high, low = _numbers(list(count))
            arrays = [pa.array(high), pa.array(low), pa.array(count.values(), pa.int64()), pa.array(last.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key_high", "key_low", "n_docs", "last_doc"])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), refer, COUNTS)


def reference_counts(references: DataFrame) -> DataFrame:
    """The exact table: each key with its number of documents and the largest id."""
    return references.groupBy("key_high", "key_low").agg(
        F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
    )


def _shard(shards: int):
    return F.pmod(F.col("key_high"), F.lit(shards)).cast("int")


def build_filters(keys: DataFrame, n_keys: int) -> DataFrame:
    """A cuckoo filter (``shard``, ``shards``, ``filter``) for each of as many shards as hold the keys."""
    shards = max(1, -(-n_keys // SHARD_KEYS))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        keys = part[["key_high", "key_low"]].to_numpy(np.int64).view(np.uint64)
        made = CuckooFilter.of(keys).to_bytes()
        return pd.DataFrame({"shard": part["shard"].iloc[:1], "shards": shards, "filter": [made]})

    on_workers(keys.sparkSession)
    sharded = keys.select("key_high", "key_low", _shard(shards).alias("shard"))
    return sharded.groupBy("shard").applyInPandas(build, "shard int, shards int, filter binary")


class Filters:
    """All shards' filters as one set for lookups."""

    def __init__(self, rows: list):
        self.shards = max((r["shards"] for r in rows), default=1)
        self.by_shard = {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in rows}

    def likely(self, keys: list[bytes]) -> np.ndarray:
        words, found = _words(keys), np.zeros(len(keys), bool)
        shard = words[:, 0].view(np.int64) % self.shards
        for number, cuckoo in self.by_shard.items():
            own = np.flatnonzero(shard == number)
            found[own] = cuckoo.found(words[own])
        return found


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS, filters: DataFrame | None = None) -> DataFrame:
    """``doc_id`` and the distinct keys of each row of ``docs``; with ``filters`` those that may be in them."""
    shared = None
    if filters is not None:
        shared = docs.sparkSession.sparkContext.broadcast(Filters(filters.collect()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared else None
        for batch in (g for b in batches for g in groups(b)):
            ids: list[int | None] = []
            keys: list[bytes] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {line_key(line, min_chars) for line in (text or "").split("\n")}
                own.discard(None)
                ids += [doc] * len(own)
                keys += own
            if known is not None and keys:
                kept = np.flatnonzero(known.likely(keys))
                ids, keys = [ids[i] for i in kept], [keys[i] for i in kept]
            high, low = _numbers(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(high), pa.array(low)], names=["doc_id", "key_high", "key_low"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(rows, probe, "doc_id bigint, key_high bigint, key_low bigint")


def repeated_lines(docs: DataFrame, repeated: DataFrame, filters: DataFrame | None, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` and key of the lines that documents have to lose by the exact table ``repeated``."""
    lost = F.col("doc_id").isNull() | F.col("last_doc").isNull() | (F.col("doc_id") < F.col("last_doc"))
    found = line_keys(docs, min_chars, filters).join(repeated, ["key_high", "key_low"])
    return found.where(lost).select("doc_id", "key_high", "key_low")


def drop_lines(docs: DataFrame, lost: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows: their other columns as a struct ``row``, ``text`` without its lost lines, ``n_lines`` and ``n_dropped``."""
    # The keys of a document are gathered as one binary: bounded by its own lines.
    keys = lost.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("key_high", "key_low"))).alias("lost"))
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    rows = docs.select(
        rest.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    joined = rows.join(keys.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    flat = joined.select("row", "text", F.col("lost.key_high").alias("high"), F.col("lost.key_low").alias("low"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(b)):
            texts, lines, dropped = [], [], []
            columns = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for text, high, low in zip(*columns):
                parts = (text or "").split("\n")
                kept = parts
                if high:
                    gone = {k.tobytes() for k in np.array([high, low], np.int64).T.astype(">i8")}
                    kept = [p for p in parts if line_key(p, min_chars) not in gone]
                texts.append(text if len(kept) == len(parts) else "\n".join(kept))
                lines.append(len(parts))
                dropped.append(len(parts) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    schema = f"row {flat.schema['row'].dataType.simpleString()}, text string, n_lines bigint, n_dropped bigint"
    return mapped(flat, drop, schema)


def _dedup(docs: DataFrame, counts: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    repeated = written(counts.where(F.col("n_docs") >= min_docs), "repeated-lines")
    n_keys = repeated.count()
    # Six bytes a key, up to twelve where the size is rounded up to a power of two.
    filters = build_filters(repeated, n_keys) if 12 * n_keys <= MOST_FILTER_BYTES else None
    return drop_lines(docs, repeated_lines(docs, repeated, filters, min_chars), min_chars)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row: its other columns as ``row``, its ``text`` after dedup, ``n_lines`` and ``n_dropped``.

    A line is what stands between ``\\n``; its key has white space stripped and A-Z lowered.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose
    all their lines but those of the largest ``doc_id`` that holds them. Rows are documents:
    repeated rows count each, and rows that share the largest id all keep their lines. Rows with
    a null id count, and lose their lines. Null and empty texts have one empty line; a
    null text stays null. Where the filters would take more than ``MOST_FILTER_BYTES``, all
    lines go to the exact table.
    """
    return _dedup(docs, reference_counts(line_references(docs, min_chars)), min_chars, min_docs)


class LineIndex:
    """Reference counts and filters of a corpus that grows and shrinks, in a folder.

    ``log`` has one row per change, document and key; ``insert`` and ``delete`` append to it under a
    batch number that the caller gives, and a batch that is written again replaces itself.
    ``filters`` are brought up to date by the keys that became repeated or ceased to be, and built anew
    when keys outgrow them. The log is all that lasts: an index that is opened on a folder with
    one derives the rest from it, and one without any batch finds nothing repeated.
    """

    LOG = "key_high bigint, key_low bigint, doc_id bigint, change bigint, batch bigint"

    def __init__(self, spark: SparkSession, path: str | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.path = path or shared_folder(spark, "line-index")
        self.filters: DataFrame | None = None
        self.repeated: DataFrame | None = None
        self.room = 0

    def _append(self, docs: DataFrame, change: int, batch: int) -> None:
        changes = line_keys(docs, self.min_chars).distinct().withColumn("change", F.lit(change).cast("long"))
        changes.write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")
        self._follow()

    def _follow(self) -> None:
        """Bring filters and repeated keys up to the log; both change together or not at all."""
        repeated = written(self.counts().where(F.col("n_docs") >= self.min_docs), "repeated-lines")
        n_keys = repeated.count()
        filters = None
        if self.repeated is not None and n_keys <= self.room:
            filters = written(self._refreshed(self.repeated, repeated), "line-filters")
            if not filters.where(F.col("filter").isNull()).isEmpty():
                filters = None
        if filters is None:
            # Room for a third more, beyond which the filters are built anew.
            self.room = n_keys * 4 // 3
            filters = written(build_filters(repeated, n_keys), "line-filters")
        self.repeated, self.filters = repeated, filters

    def insert(self, docs: DataFrame, batch: int) -> None:
        """Add documents (``doc_id``, ``text``) that are not in yet."""
        self._append(docs, 1, batch)

    def delete(self, docs: DataFrame, batch: int) -> None:
        """Take out documents that are in, given with the same ids and texts."""
        self._append(docs, -1, batch)

    def counts(self) -> DataFrame:
        begun = found_by(self.spark, f"{self.path}/log/batch=*")
        log = self.spark.read.schema(self.LOG).parquet(f"{self.path}/log") if begun else self.spark.createDataFrame([], self.LOG)
        held = log.groupBy("key_high", "key_low", "doc_id").agg(F.sum("change").alias("n")).where("n > 0")
        return held.groupBy("key_high", "key_low").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))

    def _refreshed(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The filters with the keys that became repeated and without those that no longer are; null where one is full."""
        key = ["key_high", "key_low"]
        shards = self.filters.agg(F.max("shards")).first()[0] or 1
        added = new.join(old, key, "left_anti").select(*key, F.lit(1).alias("change"))
        gone = old.join(new, key, "left_anti").select(*key, F.lit(-1).alias("change"))
        changes = added.union(gone).withColumn("shard", _shard(shards))

        def apply(group: tuple, filters: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            words = part[key].to_numpy(np.int64).view(np.uint64)
            change = part["change"].to_numpy()
            cuckoo = CuckooFilter.from_bytes(filters["filter"].iloc[0]) if len(filters) else CuckooFilter.of(words[:0])
            cuckoo.delete(words[change < 0])
            made = cuckoo.to_bytes() if cuckoo.insert(words[change > 0]) else None
            return pd.DataFrame({"shard": [group[0]], "shards": [shards], "filter": [made]})

        both = self.filters.groupBy("shard").cogroup(changes.groupBy("shard"))
        return both.applyInPandas(apply, "shard int, shards int, filter binary")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """As :func:`dedup_lines`, by the counts of this index, also where another session wrote it."""
        if self.repeated is None:
            self._follow()
        size = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        filters = self.filters if size <= MOST_FILTER_BYTES else None
        return drop_lines(docs, repeated_lines(docs, self.repeated, filters, self.min_chars), self.min_chars)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ORACLE = rf"""
WITH lines AS (
  SELECT doc_id, i, p, translate(trim(p, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_UPPER.lower()}') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS p,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
keys AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= {MIN_CHARS}
         GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*)::bigint AS n_lines, count(*) FILTER (WHERE doc_id < last)::bigint AS n_dropped,
       sha256(coalesce(string_agg(p, chr(10) ORDER BY i) FILTER (WHERE last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM lines LEFT JOIN keys USING (k) GROUP BY doc_id"""


@QUERIES.add("op1_line_dedup", _ORACLE)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))
