"""Benchmark decontamination: windows of benchmark words are looked up in all document windows.

The benchmark's n-grams are normalised, hashed and sent to every task as a set of bounded
size. A task hashes all words of its texts and all their windows with array operations, takes
the windows whose hash is in the set, and compares these word by word, so that
no hash collision counts. A benchmark with more windows than the bound is worked off in parts,
one scan for each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, groups, mapped, table
from graphloom.llm.words import ALPHANUMERIC, Words

#: Words of a window.
WINDOW = 10
#: Windows of the benchmark that are sent to the tasks at once: some 100 MB at most.
MOST_WINDOWS = 500_000

class WindowSet:
    """Normalised windows with the items that hold them, for lookup by hash."""

    def __init__(self, windows: dict[tuple[int, bytes], list[str | None]]):
        by_size: dict[int, list[bytes]] = defaultdict(list)
        for size, text in windows:
            by_size[size].append(text)
        self.items = windows
        self.hashes, self.seen = {}, {}
        for size, texts in by_size.items():
            words = Words(pa.array([t.decode() for t in texts], pa.string()), ALPHANUMERIC)
            _, hashes = words.windows(size)
            self.hashes[size] = np.unique(hashes)
            self.seen[size] = np.zeros(1 << 22, bool)
            self.seen[size][hashes & np.uint64((1 << 22) - 1)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[str | None]]]:
        """First word, size and items of each window that is in the set."""
        for size, known in self.hashes.items():
            firsts, hashes = words.windows(size)
            likely = np.flatnonzero(self.seen[size][hashes & np.uint64((1 << 22) - 1)])
            at = np.searchsorted(known, hashes[likely])
            found = likely[known[np.minimum(at, len(known) - 1)] == hashes[likely]]
            for first in firsts[found]:
                items = self.items.get((size, words.joined(first, size)))
                if items is not None:
                    yield int(first), size, items


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, text: str = "text", key: str = "item_id") -> DataFrame:
    """Each window (``size``, ``window``) of the items once, with the sorted ``items`` that hold it.

    An item with fewer words than a window, but not none, is one window. Null texts have none.
    """
    lowered = F.translate(F.col(text), "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123))))
    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    firsts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        benchmark.select(F.col(key).cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.explode(F.transform(firsts, lambda i: F.slice("words", i, size))).alias("w"))
        .groupBy(F.size("w").alias("size"), F.array_join("w", " ").alias("window"))
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _scan(docs: DataFrame, part: DataFrame) -> DataFrame:
    """Add the hits of a part of the benchmark to ``hits`` and ``items`` of each row."""
    found = {(r["size"], r["window"].encode()): r["items"] for r in part.toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(found))
    columns = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (g for b in batches for g in groups(b)):
            words = Words(batch.column("text"), ALPHANUMERIC)
            hit = batch.column("hits").to_pylist()
            items = batch.column("items").to_pylist()
            marks = [set(h) for h in hit]
            names = [set(i) for i in items]
            for first, size, own in known.hits(words):
                t = int(words.text[first])
                marks[t].update(range(first - words.first[t], first - words.first[t] + size))
                names[t].update(i for i in own if i is not None)
            arrays = {c: batch.column(c) for c in columns}
            arrays["hits"] = pa.array([sorted(m) for m in marks], pa.list_(pa.int32()))
            arrays["items"] = pa.array([sorted(n) for n in names], pa.list_(pa.string()))
            arrays["n_words"] = pa.array(np.diff(words.first), pa.int64())
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], names=columns)

    return mapped(docs, scan, docs.schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    size: int = WINDOW,
    most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """All rows of ``docs``: their other columns as a struct ``row``, ``text``, ``n_words``, ``hits`` (numbers of
    the words that lie in a benchmark window) and ``items`` (ids of the items, as sorted strings).

    Null and empty texts have no words and no hits. Repeated rows are judged one by one. An item
    with a null id still marks words, but is not listed. The benchmark is counted first: up to
    ``most_windows`` of its windows are sent to the tasks at once, and a larger one is
    split by hash into as many scans as it takes.
    """
    windows = benchmark_windows(benchmark, size)
    parts = max(1, -(-windows.count() // most_windows))
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text])
    rows = docs.select(
        rest.alias("row"), F.col(text).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    for part in range(parts):
        rows = _scan(rows, windows.where(F.pmod(F.xxhash64("size", "window"), F.lit(parts)) == part))
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop: str = "documents", size: int = WINDOW) -> DataFrame:
    """``docs`` without what the benchmark holds: whole ``documents`` with a hit, or ``spans``.

    With ``spans``, the text of each run of hit words goes, from its first to its last
    byte, and the documents stay. Rows without a hit stay as they are; null texts stay null.
    """
    if drop not in ("documents", "spans"):
        raise ValueError("drop is documents or spans")
    found = contamination(docs, benchmark, size=size)
    columns = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    if drop == "documents":
        return found.where(F.size("hits") == 0).select(*columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(b)):
            words = Words(batch.column("text"), ALPHANUMERIC)
            texts = batch.column("text").to_pylist()
            for i, hits in enumerate(batch.column("hits").to_pylist()):
                if not hits:
                    continue
                raw, kept, at = texts[i].encode(), [], 0
                runs = np.split(np.array(hits), np.flatnonzero(np.diff(hits) > 1) + 1)
                for run in runs:
                    start, end = words.first[i] + run[0], words.first[i] + run[-1]
                    kept.append(raw[at : words.starts[start] - words.bounds[i]])
                    at = words.ends[end] - words.bounds[i]
                texts[i] = b"".join([*kept, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    schema = f"row {found.schema['row'].dataType.simpleString()}, text string"
    cleaned = mapped(found.select("row", "text", "hits"), cut, schema)
    return cleaned.select(*columns)


_ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bench AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS size,
               unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bench),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM words, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, places.size, i, item_id FROM places JOIN bench ON places.g = bench.g AND places.size = bench.size),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit
         FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::varchar AS x FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""


@QUERIES.add("op6_decontamination", _ORACLE)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
