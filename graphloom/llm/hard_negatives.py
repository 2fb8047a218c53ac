"""Hard negatives by a secondary sort.

An anchor's positives are its nearest rows of the same label, and the hard negatives of a positive
are the nearest rows of other labels whose score is a little below that of the positive. Pair scores are packed
into keys (anchor, descending score, positives first, id). The keys are dealt by anchor and sorted
within partitions, and one pass over each partition opens a window at every positive and fills all open ones with the
negatives that follow. It keeps the windows of one anchor, never its pairs.

Only pairs that can be in a result are packed. Rows are cut into chunks; anchors go past each chunk twice, first for
the best positives of each chunk, then, with the positives of all chunks known, for the first negatives of
each window. The rows of a chunk come first in a sorted stream and the anchors after them, so a task holds one
chunk and a batch of anchors, and anchors, the fewer ones, are what is copied to every chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, table

#: Rows of a chunk: with so many chunks or fewer the least, beyond them more and at the end the most. Results are the same.
LEAST_CHUNK, MOST_CHUNK, CHUNKS = 4096, 131_072, 1024
#: Scores that are worked on at once.
TILE_SCORES = 1 << 21

_KEY = 8 + 8 + 1 + 8
_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def usable(rows: DataFrame, label: Column, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and the integer ``vector``, floor(scale * x), of the rows that take part, each once."""
    x = F.col("v")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    made = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    picked = rows.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    known = picked.where(whole & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    least = known.groupBy("vec_id").agg(F.min(F.struct("label", made.alias("vector"))).alias("r"))
    return least.select("vec_id", "r.label", "r.vector")


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    sizes = np.asarray(pa.compute.list_value_length(lists), np.int64)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    values = np.asarray(lists.flatten(), np.int64)
    if len(values):
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(len(values)) - (np.cumsum(sizes) - sizes)[row]] = values
    return out


def _largest(rows: np.ndarray) -> int:
    return max(int(rows.max(initial=0)), -int(rows.min(initial=0)))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows as integers: by doubles where these are exact, else by 64 bits."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    bound = _largest(left) * _largest(right) * max(width, 1)
    if bound < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise ValueError("scores may be beyond 64 bits")
    return left @ right.T


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` highest allowed scores, ties to the smaller column."""
    held = np.where(allowed, scores, np.iinfo(np.int64).min)
    most = min(k, held.shape[1])
    least = np.partition(held, held.shape[1] - most, axis=1)[:, held.shape[1] - most]
    row, column = np.nonzero(allowed & (held >= least[:, None]))
    order = np.lexsort((column, -held[row, column], row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], column[kept]


def _pack(anchor: np.ndarray, score: np.ndarray, kind: int, vec_id: np.ndarray) -> pa.Array:
    """Keys that sort as bytes by anchor, score from high to low, kind and id."""
    def signed(values: np.ndarray) -> np.ndarray:
        return (values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)

    keys = np.empty((len(anchor), _KEY), np.uint8)
    keys[:, :8], keys[:, 8:16], keys[:, 16], keys[:, 17:] = signed(anchor), ~signed(score), kind, signed(vec_id)
    offsets = np.arange(len(anchor) + 1, dtype=np.int32) * _KEY
    return pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(keys.tobytes())])


def _unpack(keys: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, score, kind, id) of keys."""
    def signed(data: np.ndarray) -> list[int]:
        return (np.ascontiguousarray(data).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64).tolist()

    data = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, _KEY)
    return zip(signed(data[:, :8]), signed(~data[:, 8:16]), data[:, 16].tolist(), signed(data[:, 17:]))


class _Chunk:
    """The rows of a chunk, which come by id."""

    def __init__(self, parts: list[pa.RecordBatch]):
        whole = pa.Table.from_batches(parts).combine_chunks()
        self.ids = np.asarray(whole.column("vec_id"), np.int64)
        self.labels = np.asarray(whole.column("label"), np.int64)
        vectors = whole.column("vector")
        self.vectors = _matrix(vectors.chunk(0) if vectors.num_chunks else pa.array([], pa.list_(pa.int64())))


def _past_chunks(rows: DataFrame, anchors: DataFrame, chunks: int, solve, schema: str) -> DataFrame:
    """``solve(chunk, anchors)`` for every chunk of rows and every batch of anchors."""
    none = F.lit(None).cast("array<struct<score:bigint,vec_id:bigint>>").alias("positives")
    numbered = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("chunk")
    data = rows.select(numbered, F.lit(0).alias("kind"), "vec_id", "label", "vector", none)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk")
    asked = anchors.select(every, F.lit(1).alias("kind"), "vec_id", "label", "vector", "positives" if "positives" in anchors.columns else none)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, chunk = None, [], None
        for batch in batches:
            number, kind = np.asarray(batch.column("chunk")), np.asarray(batch.column("kind"))
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(kind) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if number[start] != at:
                    at, held, chunk = number[start], [], None
                if kind[start] == 0:
                    held.append(part)
                    continue
                if chunk is None:
                    chunk, held = _Chunk(held or [batch.slice(0, 0)]), []
                size = max(1, TILE_SCORES // max(1, len(chunk.ids)))
                for tile in range(0, part.num_rows, size):
                    yield from solve(int(at), chunk, part.slice(tile, size))

    dealt = data.unionByName(asked).repartition("chunk").sortWithinPartitions("chunk", "kind", "vec_id")
    return mapped(dealt, stream, schema)


def _scores(chunk: _Chunk, tile: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a tile's anchors, whether rows have the same label, and scores."""
    labels = np.asarray(tile.column("label"), np.int64)
    return np.asarray(tile.column("vec_id"), np.int64), labels[:, None] == chunk.labels, _products(_matrix(tile.column("vector")), chunk.vectors)


def _best_positives(k: int):
    def solve(number: int, chunk: _Chunk, tile: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(chunk.ids):
            own, same, scores = _scores(chunk, tile)
            row, column = _first(scores, same & (own[:, None] != chunk.ids), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[row]), pa.array(scores[row, column]), pa.array(chunk.ids[column])], names=["anchor_id", "score", "vec_id"]
            )

    return solve


def _keys_of_windows(k: int, percent: int):
    """Keys of the first ``k`` negatives of each window in a chunk, and, from the first chunk, of the positives."""

    def solve(number: int, chunk: _Chunk, tile: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = tile.column("positives").to_pylist()
        own = np.asarray(tile.column("vec_id"), np.int64)
        if number == 0:
            flat = [(a, p["score"], p["vec_id"]) for a, ps in zip(own.tolist(), known) for p in ps]
            yield pa.RecordBatch.from_arrays([_pack(*(np.array([f[i] for f in flat], np.int64) for i in (0, 1)), 0, np.array([f[2] for f in flat], np.int64))], names=["key"])
        if not len(chunk.ids):
            return
        own, same, scores = _scores(chunk, tile)
        found = []
        for nth in range(max(map(len, known), default=0)):
            # No score is within a window that ends before it starts.
            high = np.array([p[nth]["score"] if nth < len(p) else -1 for p in known], np.int64)
            low = np.array([-(-percent * p[nth]["score"] // 100) if nth < len(p) else 0 for p in known], np.int64)
            row, column = _first(scores, ~same & (scores <= high[:, None]) & (scores >= low[:, None]), k)
            found.append(row * len(chunk.ids) + column)
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        row, column = np.divmod(pairs, len(chunk.ids))
        yield pa.RecordBatch.from_arrays([_pack(own[row], scores[row, column], 1, chunk.ids[column])], names=["key"])

    return solve


def _fill_windows(k: int, percent: int):
    """The pass over sorted keys: a positive opens a window, negatives go to all windows that have room."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, windows = None, []
        for batch in batches:
            made = []
            for anchor, score, kind, vec_id in _unpack(batch.column(0)):
                if anchor != at:
                    at, windows = anchor, []
                if kind == 0:
                    windows.append([vec_id, score, 0])
                    continue
                for window in windows:
                    if window[2] < k and percent * window[1] <= 100 * score:
                        window[2] += 1
                        made.append((anchor, window[0], window[2], vec_id, window[1], score))
            columns = list(zip(*made)) if made else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in _OUT.split(", ")])

    return fill


def hard_negatives(
    rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
    percent: int = 80, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """The first ``negatives`` rows of other labels for each of an anchor's first ``positives`` rows of its label.

    A negative's score is at least ``percent`` of its positive's and at most that. Scores are inner products of
    integer vectors, floor(scale * x), as exact integers; the run ends with an error where one may be beyond 64
    bits. Higher scores come first, ties by smaller id. ``is_anchor`` is a condition on ``vec_id``, ``label`` an
    integer column, by default the one of that name.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. An id names one
    row; of several the one with the least label and vector counts. Of vectors of unlike length the shorter counts as
    if it ended in zeros. An anchor alone in its label, or with only negative scores, has no rows, and an
    empty table gives none.
    """
    known = usable(rows, F.col("label") if label is None else label, scale, key, vector)
    n = known.count()
    size = min(MOST_CHUNK, max(LEAST_CHUNK, -(-n // CHUNKS)))
    chunks = max(1, -(-n // size))
    anchors = known.where(is_anchor)
    near = _past_chunks(known, anchors, chunks, _best_positives(positives), "anchor_id bigint, score bigint, vec_id bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    opened = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("score", "vec_id")).alias("positives"))
    keys = _past_chunks(known, anchors.join(opened, "vec_id"), chunks, _keys_of_windows(negatives, percent), "key binary")
    dealt = keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")
    return mapped(dealt, _fill_windows(negatives, percent), _OUT)


_ORACLE = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(generate_series(1, least(len(a.v), len(c.v))), lambda i: a.v[i] * c.v[i]))::bigint AS score
  FROM kept a JOIN kept c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, n.vec_id))::int AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) <= 5"""


@QUERIES.add("op11_hard_negatives", _ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, moved)
