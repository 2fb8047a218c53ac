"""Exact top-k search by inner product as a Voronoi join.

Pivots cut the space into cells; each cell has a summary of its vectors: how many there are, how far the
farthest is from the pivot and how long the longest. A query is first solved in the cell of its own pivot,
which gives a score that k others reach already. From the summaries follows the best score that a
cell can hold for a query, and only to cells that can beat the score so far is the query sent.
Cells are cut into blocks of bounded size, so a cell with many vectors is solved by many
tasks, and each task is one product of two bounded matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, on_workers, table
from graphloom.sources.scratch import written

#: Rows that the pivots are fitted on, at most, and vectors for each pivot; at most so many pivots.
FIT_ROWS, CELL_ROWS, MOST_PIVOTS = 20_000, 4096, 1024
#: Vectors of a block and queries that are solved against it at once.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048

_MATRIX = "vec_id bigint, vector array<bigint>"


def usable(rows: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and the integer ``vector``, floor(scale * x), of the rows that take part, each once.

    Rows with a null id, a null vector, or null or non-finite components are left out. An id
    names one vector: rows that repeat one are one candidate, and of several vectors under an id
    the least one counts.
    """
    x = F.col("v")
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    made = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    picked = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return picked.where(whole & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min(made).alias("vector"))


def _stack(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix of doubles, which hold the integers exactly; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pa.compute.list_value_length(lists))
    out = np.zeros((len(lists), width))
    values = np.asarray(lists.flatten())
    if len(values):
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(len(values)) - (np.cumsum(sizes) - sizes)[row]] = values
    return out


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centres of ``n`` cells, by a few rounds of k-means over a sample."""
    rng = np.random.default_rng(seed)
    pivots = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        cell, _ = _nearest(sample, pivots)
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, sample)
        held = np.bincount(cell, minlength=len(pivots))
        pivots[held > 0] = sums[held > 0] / held[held > 0, None]
    return pivots


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the distance to it."""
    squares = (pivots**2).sum(axis=1)
    cell = np.concatenate([np.argmin(squares - 2 * r @ pivots.T, axis=1) for r in np.array_split(rows, len(rows) // 4096 + 1)])
    return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1))


def assign_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its ``cell``, its ``distance`` to the pivot and its ``norm``."""
    width = pivots.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _stack(batch.column(1), width)
            cell, distance = _nearest(rows, pivots) if len(rows) else (np.empty(0, np.int64), np.empty(0))
            norm = np.sqrt((rows**2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(norm)],
                names=["vec_id", "vector", "cell", "distance", "norm"],
            )

    return mapped(vectors, assign, f"{_MATRIX}, cell int, distance double, norm double")


def solve(queries: DataFrame, blocks: DataFrame, width: int, k: int) -> DataFrame:
    """The ``k`` best of a block for each of the queries sent to it: ``query_id``, ``vec_id``, ``score``.

    ``queries`` has ``cell``, ``part``, ``batch``, ``vec_id`` and ``vector``, ``blocks`` the same; both sides of a
    group are bounded. A query is no candidate of its own.
    """
    on_workers(queries.sparkSession)

    def best(asked: pa.Table, block: pa.Table) -> pa.Table:
        ids = np.asarray(block.column("vec_id"), np.int64)
        own = np.asarray(asked.column("vec_id"), np.int64)
        if not len(ids) or not len(own):
            empty = pa.array([], pa.int64())
            return pa.table({"query_id": empty, "vec_id": empty, "score": empty})
        order = np.argsort(ids)
        ids = ids[order]
        scores = _stack(asked.column("vector"), width) @ _stack(block.column("vector"), width)[order].T
        scores[own[:, None] == ids] = -np.inf
        # Every candidate as good as the k-th is kept, and a stable sort gives ties to smaller ids.
        most = min(k, len(ids))
        least = np.partition(scores, len(ids) - most, axis=1)[:, len(ids) - most]
        row, column = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
        value = scores[row, column]
        rank = np.lexsort((ids[column], -value, row))
        row, column, value = row[rank], column[rank], value[rank]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, column, value = (x[nth < k] for x in (row, column, value))
        return pa.table({"query_id": own[row], "vec_id": ids[column], "score": value.astype(np.int64)})

    key = ["cell", "part", "batch"]
    joined = queries.groupBy(*key).cogroup(blocks.groupBy(*key))
    return joined.applyInArrow(best, "query_id bigint, vec_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's ``k`` best other rows.

    ``is_query`` is a condition on ``vec_id``. Scores are inner products of the integer vectors, and ties
    go to the smaller id; a query with fewer than ``k`` others gets all of them. Which rows take
    part, and what repeated ones mean, says :func:`usable`. Of vectors of unlike length the shorter
    counts as if it ended in zeros. The result is exact: pivots only decide which cells are looked at.
    """
    spark = rows.sparkSession
    vectors = written(usable(rows, scale, key, vector), "integer-vectors")
    n, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # A bounded sample by hash fits the pivots.
    share = min(1.0, FIT_ROWS / n)
    chosen = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    picked = chosen.orderBy(F.xxhash64("vec_id")).limit(FIT_ROWS).select("vector").toArrow()
    sample = _stack(picked.column(0), width)
    if not len(sample):
        sample = np.zeros((1, width))
    pivots = fit_pivots(sample, min(MOST_PIVOTS, max(1, n // CELL_ROWS)))
    placed = written(assign_cells(vectors, pivots), "voronoi-cells")
    # The summaries are one row a pivot.
    summary = placed.groupBy("cell").agg(
        F.count("*").alias("held"), F.max("distance").alias("radius"), F.max("norm").alias("longest")
    ).collect()
    cells = np.array([r["cell"] for r in summary])
    held = np.array([r["held"] for r in summary])
    radius, longest = (np.array([r[c] for r in summary]) for c in ("radius", "longest"))
    centres = pivots[cells]
    parts = {int(c): -(-int(h) // BLOCK_ROWS) for c, h in zip(cells, held)}
    queries = placed.where(is_query)
    batches = max(1, -(-queries.count() // BLOCK_QUERIES))

    n_parts = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("cell"))
    part = F.pmod(F.xxhash64("vec_id"), n_parts).cast("int")
    every_batch = F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
    blocks = placed.select("vec_id", "vector", "cell", part.alias("part"), every_batch.alias("batch"))
    batch = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(batches)).cast("int")
    at_home = queries.select("vec_id", "vector", "cell", part.alias("part"), batch.alias("batch"))
    first = written(solve(at_home, blocks, width, k), "home-cells")
    so_far = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = F.when(F.col("n") >= k, F.col("least"))  # null: any score is worth a look
    known = queries.select("vec_id", "vector", "cell", part.alias("part"), batch.alias("batch"), "norm").join(
        so_far.select(F.col("query_id").alias("vec_id"), reached.alias("least")), "vec_id", "left"
    )

    def send(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            if not b.num_rows:
                continue
            asked = _stack(b.column(1), width)
            norm = np.sqrt((asked**2).sum(axis=1))[:, None]
            # By the pivot and the radius, or by the longest vector, with room for rounding.
            bound = np.minimum(asked @ centres.T + norm * radius, norm * longest) + 1e-3 + 1e-9 * norm * longest
            least = np.asarray(b.column("least").cast(pa.float64()).fill_null(-np.inf))
            row, cell = np.nonzero(bound >= least[:, None])
            count = np.array([parts[int(c)] for c in cells])[cell]
            row, cell = np.repeat(row, count), np.repeat(cell, count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            home = (cells[cell] == np.asarray(b.column("cell"))[row]) & (number == np.asarray(b.column("part"))[row])
            row, cell, number = row[~home], cell[~home], number[~home]
            taken = pa.array(row)
            for start in range(0, len(row), 4096):
                cut = slice(start, start + 4096)
                at = taken[cut]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(cells[cell[cut]].astype(np.int32)),
                     pa.array(number[cut].astype(np.int32)), b.column("batch").take(at)],
                    names=["vec_id", "vector", "cell", "part", "batch"],
                )

    sent = mapped(known, send, f"{_MATRIX}, cell int, part int, batch int")
    found = first.unionByName(solve(sent, blocks, width, k))
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


_ORACLE = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(generate_series(1, least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i]))::bigint AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@QUERIES.add("op2_vector_search", _ORACLE)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
