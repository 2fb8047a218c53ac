"""Exact k-means over integer vectors, with a shallot search for the nearest centroid.

Each vector keeps bounds from round to round: how far its own centroid is at most, how far any other one
is at least, and which centroid was second. Where the bounds leave no doubt, nothing is computed. Else the
search starts from the nearer of the two remembered centroids and goes through that one's neighbours by
distance, as far as a ball reaches that can hold the nearest or the second; each better one found makes
the ball smaller. Bounds are doubles with room for rounding and only rule out; whatever is left
is compared by squared distances in integers, ties by number.

Vectors travel as blocks, one row each. A round reads the blocks of the one before, writes them with new
bounds, and adds up the vectors by centroid in Spark; only centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, table
from graphloom.sources.scratch import discard, shared_folder, written_to

#: Vectors of a block.
BLOCK_ROWS = 8192
#: Components are not larger than this, so squared distances of up to 256 components fit 64 bits.
LARGEST = 1 << 26
#: Relative room for rounding in bounds.
_ROOM = 1e-9

_BLOCKS = (
    "ids array<bigint>, vectors binary, cluster binary, second binary, upper binary, lower binary, "
    "sums array<bigint>, distances array<bigint>"
)
_FOUND = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def takes_part(vector: Column, width: int) -> Column:
    """Whether a vector has ``width`` components, none of them null or not finite."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & (F.size(vector) == width) & sound


def _integers(lists: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors as rows of a matrix."""
    values = np.floor(np.asarray(lists.flatten(), np.float64).reshape(-1, width) * scale)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return values.astype(np.int64)


def _squares(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances in integers; ``centroid`` is one or one for each row."""
    apart = rows - centroid
    return np.einsum("ij,ij->i", apart, apart)


class Shallot:
    """The search of a round: its centroids, and how far each has moved since the bounds were made."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        gaps = np.sqrt(np.stack([_squares(centroids, c) for c in centroids]).astype(np.float64))
        self.gaps = gaps * (1 - _ROOM)
        self.neighbours = np.argsort(gaps, axis=1, kind="stable")
        others = gaps + np.where(np.eye(k, dtype=bool), np.inf, 0)
        self.half = others.min(axis=1) / 2 * (1 - _ROOM)
        self.moved = moved * (1 + _ROOM)
        # How far any centroid but the own one has moved.
        self.others = np.array([np.delete(self.moved, j).max(initial=0) for j in range(k)])

    def assign(
        self, rows: np.ndarray, own: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """New numbers of the nearest and the second centroid, new bounds, and how many vectors were searched for."""
        own, second = own.copy(), second.copy()
        upper, lower = upper + self.moved[own], lower - self.others[own]
        if len(self.centroids) == 1:
            return own, second, upper, lower, 0
        # Strictly less on both sides: a tie is no reason to stay.
        safe = np.maximum(lower, self.half[own])
        doubtful = np.flatnonzero(~(upper < safe))
        nearest = _squares(rows[doubtful], self.centroids[own[doubtful]])
        upper[doubtful] = np.sqrt(nearest.astype(np.float64)) * (1 + _ROOM)
        open_ = ~(upper[doubtful] < safe[doubtful])
        doubtful, nearest = doubtful[open_], nearest[open_]
        found = self._search(rows[doubtful], own[doubtful], second[doubtful], nearest)
        own[doubtful], second[doubtful] = found[0], found[1]
        upper[doubtful] = np.sqrt(found[2].astype(np.float64)) * (1 + _ROOM)
        lower[doubtful] = np.sqrt(found[3].astype(np.float64)) * (1 - _ROOM)
        return own, second, upper, lower, len(doubtful)

    def _search(self, rows: np.ndarray, a: np.ndarray, b: np.ndarray, a_square: np.ndarray):
        """The two nearest centroids of each row and their squared distances, from two remembered ones."""
        b_square = _squares(rows, self.centroids[b])
        swap = (b_square < a_square) | ((b_square == a_square) & (b < a))
        first, other = np.where(swap, b, a), np.where(swap, a, b)
        square, other_square = np.where(swap, b_square, a_square), np.where(swap, a_square, b_square)
        start = first.copy()
        reach = np.sqrt(square.astype(np.float64))
        for c in np.unique(start):
            inside = np.flatnonzero(start == c)
            for j in self.neighbours[c]:
                if j == c:
                    continue
                # What is nearer than the second so far is no farther from the start than both distances together.
                ball = (reach[inside] + np.sqrt(other_square[inside].astype(np.float64))) * (1 + _ROOM)
                inside = inside[self.gaps[c, j] <= ball]
                if not len(inside):
                    break
                at = inside[(first[inside] != j) & (other[inside] != j)]
                d = _squares(rows[at], self.centroids[j])
                nearer = (d < square[at]) | ((d == square[at]) & (j < first[at]))
                between = ~nearer & ((d < other_square[at]) | ((d == other_square[at]) & (j < other[at])))
                up, mid = at[nearer], at[between]
                other[up], other_square[up] = first[up], square[up]
                first[up], square[up] = j, d[nearer]
                other[mid], other_square[mid] = j, d[between]
        return first, other, square, other_square


def _blocks(rows: DataFrame, width: int, scale: int) -> DataFrame:
    """Vectors as blocks, not yet assigned."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                whole, n = _integers(part.column(1), width, scale), part.num_rows
                small = np.int16 if not n or np.abs(whole).max() < 1 << 15 else np.int32
                yield pa.RecordBatch.from_pylist([{
                    "ids": part.column(0).to_pylist(), "vectors": whole.astype(small).tobytes(),
                    "cluster": np.zeros(n, np.int32).tobytes(), "second": np.ones(n, np.int32).tobytes(),
                    "upper": np.full(n, np.inf).tobytes(), "lower": np.zeros(n).tobytes(), "sums": [], "distances": [],
                }], _SCHEMA)

    return mapped(rows, pack, _BLOCKS)


_LONGS = pa.list_(pa.int64())
_SCHEMA = pa.schema([
    ("ids", _LONGS), ("vectors", pa.binary()), ("cluster", pa.binary()), ("second", pa.binary()),
    ("upper", pa.binary()), ("lower", pa.binary()), ("sums", _LONGS), ("distances", _LONGS),
])


def _matrix(data: bytes, n: int, width: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * n * width else np.int32
    return np.frombuffer(data, kind).reshape(n, width).astype(np.int64)


def _assigned(blocks: DataFrame, centroids: np.ndarray, moved: np.ndarray, last: bool) -> DataFrame:
    """Blocks after a search. ``sums`` has, centroid by centroid, the sum of its vectors and their number, and in the
    ``last`` round the sum of squared distances alone, next to the ``distances``."""
    k, width = centroids.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Shallot(centroids, moved)
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                rows = _matrix(row["vectors"], n, width)
                own, second = (np.frombuffer(row[c], np.int32) for c in ("cluster", "second"))
                upper, lower = (np.frombuffer(row[c], np.float64) for c in ("upper", "lower"))
                own, second, upper, lower, _ = search.assign(rows, own, np.minimum(second, k - 1), upper, lower)
                distances = _squares(rows, centroids[own]) if last else np.empty(0, np.int64)
                sums = np.zeros((k, 1 if last else width + 1), np.int64)
                np.add.at(sums, own, distances[:, None] if last else np.pad(rows, ((0, 0), (0, 1)), constant_values=1))
                yield pa.RecordBatch.from_pylist([{
                    "ids": row["ids"], "vectors": b"" if last else row["vectors"], "cluster": own.astype(np.int32).tobytes(),
                    "second": second.astype(np.int32).tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes(),
                    "sums": sums.ravel().tolist(), "distances": distances.tolist(),
                }], _SCHEMA)

    return mapped(blocks, step, _BLOCKS)


def _totals(blocks: DataFrame, k: int) -> list[list[int]]:
    """``sums`` of all blocks by centroid: k rows, added up in Spark as decimals, which don't overflow."""
    each = blocks.select(F.posexplode("sums").alias("at", "value"))
    added = each.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r["at"]: int(r["total"]) for r in added}
    flat = [totals[i] for i in range(len(totals))]
    wide = len(flat) // k
    return [flat[i * wide : (i + 1) * wide] for i in range(k)]


def seeds(rows: DataFrame, k: int, prefix: str) -> DataFrame:
    """The ``k`` rows of (vec_id, v) with the smallest hash of prefix and id, in the order of their hashes."""
    hashed = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")).cast("binary"), 256)
    return rows.withColumn("hash", hashed).orderBy(F.col("hash").asc_nulls_last(), "v").limit(k)


def cluster(
    rows: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, prefix: str = "2:",
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each vector.

    Rows whose vector is null, is not of ``width`` components or holds a null or non-finite one are left
    out. Components become floor(scale * x); the run ends with an error where one is then beyond
    ``LARGEST``. The first centroids are the ``k`` vectors with the smallest hash of prefix and id. In each round every
    vector goes to its nearest centroid, ties to the smaller number, and a centroid that has vectors moves to
    the floor of their mean; then vectors are assigned once more.

    Every row is a vector of its own: those that repeat an id or a vector all count and all come out, and those with a
    null id count as well but are first centroids only when all others are. With fewer than ``k`` vectors all
    are centroids; an empty table gives no rows.
    """
    spark = rows.sparkSession
    picked = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    picked = picked.where(takes_part(F.col("v"), width))
    first = seeds(picked, k, prefix).collect()  # k rows
    if not first:
        return spark.createDataFrame([], _FOUND)
    centroids = _integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width, scale)
    moved = np.zeros(len(centroids))
    path = shared_folder(spark, "cluster-blocks")
    blocks = written_to(_blocks(picked, width, scale), path)
    for number in range(rounds + 1):
        last = number == rounds
        before, path = path, shared_folder(spark, "cluster-blocks")
        blocks = written_to(_assigned(blocks, centroids, moved, last), path)
        discard(spark, before)
        totals = _totals(blocks, len(centroids))
        if not last:
            new = np.array([
                [s // t[-1] for s in t[:-1]] if t[-1] else c.tolist() for t, c in zip(totals, centroids)
            ], np.int64)
            moved, centroids = np.sqrt(_squares(new, centroids).astype(np.float64)), new
    return _unpacked(blocks, centroids, [t[0] for t in totals])


def _unpacked(blocks: DataFrame, centroids: np.ndarray, inertia: list[int]) -> DataFrame:
    """A row for each vector of the last blocks."""
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(inertia)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_cluster, hashes = pa.array(inertia, pa.int64()), pa.array(names)
        for batch in batches:
            for row in range(batch.num_rows):
                own = np.frombuffer(batch.column("cluster")[row].as_py(), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, pa.array(own), batch.column("distances")[row].values,
                     pc.take(of_cluster, pa.array(own)), pa.array(np.full(len(own), whole, np.int64)), pc.take(hashes, pa.array(own))],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return mapped(blocks.select("ids", "cluster", "distances"), unpack, _FOUND)


def _oracle(k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256) -> str:
    """The rounds as one SQL text."""
    near = """SELECT vec_id, v, j, d FROM (
      SELECT x.vec_id, x.v, c.j, list_sum(list_transform(list_zip(x.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint AS d
      FROM kept x CROSS JOIN c{n} c) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1"""
    parts = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) AS v FROM embeddings
      WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::varchar)) - 1 AS j, v AS c FROM kept
      ORDER BY sha256('2:' || vec_id::varchar) LIMIT {k})""",
    ]
    for n in range(rounds):
        parts += [
            f"a{n} AS MATERIALIZED ({near.format(n=n)})",
            f"""m{n} AS MATERIALIZED (SELECT j, list(m ORDER BY i) AS c FROM (
      SELECT j, i, ((sum(v[i]) - (((sum(v[i]) % count(*)) + count(*)) % count(*))) // count(*))::bigint AS m
      FROM a{n} CROSS JOIN (SELECT unnest(generate_series(1, {width})) AS i) GROUP BY j, i) GROUP BY j)""",
            f"c{n + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.c, c.c) AS c FROM c{n} c LEFT JOIN m{n} m ON c.j = m.j)",
        ]
    return f"""WITH {", ".join(parts)}, last AS MATERIALIZED ({near.format(n=rounds)})
    SELECT vec_id, last.j::int AS cluster, d AS distance, (sum(d) OVER (PARTITION BY last.j))::bigint AS cluster_inertia,
           (sum(d) OVER ())::bigint AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
    FROM last JOIN c{rounds} c ON c.j = last.j"""


@QUERIES.add("op13_centroid_clustering", _oracle())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(table(spark, folder, "embeddings"))
