"""Lexical retrieval packing: windows are filled with the documents that are most like each other.

Documents are dealt by likeness into shards of bounded size, and each shard gets a BM25 inverted index
over its token ids, with the document frequencies and the mean length of all documents. For dealing, the
weights of a document's terms are projected to a short vector, and a tree of cuts, each along the main
direction of a drawn sample, leads the vector to its leaf. Leaves that hold many documents are parted by
a hash of the terms that near copies share, and groups of copies that are still large by row; a part is sorted by
that hash and cut into shards. A window starts with a seed document; the index ranks the documents that are still
unused by their score for the seed, and the best fill the window one after the other. What
does not fit of the last one starts the next window and is its seed, so every token
lies in exactly one window and only a shard's last window has room left.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, table
from graphloom.llm.pieces import vocabulary, vocabulary_path
from graphloom.sources.scratch import written

#: Tokens of a window and the id that ends a document.
WINDOW, END_ID = 2048, 1
#: Documents of a shard, on average, and about how many shards' documents are sorted by one key.
SHARD_DOCS, PART_SHARDS = 512, 16
#: BM25's usual constants.
_K1, _B = 1.2, 0.75
#: A term that one in so many of a shard's documents has is common there. It bounds the memory of the rows of weights
#: to so many numbers for each posting.
COMMON_SHARE = 4
#: Length of the vectors that documents are dealt by, about how many documents the tree is fitted on, and
#: the least of them in a leaf.
DIRECTIONS, FIT_DOCS, LEAF_DOCS = 64, 1 << 16, 8


def _idf(n: int, held: np.ndarray) -> np.ndarray:
    # A term that most documents have tells nothing: its weight is 0, and it is left out.
    return np.maximum(0, np.log((n - held + 0.5) / (held + 0.5)))


def _terms(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a document in order, and how often it has each."""
    ordered = np.sort(doc, kind="stable" if doc.itemsize <= 2 else None)  # short ids are sorted by radix
    last = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=last[:-1])
    at = np.flatnonzero(last)
    counts = at + 1
    counts[1:] -= at[:-1] + 1
    return ordered[at], counts


class Corpus(NamedTuple):
    """What BM25 has to know of all documents: their number, their mean length, and the idf of each id."""

    n: int
    mean: float
    idf: np.ndarray


class InvertedIndex:
    """BM25 over the token ids of a shard's documents, which are all there are unless ``corpus`` tells of more.

    Terms that many of the documents hold have a row of weights for all of them, the others a list of postings.
    """

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        terms, counts = zip(*map(_terms, docs)) if docs else ((), ())
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        term = np.concatenate([*terms, np.empty(0, np.int64)]).astype(np.int64)
        count = np.concatenate([*counts, np.empty(0, np.int64)]).astype(np.float64)
        doc = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
        length = np.fromiter(map(len, docs), np.float64, len(docs))
        held = np.bincount(term)
        if corpus is None:
            idf = _idf(len(docs), held)
            mean = length.mean() if len(docs) else 1
        else:
            idf, mean = corpus.idf, corpus.mean
        norm = _K1 * (1 - _B + _B * length / max(mean, 1))
        weight = idf[term] * count * (_K1 + 1) / (count + norm[doc])
        useful = weight > 0
        term, doc, weight = term[useful], doc[useful], weight[useful]
        self.n = len(docs)

        common = np.bincount(term, minlength=len(held)) * COMMON_SHARE >= max(self.n, 1)
        number = np.empty(len(held), np.int64)
        number[common], number[~common] = np.arange(common.sum()), np.arange((~common).sum())
        number, common = number[term], common[term]
        self.rows = np.zeros((int(number[common].max(initial=-1)) + 1, self.n))
        self.rows[number[common], doc[common]] = weight[common]
        self.common = self._by_doc(number[common], doc[common])

        number, doc, weight = number[~common], doc[~common], weight[~common]
        order = np.argsort(number.astype(np.uint16) if len(held) <= 1 << 16 else number, kind="stable")
        self.postings, self.weights = doc[order], weight[order]
        sizes = np.bincount(number)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.rare = self._by_doc(number, doc)

    def _by_doc(self, number: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
        """The terms of each document, by number, for its use as a query."""
        ends = np.bincount(doc, minlength=self.n).cumsum().tolist()
        return [number[start:end] for start, end in zip([0, *ends], ends)]

    def scores(self, doc: int) -> np.ndarray:
        """The score of every document for the terms of one."""
        found = self.rows.take(self.common[doc], axis=0).sum(axis=0)
        query = self.rare[doc]
        if not len(query):
            return found
        starts, ends = self.starts[query], self.ends[query]
        sizes = ends - starts
        # All posting lists of the query as one list of places.
        step = np.ones(int(sizes.sum()), np.int64)
        first = np.cumsum(sizes) - sizes
        step[first] = starts
        step[first[1:]] -= ends[:-1] - 1
        places = np.cumsum(step)
        return found + np.bincount(self.postings[places], weights=self.weights[places], minlength=self.n)


def fill(docs: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces as (document, start, length, sequence, offset) for the documents of a shard."""
    index = InvertedIndex(docs, corpus)
    free = np.ones(len(docs), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = offset = 0
    next_free = 0
    scores = np.empty(0)
    while True:
        while next_free < len(docs) and not free[next_free]:
            next_free += 1
        if next_free == len(docs):
            return pieces
        current, start = next_free, 0
        free[current] = False
        asked = False
        while True:
            size = min(len(docs[current]) - start, window - offset)
            if size:
                pieces.append((current, start, size, sequence, offset))
                start, offset = start + size, offset + size
            if offset == window:
                sequence, offset = sequence + 1, 0
                if start == len(docs[current]):
                    break
                asked = False  # the rest is the next window's seed
                continue
            if not asked:
                asked, scores = True, index.scores(current)
                scores[~free] = -1
            current, start = int(scores.argmax()), 0
            if not free[current]:
                return pieces
            free[current], scores[current] = False, -1


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``tokens`` of each row as bytes of unsigned numbers, the end id included, beside its other columns."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        end = np.array([end_id], vocab.dtype).tobytes()
        for batch in batches:
            ids = [vocab.ids(t.as_py() or "").tobytes() + end for t in batch.column("text")]
            arrays = [batch.column(c) for c in range(batch.num_columns - 1)] + [pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "tokens"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return mapped(docs, encode, f"{kinds}, tokens binary")


def corpus_of(tokens: DataFrame, dtype: np.dtype) -> Corpus:
    """Number, mean length and idf over all rows of ``tokens``."""
    ids = 1 << (8 * dtype.itemsize if dtype.itemsize < 4 else 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, length = np.zeros(ids, np.int64), 0, 0
        for batch in batches:
            for cell in batch.column(0):
                doc = np.frombuffer(cell.as_py(), dtype)
                known, _ = _terms(doc)
                if len(known) and known[-1] >= len(held):
                    held = np.concatenate([held, np.zeros(int(known[-1]) + 1 - len(held), np.int64)])
                held[known] += 1
                docs, length = docs + 1, length + len(doc)
        term = np.flatnonzero(held)
        # The number and the length of documents travel under ids that no token has.
        arrays = [np.concatenate([term, [-1, -2]]), np.concatenate([held[term], [docs, length]])]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["term", "n"])

    counts = mapped(tokens.select("tokens"), count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = {r["term"]: r["n"] for r in counts.collect()}
    docs, length = by_term.pop(-1, 0), by_term.pop(-2, 0)
    held = np.zeros(max([ids - 1, *by_term]) + 1, np.int64)
    held[list(by_term)] = list(by_term.values())
    return Corpus(docs, length / max(docs, 1), _idf(docs, held))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A fixed hash of numbers, as 64 bits."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Sketches:
    """Projected weights of documents, and the least hash of the terms of each."""

    def __init__(self, corpus: Corpus):
        self.corpus = corpus
        signs = np.random.default_rng(5).integers(0, 2, (len(corpus.idf), DIRECTIONS), np.int8)
        self.weights = (2 * signs - 1) * corpus.idf[:, None].astype(np.float32)
        self.hashes = _mixed(np.arange(len(corpus.idf)), 11)
        # Terms without weight are in nearly all documents and would make all of these alike.
        self.hashes[corpus.idf == 0] = np.iinfo(np.uint64).max

    def of(self, doc: np.ndarray) -> tuple[np.ndarray, int]:
        terms, counts = _terms(doc)
        norm = _K1 * (1 - _B + _B * len(doc) / max(self.corpus.mean, 1))
        vector = (counts / (counts + norm)).astype(np.float32) @ self.weights.take(terms, axis=0)
        least = int(self.hashes[terms].min()) >> 1 if len(terms) else 0
        return vector / max(math.sqrt(vector @ vector), 1e-9), least


class Cuts:
    """A tree of cuts: each node parts its sample along its main direction where the halves differ most, among
    the places that give the leaves below about equal shares."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.direction: list[np.ndarray] = []
        self.threshold: list[float] = []
        self.follow: list[tuple[int, int]] = []
        self.leaves = 0
        self._root = self._grow(sample, max(1, min(leaves, len(sample) // LEAF_DOCS)))
        self.arrays = (
            np.array(self.direction, np.float32).reshape(-1, DIRECTIONS), np.array(self.threshold),
            np.array(self.follow, np.int64).reshape(-1, 2),
        )

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        """The number of a node, or of a leaf as -1 - leaf."""
        if leaves > 1 and len(x) > 1:
            centred = x - x.mean(axis=0)
            along = np.linalg.eigh(centred.T @ centred)[1][:, -1].astype(np.float32)
            at = x @ along
            order = np.sort(at).astype(float)
            size = np.arange(1, len(x))
            below = np.clip(np.rint(leaves * size / len(x)), 1, leaves - 1)
            total = np.cumsum(order)[:-1]
            apart = (total / size - (order.sum() - total) / (len(x) - size)) ** 2 * size * (len(x) - size)
            apart[order[1:] <= order[:-1]] = -1
            # Where copies leave no place that gives equal shares, any place between them does.
            equal = np.where(np.abs(leaves * size / len(x) - below) > 0.25, -1, apart)
            best = int((equal if equal.max() >= 0 else apart).argmax())
            below, threshold = int(below[best]), float(order[best] + order[best + 1]) / 2
            left = at <= threshold
            if 0 < left.sum() < len(x):
                node = len(self.threshold)
                self.direction.append(along)
                self.threshold.append(threshold)
                self.follow.append((0, 0))
                self.follow[node] = self._grow(x[left], below), self._grow(x[~left], leaves - below)
                return node
        self.leaves += 1
        return -self.leaves

    def leaf(self, x: np.ndarray) -> np.ndarray:
        direction, threshold, follow = self.arrays
        at = np.full(len(x), self._root)
        while len(inner := np.flatnonzero(at >= 0)):
            node = at[inner]
            right = np.einsum("ij,ij->i", x[inner], direction[node]) > threshold[node]
            at[inner] = follow[node, right.astype(int)]
        return -1 - at


class Deal(NamedTuple):
    """How documents are dealt: the leaf of each by cuts, leaves in so many parts, and large groups of copies, by leaf and
    hash, in further parts, from the first on."""

    cuts: Cuts
    parts: np.ndarray
    copies: dict[tuple[int, int], tuple[int, int]]


def _sketches(tokens: DataFrame, corpus, dtype: np.dtype) -> DataFrame:
    """``vector`` and ``least`` of each row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = Sketches(corpus.value)
        for batch in batches:
            found = [sketches.of(np.frombuffer(t.as_py(), dtype)) for t in batch.column(0)]
            arrays = [pa.array([v.tobytes() for v, _ in found], pa.binary()), pa.array([h for _, h in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vector", "least"])

    return mapped(tokens.select("tokens"), sketch, "vector binary, least bigint")


def _deal(tokens: DataFrame, corpus: Corpus, shared, dtype: np.dtype, shard_docs: int) -> Deal:
    """Cuts and parts by a bounded sample. It only decides which documents meet, and how evenly tasks are filled."""
    share = min(1.0, FIT_DOCS / max(corpus.n, 1))
    drawn = tokens.where(F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # In an order of their own, so that the tree doesn't depend on that of the tasks.
    rows = sorted((r["vector"], r["least"]) for r in _sketches(drawn, shared, dtype).limit(2 * FIT_DOCS).collect())
    sample = np.frombuffer(b"".join(v for v, _ in rows), np.float32).reshape(-1, DIRECTIONS)
    cuts = Cuts(sample, -(-corpus.n // shard_docs))
    leaf, stands_for, most = cuts.leaf(sample), corpus.n / max(len(rows), 1), PART_SHARDS * shard_docs
    parts = np.maximum(1, np.rint(np.bincount(leaf, minlength=cuts.leaves) * stands_for / most)).astype(np.int64)
    copies, after = {}, parts.tolist()
    for (of, least), n in Counter(zip(leaf.tolist(), (h for _, h in rows))).items():
        own = int(n * stands_for / most)
        if own > 1:
            copies[of, least] = after[of], own
            after[of] += own
    return Deal(cuts, parts, copies)


def _placed(tokens: DataFrame, shared, deal, dtype: np.dtype) -> DataFrame:
    """The rows with their ``leaf``, ``part`` and ``least``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches, (cuts, parts, copies), row = Sketches(shared.value), deal.value, 0
        for batch in batches:
            found = [sketches.of(np.frombuffer(t.as_py(), dtype)) for t in batch.column("tokens")]
            leaf = cuts.leaf(np.array([v for v, _ in found], np.float32).reshape(len(found), DIRECTIONS))
            least = np.array([h for _, h in found], np.int64)
            part = least % parts[leaf] if len(found) else least
            if copies:
                for i, place in enumerate(zip(leaf.tolist(), least.tolist())):
                    if place in copies:
                        first, n = copies[place]
                        part[i] = first + (row + i) % n
            row += len(found)
            arrays = [pa.array(x, pa.int64()) for x in (leaf, part, least)]
            yield pa.RecordBatch.from_arrays([*arrays, *batch.columns], names=["leaf", "part", "least", *batch.schema.names])

    return mapped(tokens, place, "leaf bigint, part bigint, least bigint, doc_id bigint, tokens binary")


def _shards(batches: Iterator[pa.RecordBatch], shard_docs: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Shards of sorted rows: the rows of a part are cut where they are many, and the last two cuts are of like size."""
    at, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("leaf", "part", "doc_id", "tokens")]
        for leaf, part, doc_id, tokens in zip(*columns):
            if (leaf, part) != at:
                yield from _last(held, shard_docs)
                at, held = (leaf, part), []
            elif len(held) >= 2 * shard_docs:
                yield held[:shard_docs]
                del held[:shard_docs]
            held.append((doc_id, tokens))
    yield from _last(held, shard_docs)


def _last(held: list, shard_docs: int) -> Iterator[list]:
    half = len(held) if 2 * len(held) <= 3 * shard_docs else -(-len(held) // 2)
    for start in range(0, len(held), half or 1):
        yield held[start : start + half]


def _sorted_parts(tokens: DataFrame, corpus: Corpus, shared, dtype: np.dtype, shard_docs: int) -> DataFrame:
    """All rows dealt to tasks by part, like ones next to each other. The tokens are shuffled this once."""
    deal = tokens.sparkSession.sparkContext.broadcast(_deal(tokens, corpus, shared, dtype, shard_docs))
    placed = _placed(tokens, shared, deal, dtype)
    return placed.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "least", "doc_id", "tokens")


def dealt(tokens: DataFrame, corpus: Corpus, dtype: np.dtype, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``doc_id`` and ``tokens`` with the number of their ``shard``, whose documents are alike."""
    shared = tokens.sparkSession.sparkContext.broadcast(corpus)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for n, rows in enumerate(_shards(batches, shard_docs)):
            arrays = [pa.array([base + n] * len(rows)), pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["shard", "doc_id", "tokens"])

    return mapped(_sorted_parts(tokens, corpus, shared, dtype, shard_docs), number, "shard bigint, doc_id bigint, tokens binary")


def pack(docs: DataFrame, path: str, window: int = WINDOW, shard_docs: int = SHARD_DOCS, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents (``doc_id``, ``text``): ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and the piece's ``ids`` as little-endian 32-bit numbers.

    A null or empty text is its end id alone, and an empty table has no pieces. Repeated rows are packed as often as they are
    there, and equal scores go to the document with the smaller id. Documents are dealt to shards by
    likeness, and large groups of copies by row, so none makes a shard large. A text longer than the window
    fills several.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dtype = vocabulary(path).dtype
    tokens = written(token_ids(rows, path, end_id), "packing-tokens")
    corpus = corpus_of(tokens, dtype)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sequences are numbered within a task, whose rows are the same when it runs again.
        base = TaskContext.get().partitionId() << 40
        for rows in _shards(batches, shard_docs):
            rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            ids, made, last = [np.frombuffer(t, dtype) for _, t in rows], [], -1
            for doc, start, size, sequence, offset in fill(ids, window, shared.value):
                piece = ids[doc][start : start + size].astype("<u4").tobytes()
                made.append((rows[doc][0], start, size, zlib.crc32(piece), len(ids[doc]), base + sequence, offset, piece))
                last = sequence
            base += last + 1
            arrays = [pa.array(c, k) for c, k in zip(zip(*made), [pa.int64()] * 7 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays(arrays, names=_PIECES)

    return mapped(_sorted_parts(tokens, corpus, shared, dtype, shard_docs), pack_shards, _PIECE_SCHEMA)


_PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
_PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


@QUERIES.add("op8_packing")
def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary_path("byte_bpe_50k.json")).drop("ids")
