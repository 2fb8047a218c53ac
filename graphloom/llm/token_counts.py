"""Token counts without token ids.

A text's tokens are those of its pre-tokens, so a pre-token is counted once for the whole corpus.
A task turns its documents, block by block, into frequencies: the block's distinct pre-tokens, dealt
into shards by hash, and for each of them the documents that hold it and how often. A shard
brings together the pre-tokens of all blocks and counts each distinct one once; the counts go back to
the blocks, are joined with the frequencies there and summed by document. Neither texts nor ids are
shuffled, and a block's pre-tokens travel as one compressed list for each shard.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, on_workers, table
from graphloom.llm.pieces import Vocabulary, vocabulary, vocabulary_path
from graphloom.sources.scratch import written

#: A block ends after so many bytes of text or documents, whichever comes first.
BLOCK_BYTES, BLOCK_DOCS = 32 << 20, 32768
#: Documents for each shard of pre-tokens, and the most shards.
SHARD_DOCS, MOST_SHARDS = 1024, 16384
#: Pre-tokens that the library counts in one call.
_AT_ONCE = 20_000


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _pack_texts(texts: list[str]) -> bytes:
    """Texts as their lengths in bytes and the bytes themselves."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.uint32, len(raw))
    return _packed(len(raw).to_bytes(4, "little") + sizes.tobytes() + b"".join(raw))


def _unpack_texts(data: bytes) -> list[str]:
    data = _unpacked(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.frombuffer(data, np.uint32, n, 4).cumsum() + 4 + 4 * n
    starts = [4 + 4 * n, *ends[:-1].tolist()]
    return [data[a:b].decode() for a, b in zip(starts, ends.tolist())]


class _Block:
    """Documents of a block and the frequencies of their pre-tokens."""

    def __init__(self):
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.pieces: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.doc_ids: list = []
        self.n_bytes: list[int] = []
        self.whole: list[int] = []
        self.bytes = 0

    def add(self, doc_id, text: str, vocab: Vocabulary) -> None:
        counted: Counter[str] = Counter()
        whole = 0
        if vocab.irregular(text):
            whole = len(vocab.library_ids(text))
        else:
            counted.update(vocab.split(text))
        self.pieces.append(np.fromiter(map(self.index.__getitem__, counted), np.int32, len(counted)))
        self.times.append(np.fromiter(counted.values(), np.uint32, len(counted)))
        self.doc_ids.append(doc_id)
        self.n_bytes.append(len(text.encode()))
        self.whole.append(whole)
        self.bytes += self.n_bytes[-1]

    def rows(self, number: int, shards: int, schema: pa.Schema) -> pa.RecordBatch:
        """A row for each shard with its pre-tokens, and one with the documents and frequencies."""
        pieces = list(self.index)
        shard = np.fromiter((zlib.crc32(p.encode()) % shards for p in pieces), np.int64, len(pieces))
        # Pre-tokens lie by shard and then by text, which also makes the lists small.
        by_text = sorted(range(len(pieces)), key=pieces.__getitem__)
        order = np.array(by_text, np.int64)[np.argsort(shard[by_text], kind="stable")]
        place = np.empty(len(pieces), np.int32)
        place[order] = np.arange(len(pieces), dtype=np.int32)
        piece, times = place[np.concatenate(self.pieces)], np.concatenate(self.times)
        doc = np.repeat(np.arange(len(self.doc_ids), dtype=np.uint16), [len(p) for p in self.pieces])
        by_piece = np.argsort(piece, kind="stable")
        sizes = np.bincount(piece, minlength=len(pieces)).astype(np.uint32)
        numbers, starts = np.unique(shard[order], return_index=True)
        rows = [
            {"block": number, "shard": int(n), "pieces": _pack_texts([pieces[i] for i in own])}
            for n, own in zip(numbers, np.split(order, starts[1:]))
        ]
        rows.append({
            "block": number, "doc_ids": self.doc_ids, "n_bytes": self.n_bytes, "whole": self.whole,
            "sizes": _packed(sizes.tobytes()), "docs": _packed(doc[by_piece].tobytes()),
            "times": _packed(times[by_piece].tobytes()),
        })
        return pa.RecordBatch.from_pylist(rows, schema)


def piece_frequencies(docs: DataFrame, path: str, shards: int) -> DataFrame:
    """Blocks of documents with their frequencies, and for each shard a block's pre-tokens."""
    kind = docs.schema[0].dataType.simpleString()
    columns = (
        f"block bigint, shard bigint, pieces binary, doc_ids array<{kind}>, n_bytes array<bigint>, "
        "whole array<bigint>, sizes binary, docs binary, times binary"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, block, schema = vocabulary(path), _Block(), None
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if schema is None:
                long, data = pa.int64(), pa.binary()
                schema = pa.schema([
                    ("block", long), ("shard", long), ("pieces", data), ("doc_ids", pa.list_(batch.schema.field(0).type)),
                    ("n_bytes", pa.list_(long)), ("whole", pa.list_(long)), ("sizes", data), ("docs", data), ("times", data),
                ])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py() or "", vocab)
                if block.bytes >= BLOCK_BYTES or len(block.doc_ids) >= BLOCK_DOCS:
                    yield block.rows(number, shards, schema)
                    block, number = _Block(), number + 1
        if block.doc_ids:
            yield block.rows(number, shards, schema)

    return mapped(docs, count, columns)


def piece_counts(lists: DataFrame, path: str) -> DataFrame:
    """For each block and shard the token counts of its pre-tokens, each distinct one counted once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, at, known = vocabulary(path), None, {}
        for batch in batches:
            counts = []
            for shard, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if shard != at:  # rows come by shard
                    at, known = shard, {}
                pieces = _unpack_texts(data)
                new = [p for p in pieces if p not in known]
                for start in range(0, len(new), _AT_ONCE):
                    part = new[start : start + _AT_ONCE]
                    known.update(zip(part, vocab.count(part)))
                found = np.fromiter(map(known.__getitem__, pieces), np.uint32, len(pieces))
                counts.append(_packed(found.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.binary())], names=["block", "shard", "counts"]
            )

    dealt = lists.repartition("shard").sortWithinPartitions("shard")
    return mapped(dealt, count, "block bigint, shard bigint, counts binary")


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs``.

    The counts are the library's for the byte-level BPE file at ``path``, with its default for
    special strings inside texts and nothing added. Null and empty texts have no tokens. Rows
    are counted one by one, repeated and null keys included. Texts with special strings or with
    characters on whose class libraries differ are counted whole by the library.
    """
    shards = min(MOST_SHARDS, max(1, docs.count() // SHARD_DOCS))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = written(piece_frequencies(rows, path, shards), "piece-frequencies")
    lists = found.where(F.col("shard").isNotNull()).select("block", "shard", "pieces")
    blocks = found.where(F.col("shard").isNull()).drop("shard", "pieces")
    on_workers(docs.sparkSession)

    def total(block: pa.Table, counted: pa.Table) -> pa.Table:
        own = {c: block.column(c)[0] for c in block.column_names}
        lists = counted.sort_by("shard").column("counts")
        counts = np.frombuffer(b"".join(_unpacked(c.as_py()) for c in lists), np.uint32).astype(np.int64)
        kinds = {"sizes": np.uint32, "docs": np.uint16, "times": np.uint32}
        sizes, docs, times = (np.frombuffer(_unpacked(own[c].as_py()), k) for c, k in kinds.items())
        # The sums stay exact as doubles: a block has far fewer than 2^53 tokens.
        sums = np.bincount(docs, weights=np.repeat(counts, sizes) * times, minlength=len(own["n_bytes"]))
        tokens = sums.astype(np.int64) + np.asarray(own["whole"].values)
        return pa.table({"doc_id": own["doc_ids"].values, "n_bytes": own["n_bytes"].values, "n_tokens": tokens})

    kind = docs.schema[key].dataType.simpleString()
    counted = blocks.groupBy("block").cogroup(piece_counts(lists, path).groupBy("block")).applyInArrow(
        total, f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumnRenamed("doc_id", key)


@QUERIES.add("op9_token_counts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(table(spark, folder, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)
