"""BPE ids of whole texts by a trie of their distinct words, and texts back from ids.

The encoding of a prefix of a word is that of a shorter prefix and one more token: exactly one token that
ends the prefix is such that merging would make the token itself out of its bytes and would
not merge across the boundary before it. So a node of the trie, which stands for a prefix, needs a state of
its last token and the node before that token, found from the states above it. Words are inserted in
order, which goes through the trie depth first; a prefix that several words share is solved once. The ids of
a word are read off from its node backwards.

A task keeps one trie and the ids of its words until they are many, and then starts anew. Nothing is shuffled.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, groups, mapped, table
from graphloom.llm.pieces import _PIECE, _byte_of, odd, vocabulary_path

#: Nodes and words that a trie has before a new one is started; words longer than so many bytes get one of their own.
MOST_NODES, MOST_WORDS, LONG_WORD = 600_000, 300_000, 512
#: Boundaries between tokens that are remembered at once.
_MOST_PAIRS = 1_000_000
#: Rows that are decoded at once.
_DECODED_ROWS = 500


class Merges:
    """The tokens of a byte-level BPE file and the order in which they are merged."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.path = path
        model, cut, byte = whole["model"], whole.get("pre_tokenizer") or {}, _byte_of()
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        set_ = [k for k in ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        added = whole.get("added_tokens") or []
        moved = [t["content"] for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
        if model.get("type", "BPE") != "BPE" or not plain or whole.get("normalizer") or set_ or moved:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        #: The bytes of each id; those of an added token are its text's.
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, number in vocab.items():
            self.bytes_of[number] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.id_of = {bytes([b]): vocab[c] for c, b in byte.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            if made in self.halves:
                raise ValueError(f"{path} makes {left + right!r} by two merges")
            self.rank[pair], self.halves[made] = rank, pair
            self.id_of[self.bytes_of[made]] = made
        # Sizes of the tokens of three bytes and more by their last three, longest first: what to try at a node.
        sizes: dict[bytes, set[int]] = {}
        for data in self.id_of:
            if len(data) > 2:
                sizes.setdefault(data[-3:], set()).add(len(data))
        self.sizes = {end: tuple(sorted(found, reverse=True)) for end, found in sizes.items()}
        self._sound: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self._ends: dict[int, list[tuple[int, float]]] = {}
        self._starts: dict[int, list[tuple[int, float]]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces that stand at one edge of a token while it is merged, each with the rank that takes it up."""
        known = self._ends if side else self._starts
        if token not in known:
            if token in self.halves:
                inner = self._edge(self.halves[token][side], side)
                known[token] = [*inner[:-1], (inner[-1][0], self.rank[self.halves[token]]), (token, math.inf)]
            else:
                known[token] = [(token, math.inf)]
        return known[token]

    def apart(self, left: int, right: int, whole: bool = False) -> bool:
        """Whether merging leaves two neighbours as they are; ``whole``: until both are complete."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            done = x_taken == y_taken == math.inf
            if done and whole:
                return True
            merged = self.rank.get((x, y))
            # Equal merges go from left to right: the one inside the left token comes first, the one inside the right last.
            if merged is not None and merged < x_taken and merged <= y_taken:
                return False
            if done:
                return True
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1

    def sound(self, token: int) -> bool:
        """Whether merging makes a token out of its own bytes."""
        known = self._sound.get(token)
        if known is None:
            known = True
            if token in self.halves:
                left, right = self.halves[token]
                known = self.sound(left) and self.sound(right) and self.apart(left, right, whole=True)
            self._sound[token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """:meth:`apart`, remembered."""
        key = left * self.size + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.apart(left, right)
        return known


@functools.cache
def merges(path: str) -> Merges:
    """One for each path in a worker."""
    return Merges(path)


class Trie:
    """Prefixes of words as nodes: the last token of each, and the node that it follows."""

    def __init__(self, vocab: Merges):
        self.vocab = vocab
        self.children: dict[int, int] = {}
        self.last = array("i", [-1])
        self.before = array("i", [-1])

    def ids(self, words: list[bytes]) -> Iterator[array]:
        """The ids of words, which come in order: the nodes of the part shared with the word before are at hand."""
        children, last, before, state = self.children, self.last, self.before, self._state
        child = children.get
        path, previous = [0], b""
        for word in words:
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del path[shared + 1 :]
            node = path[-1]
            for depth in range(shared, len(word)):
                key = node << 8 | word[depth]
                node = child(key)
                if node is None:
                    token, start = state(word, depth + 1, path)
                    node = children[key] = len(last)
                    last.append(token)
                    before.append(start)
                path.append(node)
            previous, found = word, array("i")
            while node:
                found.append(last[node])
                node = before[node]
            found.reverse()
            yield found

    def _state(self, word: bytes, end: int, path: list[int]) -> tuple[int, int]:
        """The last token of a prefix and the node before it; ``path`` has the nodes of all shorter prefixes."""
        vocab, last = self.vocab, self.last
        id_of, pairs, whole = vocab.id_of, vocab.pairs, vocab.size
        for size in vocab.sizes.get(word[end - 3 : end], ()) if end > 2 else ():
            if size <= end:
                token = id_of.get(word[end - size : end])
                if token is not None and vocab.sound(token):
                    start = path[end - size]
                    if size == end:
                        return token, start
                    key = last[start] * whole + token
                    if pairs[key] if key in pairs else vocab.follows(last[start], token):
                        return token, start
        if end > 1:
            token = id_of.get(word[end - 2 : end])
            if token is not None and vocab.sound(token) and (end == 2 or vocab.follows(last[path[end - 2]], token)):
                return token, path[end - 2]
        return id_of[word[end - 1 : end]], path[end - 1]

    def __len__(self) -> int:
        return len(self.last)


class Encoder:
    """Ids of texts, with the trie and the words met so far."""

    def __init__(self, vocab: Merges):
        self.vocab = vocab
        self.known: dict[str, bytes] = {}
        self.trie = Trie(vocab)
        self._library = None

    def _cut_by_library(self, text: str) -> list[str]:
        """Words of a text with characters that libraries class differently, as the vocabulary's own library cuts it."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.vocab.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """Words of a text; those at odd places are added tokens."""
        found: list[str] = []
        for part in self.vocab.cut.split(text) if self.vocab.cut else [text]:
            if part in self.vocab.special:
                found.append(part)
            elif part:
                found += self._cut_by_library(part) if odd(part) else _PIECE.findall(part)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit integers one after the other."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > MOST_WORDS or len(self.trie) > MOST_NODES:
            self.known, self.trie = {}, Trie(self.vocab)
        known = self.known
        for token, number in self.vocab.special.items():
            known[token] = array("i", [number]).tobytes()
        new = {w.encode(): w for w in set(itertools.chain.from_iterable(cut)).difference(known)}
        short = sorted(w for w in new if len(w) <= LONG_WORD)
        for word, ids in zip(short, self.trie.ids(short)):
            known[new[word]] = ids.tobytes()
        long = [w for w in new if len(w) > LONG_WORD]
        for word in long:
            known[new[word]] = next(Trie(self.vocab).ids([word])).tobytes()
        found = [b"".join(map(known.__getitem__, words)) for words in cut]
        for word in long:
            del known[new[word]]
        return found


    def lists(self, texts: pa.Array) -> pa.ListArray:
        """:meth:`encode` for a column of texts, null ones as empty."""
        found = self.encode([t or "" for t in texts.to_pylist()])
        offsets = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(found))]))


class Decoder:
    """Texts of ids."""

    def __init__(self, vocab: Merges):
        self.size = vocab.size
        self.tokens = pa.array([*vocab.bytes_of, b""], pa.large_binary())

    def texts(self, lists: pa.ListArray) -> pa.Array:
        numbers = np.array(lists.flatten().fill_null(-1), np.int64)
        numbers[(numbers < 0) | (numbers >= self.size)] = self.size
        sizes = np.asarray(pa.compute.list_value_length(lists).fill_null(0), np.int64)
        data, bounds = _joined(self.tokens.take(pa.array(numbers)))
        ends = bounds[np.cumsum([0, *sizes])].tolist()
        whole = memoryview(data)
        return pa.array([str(whole[a:b], "utf-8", "replace") for a, b in zip(ends, ends[1:])], pa.string())


def _joined(values: pa.Array) -> tuple[bytes | pa.Buffer, np.ndarray]:
    """All bytes of an array one after the other, and where each value starts and the last ends."""
    _, offsets, data = values.buffers()
    if offsets is None or not len(values):
        return b"", np.zeros(len(values) + 1, np.int64)
    return data or b"", np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]


def _rows(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows, rows.schema["key"].dataType.simpleString()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` of every row of ``docs``, as the library gives them without a post-processor.

    The vocabulary at ``path`` is a byte-level BPE file of the ``tokenizers`` library; any other ends the run. Added
    tokens inside texts are taken as such, as is the library's default. Null and empty texts have no ids. Rows are encoded
    one by one, repeated and null keys included, whole however long they are, and an empty table gives no rows.
    """
    rows, kind = _rows(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges(path))
        for batch in batches:
            for part in groups(batch):
                yield pa.RecordBatch.from_arrays([part.column("key"), encoder.lists(part.column("text"))], names=["key", "ids"])

    return mapped(rows, run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The rows with the text of their ids in ``out``: added tokens are kept, ids that the vocabulary lacks are left out, and
    bytes that are no text become replacement characters. Null or no ids give an empty text."""
    kept = [F.col(c) if c != ids else F.col(ids).cast("array<int>").alias(ids) for c in rows.columns if c != out]
    columns = rows.select(F.struct(*kept).alias("row"))
    kind = columns.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(merges(path))
        for batch in batches:
            for start in range(0, batch.num_rows, _DECODED_ROWS):
                row = batch.column("row").slice(start, _DECODED_ROWS)
                yield pa.RecordBatch.from_arrays([row, decoder.texts(row.field(ids))], names=["row", "text"])

    return mapped(columns, run, f"row {kind}, text string").select("row.*", F.col("text").alias(out))


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``text`` after :func:`encode` and :func:`decode`, in one go between Spark and its workers."""
    rows, kind = _rows(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(merges(path)), Decoder(merges(path))
        for batch in batches:
            for part in groups(batch):
                ids = encoder.lists(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("key"), ids, decoder.texts(ids)], names=["key", "ids", "text"])

    return mapped(rows, run, f"key {kind}, ids array<int>, text string").withColumnRenamed("key", key)


@QUERIES.add("op12_bpe_round_trip")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary_path("byte_bpe_50k.json")
    found = round_trip(table(spark, folder, "documents"), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
