"""Secret scans: candidates by form, and a random forest that removes the false ones.

Every long token of letters, digits and signs is a candidate. The forest looks at its length,
at how its characters follow each other, at how much of it the words of the corpus cover, at the path it may be
part of, and at the words beside it. It is trained on labelled findings; where no list of these is
given, the plain cases label themselves: what stands quoted behind the name of a credential
is a secret, and what consists of words, of digits or of a path is none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, groups, mapped, table
from graphloom.sources.scratch import written

_CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{16,}")
_WORD = re.compile(r"[^\W\d_]+")
_DICTIONARY_WORD = re.compile(r"(?<![^\W\d_])[^\W\d_]{2,8}(?![^\W\d_])")
#: Names of credentials, and how a value is assigned to one.
_NAME = re.compile(r"(?i)(?:api|access|auth|key|token|secret|passw(?:or)?d|credential|bearer)")
_ASSIGNED = re.compile(r"(?i)([A-Za-z_][\w.-]*)\s*[=:]\s*[\"']?$")
_RUNS = re.compile(r"[A-Za-z]+")

#: A dictionary word is in at least this share of the documents; a document has a bounded number of
#: different words, so their number has a bound as well, whatever the number of documents.
DICTIONARY_SHARE = 0.002
#: About how many labelled findings of each label a forest is fitted on.
FIT_FINDINGS = 4000
FEATURES = (
    "length", "digits", "capitals", "signs", "class_changes", "vowel_changes", "entropy", "hex",
    "coverage", "longest_word", "in_path", "depth", "assigned", "named", "quoted", "word_before", "word_after",
)


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> frozenset[str]:
    """Words of two to eight letters, in small letters, that at least ``share`` of all documents hold, and two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter[str] = Counter()
            for text in batch.column(0):
                held.update(set(_DICTIONARY_WORD.findall((text.as_py() or "").lower())))
            arrays = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

    least = max(2, math.ceil(share * docs.count()))
    counts = mapped(docs.select("text"), count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return frozenset(r["word"] for r in counts.where(F.col("n") >= least).toLocalIterator())


def coverage(token: str, words: frozenset[str]) -> tuple[float, int]:
    """The share of a token's characters that dictionary words cover, laid end to end, and the longest word."""
    covered = longest = 0
    for run in _RUNS.findall(token):
        run = run.lower()
        best = [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            best[end] = best[end - 1]
            for size in range(2, min(8, end) + 1):
                if run[end - size : end] in words:
                    best[end] = max(best[end], best[end - size] + size)
                    longest = max(longest, size)
        covered += best[-1]
    return covered / len(token), longest


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, words: frozenset[str]) -> list[float]:
    """The numbers named in ``FEATURES`` for the candidate at these places."""
    token = text[start:end]
    n = len(token)
    # Long tokens are looked at whole; what lies beside one is a word or a name, and short.
    kinds = [_kind(c) for c in token]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    vowel = [c in "aeiouAEIOU" for c in token]
    turns = sum(a != b for a, b in zip(vowel, vowel[1:]))
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(token).values())
    covered, longest = coverage(token, words)
    before, after = text[max(0, start - 48) : start], text[end : end + 48]
    assigned = _ASSIGNED.search(before)
    left, right = _WORD.findall(before), _WORD.findall(after)
    around = before.rsplit(None, 1)[-1:] if before[-1:].strip() else []
    path = "".join(around) + token + (after.split(None, 1)[0] if after[:1].strip() else "")
    return [
        n, kinds.count(2) / n, kinds.count(1) / n, kinds.count(3) / n, changes / (n - 1), turns / (n - 1), entropy,
        float(all(c in "0123456789abcdefABCDEF" for c in token)), covered, longest,
        float("://" in path or path.count("/") > 1 or path.startswith("./")), path.count("/"),
        float(assigned is not None), float(bool(assigned and _NAME.search(assigned[1]))),
        float(before[-1:] in "\"'" and before != ""), float(bool(left) and left[-1].lower() in words),
        float(bool(right) and right[0].lower() in words),
    ]


def own_label(x: np.ndarray) -> np.ndarray:
    """1 for plain secrets, 0 for plain others, -1 for all that has to be told by the forest."""
    of = {name: x[:, i] for i, name in enumerate(FEATURES)}
    secret = (of["named"] > 0) & (of["quoted"] > 0) & (of["digits"] > 0.1) & (of["coverage"] < 0.6)
    words = (of["digits"] == 0) & (of["coverage"] > 0.6)
    plain = (of["named"] == 0) & (words | (of["digits"] > 0.95) | (of["in_path"] > 0))
    return np.where(secret, 1, np.where(plain, 0, -1))


class Tree:
    """A decision tree as arrays: feature and threshold of each node, its two followers, and a share of secrets."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = 8, least: int = 4):
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.follow: list[tuple[int, int]] = []
        self.share: list[float] = []
        self._grow(x, y, rng, depth, least)
        self.arrays = [np.array(a) for a in (self.feature, self.threshold, self.follow, self.share)]

    def _grow(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> int:
        node = len(self.feature)
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.follow.append((node, node))
        self.share.append(float(y.mean()))
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return node
        best = (0.0, -1, 0.0)
        n, total = len(y), y.sum()
        whole = 2 * total * (n - total) / n
        for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, positive = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            cut = cut[(cut >= least) & (cut <= n - least)]
            if not len(cut):
                continue
            a = positive[cut - 1]
            b = total - a
            impurity = 2 * a * (cut - a) / cut + 2 * b * (n - cut - b) / (n - cut)
            i = int(impurity.argmin())
            gain = whole - impurity[i]
            if gain > best[0] + 1e-12:
                best = (gain, int(f), (v[cut[i] - 1] + v[cut[i]]) / 2)
        if best[1] < 0:
            return node
        self.feature[node], self.threshold[node] = best[1:]
        left = x[:, best[1]] <= best[2]
        self.follow[node] = (
            self._grow(x[left], y[left], rng, depth - 1, least),
            self._grow(x[~left], y[~left], rng, depth - 1, least),
        )
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, follow, share = self.arrays
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return share[at]
            node = at[inner]
            right = x[inner, feature[node]] > threshold[node]
            at[inner] = follow[node, right.astype(int)]


class Forest:
    """Trees over resampled findings, each split among a few features drawn anew."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 40, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            drawn = rng.integers(0, len(y), len(y))
            self.trees.append(Tree(x[drawn], y[drawn], rng))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.empty(0)


def candidates(docs: DataFrame, words: frozenset[str], forest: Forest | None, threshold: float = 0.5) -> DataFrame:
    """A row for each candidate: ``doc_id``, ``start``, ``end`` (code points), ``token_sha256``, ``label`` (its
    own, or -1), ``features``, and by the forest ``probability`` and ``is_secret``."""
    shared = docs.sparkSession.sparkContext.broadcast((words, forest))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, trees = shared.value
        for batch in (g for b in batches for g in groups(b)):
            owner, places, rows, digests = [], [], [], []
            for i, cell in enumerate(batch.column("text")):
                text = cell.as_py() or ""
                for m in _CANDIDATE.finditer(text):
                    owner.append(i)
                    places.append(m.span())
                    rows.append(features(text, *m.span(), known))
                    digests.append(hashlib.sha256(m.group().encode()).hexdigest())
            x = np.array(rows, float).reshape(len(rows), len(FEATURES))
            label = own_label(x)
            chance = trees.predict(x) if trees else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner, pa.int64())),
                    pa.array([s for s, _ in places], pa.int64()),
                    pa.array([e for _, e in places], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(label, pa.int64()),
                    pa.array(list(x), pa.list_(pa.float64())),
                    pa.array(chance, pa.float64()),
                    pa.array(chance >= threshold, pa.bool_()),
                ],
                names=["doc_id", "start", "end", "token_sha256", "label", "features", "probability", "is_secret"],
            )

    columns = (
        "start bigint, `end` bigint, token_sha256 string, label bigint, features array<double>, "
        "probability double, is_secret boolean"
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, find, f"doc_id {kind}, {columns}")


def fit_forest(findings: DataFrame, most: int = FIT_FINDINGS) -> Forest | None:
    """A forest fitted on about ``most`` findings of each ``label``, drawn by hash; None without both labels.

    Every task sends only its drawn findings to the driver, twice ``most`` of a label at the very most.
    """
    chosen = findings.where(F.col("label").isin(0, 1))
    findings = written(chosen.select("label", "features", "token_sha256", "start", "doc_id"), "findings")
    held = {r["label"]: r["n"] for r in findings.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(held) < 2:
        return None
    draw = F.pmod(F.xxhash64("token_sha256", "start", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 0, most / held[0]).otherwise(most / held[1])
    drawn = findings.select("label", "features", draw.alias("draw")).where(F.col("draw") < share)
    rows = sorted((r["label"], r["draw"], r["features"]) for r in drawn.limit(4 * most).collect())
    x, y = np.array([r[2] for r in rows]), np.array([r[0] for r in rows], float)
    return Forest(x, y) if len(set(y)) == 2 else None


def scan(
    docs: DataFrame, learn_from: Column | None = None, labelled: DataFrame | None = None, threshold: float = 0.5
) -> DataFrame:
    """Every candidate of ``docs`` (``doc_id``, ``text``) with the forest's verdict, as in :func:`candidates`.

    The forest learns from ``labelled`` findings (``features``, ``label``, ``token_sha256``, ``start``,
    ``doc_id``) or, without these, from the candidates of the documents under ``learn_from`` that
    label themselves. Without findings of both labels it calls nothing a secret, and probabilities are 0.
    Null and empty texts have no candidates; repeated rows are scanned each.
    """
    words = dictionary(docs)
    if labelled is None:
        learned = docs if learn_from is None else docs.where(learn_from)
        labelled = candidates(learned, words, None)
    return candidates(docs, words, fit_forest(labelled), threshold)


@QUERIES.add("op4_secret_scan")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    found = scan(table(spark, folder, "documents").select("doc_id", "text"), learn)
    return found.select("doc_id", "start", "end", "token_sha256", "probability", "is_secret")
