"""Hard negatives, trie encoding and k-means against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.llm import hard_negatives as hard
from graphloom.llm.bpe_trie import Encoder, decode, encode, merges, round_trip
from graphloom.llm.centroids import Shallot, cluster
from graphloom.llm.hard_negatives import hard_negatives
from graphloom.llm.pieces import vocabulary_path

PATH = vocabulary_path("byte_bpe_50k.json")
VECTORS = "vec_id bigint, embedding array<double>, label int, score double, chunk int, kind string, ids int, row string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, "k", 3, "r") for r in rows], VECTORS).repartition(3)


def plain_negatives(rows, anchors, k=5):
    kept = {}
    for vec_id, v, label in rows:
        if vec_id is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            made = (label, [math.floor(256 * x) for x in v])
            kept[vec_id] = min(kept.get(vec_id, made), made)
    found = set()
    for a in filter(anchors, kept):
        def of(same):
            return sorted((-sum(x * y for x, y in zip(kept[a][1], v)), i) for i, (label, v) in kept.items() if i != a and (label == kept[a][0]) == same)

        for p, positive in of(True)[:k]:
            fit = [(-n, i) for n, i in of(False) if 80 * -p <= 100 * -n <= 100 * -p]
            found |= {(a, positive, rank + 1, i, -p, n) for rank, (n, i) in enumerate(fit[:k])}
    return found


@pytest.mark.parametrize("chunk", [4, 4096])
def test_hard_negatives(spark, monkeypatch, chunk):
    monkeypatch.setattr(hard, "LEAST_CHUNK", chunk)
    monkeypatch.setattr(hard, "TILE_SCORES", 64)
    rng = random.Random(chunk)
    rows = [(i, [rng.choice([-0.1, 0.2, 0.3, 0.30001, 1.0]) for _ in range(4)], rng.choice([0, 0, 0, 1, 2])) for i in range(-40, 60)]
    rows += [(100 + i, [0.3, 0.2, 0.3, 0.2], i % 2) for i in range(30)]  # a vector that repeats
    rows += [(1, [0.2] * 4, 0), (1, [0.2] * 4, 0), (None, [0.2] * 4, 0), (200, None, 0), (202, [0.1, None, 0.1, 0.1], 0), (204, [0.1] * 4, None)]
    rows += [(206, [math.nan] * 4, 0), (208, [math.inf, 0.0, 0.0, 0.0], 1), (210, [], 0), (212, [0.5] * 9, 1), (214, [0.5], 1), (-50, [0.4] * 4, 7)]
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 2 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    expected = plain_negatives(rows, lambda i: i % 2 == 0)
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 500
    assert len({r[2] for r in expected}) == 5
    assert not hard_negatives(frame(spark, []), F.col("vec_id") % 2 == 0).count()


def test_hard_negatives_are_exact(spark):
    # In doubles both negatives would have the score of the positive, which ends in 1.
    rows = [(0, [2.0**20, 1 / 256], 0), (1, [2.0**19, 1 / 256], 0), (2, [2.0**19, 0.0], 1), (3, [2.0**19, 1 / 128], 1), (4, [1.0, 0.0], 1)]
    assert {tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") == 0).collect()} == plain_negatives(rows, lambda i: i == 0)
    too_large = [(0, [2.0**40], 0), (1, [2.0**40], 0)]
    with pytest.raises(Exception, match="beyond 64 bits"):
        hard_negatives(frame(spark, too_large), F.col("vec_id") == 0).collect()


def test_keys_sort_as_their_parts():
    rng = random.Random(1)
    ends = [-(2**63), 2**63 - 1, -1, 0, 1]
    parts = [tuple(rng.choice([*ends, rng.randint(-9, 9)]) for _ in range(3)) for _ in range(300)]
    keys = hard._pack(*(np.array([p[i] for p in parts], np.int64) for i in (0, 1)), 1, np.array([p[2] for p in parts], np.int64))
    assert list(hard._unpack(keys)) == [(a, s, 1, i) for a, s, i in parts]
    assert [p for _, p in sorted(zip(keys.to_pylist(), parts))] == sorted(parts, key=lambda p: (p[0], -p[1], p[2]))


def plain_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(256 * x) for x in v], v) for i, v, _ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    def order(r):
        return (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2])

    centroids = [r[1] for r in sorted(kept, key=order)[:k]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [near(v)[1] for _, v, _ in kept]
        centroids = [
            [sum(c) // len(c) for c in zip(*members)] if (members := [v for (_, v, _), o in zip(kept, own) if o == j]) else centroids[j]
            for j in range(len(centroids))
        ]
    last = [(i, *near(v)) for i, v, _ in kept]
    inertia = {j: sum(d for _, d, o in last if o == j) for _, _, j in last}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, d, j in last), key=str)


@pytest.mark.parametrize(("k", "n"), [(1, 30), (6, 200), (12, 9)])
def test_clusters(spark, k, n):
    rng = random.Random(k)
    middles = [[rng.uniform(-1, 1) for _ in range(3)] for _ in range(4)]
    rows = [(rng.randint(-9, 3 * n), [round(m + rng.gauss(0, 0.02), 2) for m in rng.choice(middles)], 0) for _ in range(n)]
    rows += [(7, [0.5, 0.5, 0.5], 0)] * 5 + [(None, [0.1, 0.2, 0.3], 0), (1, None, 0), (2, [0.1, 0.2], 0), (3, [0.1, None, 0.2], 0), (4, [math.nan] * 3, 0), (5, [math.inf] * 3, 0)]
    found = cluster(frame(spark, rows), k=k, rounds=4, width=3)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_clusters(rows, k, 4, 3)


def test_clusters_of_nothing_and_of_large_numbers(spark):
    assert not cluster(frame(spark, []), width=3).count() and not cluster(frame(spark, [(1, [1.0], 0)]), width=3).count()
    with pytest.raises(Exception, match="beyond"):
        cluster(frame(spark, [(1, [1e30, 0.0, 0.0], 0), (2, [0.0, 0.0, 0.0], 0)]), width=3).collect()


@pytest.mark.parametrize("seed", range(4))
def test_shallot_search_follows_moving_centroids(seed):
    """Bounds carried over rounds give what a full scan gives, and save most of it where there are clusters."""
    rng = np.random.default_rng(seed)
    middles = rng.integers(-900, 900, (12, 5))
    rows = (middles[rng.integers(0, 12, 600)] + rng.integers(-20, 21, (600, 5))).astype(np.int64)
    rows[::7] = rows[0]
    centroids = rows[rng.choice(600, 12, replace=False)]
    centroids[3] = centroids[5]  # a tie
    own, second, upper, lower = np.zeros(600, np.int32), np.ones(600, np.int32), np.full(600, np.inf), np.zeros(600)
    moved, searched = np.zeros(12), []
    for _ in range(8):
        own, second, upper, lower, n = Shallot(centroids, moved).assign(rows, own, second, upper, lower)
        searched.append(n)
        squares = ((rows[:, None, :] - centroids) ** 2).sum(axis=2)
        assert (own == squares.argmin(axis=1)).all() and (upper**2 >= squares.min(axis=1)).all()
        assert (np.maximum(lower, 0) ** 2 <= np.sort(squares, axis=1)[:, 1] + 1e-6).all()
        new = centroids + rng.integers(-2, 3, centroids.shape)
        moved, centroids = np.sqrt(((new - centroids) ** 2).sum(axis=1)), new
    assert searched[0] > 500 and sum(searched[1:]) < 7 * 500


LIBRARY = None


def library():
    global LIBRARY
    if LIBRARY is None:
        from tokenizers import Tokenizer

        LIBRARY = Tokenizer.from_file(PATH)
    return LIBRARY


def of_library(texts):
    return [e.ids for e in library().encode_batch(list(texts), add_special_tokens=False)]


ALPHABET = "aab bc' \n\t.,-09éß日한🙂½²\x1c ͸"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET) | st.text() | st.sampled_from(["<|endoftext|>", "a<|endoftext|> b", "don't 'll've", "==" * 90, "ab" * 300]), max_size=5))
def test_trie_gives_the_ids_of_the_library(texts):
    found = Encoder(merges(PATH)).encode(texts)
    assert [np.frombuffer(f, np.int32).tolist() for f in found] == of_library(texts)


def test_words_share_their_prefixes():
    words = sorted(w.encode() for w in ("token", "tokens", "tokenise", "tokenisation", "to", "zebra"))
    from graphloom.llm.bpe_trie import Trie

    trie = Trie(merges(PATH))
    ids = [list(i) for i in trie.ids(words)]
    assert ids == of_library(w.decode() for w in words)
    assert len(trie) == 1 + len({w[: i + 1] for w in words for i in range(len(w))})
    assert [list(i) for i in trie.ids([b"tokenis"])] == of_library(["tokenis"]) and len(trie) == 1 + len({w[: i + 1] for w in words for i in range(len(w))})


def test_a_trie_that_is_full_starts_anew(monkeypatch):
    from graphloom.llm import bpe_trie

    monkeypatch.setattr(bpe_trie, "MOST_NODES", 20)
    monkeypatch.setattr(bpe_trie, "LONG_WORD", 30)
    encoder, rng = Encoder(merges(PATH)), random.Random(2)
    for _ in range(30):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 90))) for _ in range(4)] + ["y" * 70]
        assert [np.frombuffer(f, np.int32).tolist() for f in encoder.encode(texts)] == of_library(texts)
        assert len(encoder.trie) < 700


@pytest.mark.parametrize("way", [0, 1])
def test_encode_and_decode(spark, docs, no_docs, texts, way):
    found = [decode(encode(docs, PATH), PATH), round_trip(docs, PATH)][way]
    assert found.columns == ["doc_id", "ids", "text"]
    expected = sorted(((i, ids, library().decode(ids, skip_special_tokens=False)) for (i, _), ids in zip(texts, of_library(t or "" for _, t in texts))), key=str)
    assert sorted(((r.doc_id, list(r.ids), r.text) for r in found.collect()), key=str) == expected
    assert all(text == (dict(texts)[i] or "") for i, _, text in expected if i is not None and i != 6)
    assert not [decode(encode(no_docs, PATH), PATH), round_trip(no_docs, PATH)][way].count()


def test_decode_of_any_ids(spark):
    lists = [[], None, [50256, 1, 50256], [220, 50257, -1, 10**6, 64], [187, 188], [160, 64, 161], list(range(300)), [None, 64]]
    found = decode(spark.createDataFrame([(n, ids, "old") for n, ids in enumerate(lists)], "n int, ids array<int>, text string"), PATH).collect()
    def plain(ids):
        return library().decode([i for i in ids or [] if i is not None and 0 <= i <= 50256], skip_special_tokens=False)

    assert {r.n: r.text for r in found} == {n: plain(ids) for n, ids in enumerate(lists)}


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        merges(vocabulary_path("word_bpe_49k.json"))
