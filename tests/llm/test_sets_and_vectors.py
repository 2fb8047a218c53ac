"""The Jaccard join, components and vector search against plain versions."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm import shingle_join, vector_search
from graphloom.llm.components import components
from tests.llm.conftest import passage

_UPPER = {i: i + 32 for i in range(65, 91)}


def sets_of(made, size=4):
    out = []
    for _, text in made:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(_UPPER))
        out.append(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def plain_components(made, size=4, percent=85):
    sets = sets_of(made, size)
    parent = list(range(len(made)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
                links += 1
    smallest = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(made):
        if doc is not None:
            known = smallest[root(i)]
            smallest[root(i)] = doc if known is None else min(known, doc)
    return sorted(((doc, len(s), smallest[root(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(made, sets))), key=str), links


def test_join_of_awkward_texts(docs, texts):
    found = shingle_join.near_duplicates(docs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_components(texts)[0]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 2)] = ["".join(rng.choice("xyz") for _ in range(5)) for _ in range(rng.randint(0, 2))]
    return " ".join(words)


def family_rows(seed=5):
    """Families of near copies around the threshold, of all sizes, with a passage that many share."""
    rng = random.Random(seed)
    made, common = [], passage(99, 45)
    for size in (3, 5, 8, 12, 20, 33, 50, 90, 150, 400):
        base = passage(size, size).split()
        made += [edited(rng, base, rng.randint(0, max(1, size // 25) + 1)) for _ in range(14)]
    made += [f"{passage(1000 + i, 12)} {common}" for i in range(60)]
    rng.shuffle(made)
    return list(enumerate(made, 1))


@pytest.mark.parametrize(("size", "percent", "block"), [(4, 85, 1024), (5, 80, 7)])
def test_join_of_families(spark, size, percent, block, monkeypatch):
    for step in (shingle_join.verified_links, shingle_join.possible):
        monkeypatch.setattr(step, "__defaults__", (85, block))
    made = family_rows()
    rows = spark.createDataFrame(made, "doc_id bigint, text string").repartition(4)
    expected, links = plain_components(made, size, percent)
    found = shingle_join.near_duplicates(rows, size, percent)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert links > 100


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_every_linked_pair_shares_a_signature(percent):
    rng = random.Random(percent)
    made = [t for _, t in family_rows(percent)] + [edited(rng, passage(7, n).split(), k) for n in range(5, 60) for k in range(4)]
    shingles = shingle_join.Shingles(pa.array(made, pa.string()))
    chosen = np.flatnonzero(shingles.sizes)
    owner, signature, flag = shingle_join.signatures(shingles, chosen, shingle_join.Bands(percent))
    index, probe = defaultdict(set), defaultdict(set)
    for o, s, f in zip(owner.tolist(), signature.tolist(), flag.tolist()):
        if f & 1:
            index[s].add(o)
        if f & 2:
            probe[o].add(s)
    sets = sets_of(enumerate(made))
    assert [len(s) for s in sets] == shingles.sizes.tolist()
    linked = missed = 0
    for i in chosen:
        near = set().union(*(index[s] for s in probe[i]))
        for j in chosen:
            if i != j and len(sets[j]) <= len(sets[i]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                linked += 1
                missed += j not in near and i not in set().union(*(index[s] for s in probe[j]))
    assert linked > 50 and missed == 0


def unlike_sets(sizes, seed=8):
    """Random sets of these sizes, as those of texts."""
    rng, sets = np.random.default_rng(seed), shingle_join.Shingles(pa.array([], pa.string()))
    sets.sizes = np.array(sizes, np.int64)
    sets.bounds = np.concatenate([[0], np.cumsum(sets.sizes)])
    sets.members = rng.integers(0, 1 << 64, int(sets.bounds[-1]), np.uint64, endpoint=False)
    return sets


def test_few_unlike_sets_meet_by_what_they_do_not_hold():
    bands = shingle_join.Bands(80)
    # Sets of one band, and the largest of those that ask in it too.
    sets = unlike_sets([316 + i % 158 for i in range(2000)] + [570 + i % 22 for i in range(1000)])
    owner, signature, flag = shingle_join.signatures(sets, np.arange(3000), bands)
    _, at = np.unique(signature, return_inverse=True)
    asking = np.bincount(at, flag & 2 > 0)
    compared = (asking * (np.bincount(at) - 1)).sum()
    assert compared < 1000  # of 4.5 million pairs
    assert len(signature) < 1.35 * (bands.segments[14] * 2000 + bands.segments[15] * 1000 + bands.segments[14] * 1000)


def test_those_that_ask_meet_all_others_and_these_only_them(spark):
    asking = {1: {3, 7, 8, 11}, 2: {5}, 3: set(range(6)), 4: {2}}
    members = {1: range(20), 2: range(9), 3: range(6), 4: range(4)}
    made = [(group, i, i in asking[group]) for group in members for i in members[group]]
    grouped = spark.createDataFrame(made, "leader bigint, handle bigint, probes boolean").repartition(3)
    classes = spark.createDataFrame([(i,) for i in range(20)], "handle bigint")
    met, rows = defaultdict(int), shingle_join.in_blocks(grouped, classes, 5).collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r.leader, r.x, r.y].append(r)
    for (group, x, y), part in parts.items():
        for a in part:
            for b in part:
                if a.own == x and a.probes and b.own == y and (x != y or not b.probes or a.handle < b.handle):
                    met[group, *sorted((a.handle, b.handle))] += a.handle != b.handle
    expected = {(g, a, b) for g in members for a in members[g] for b in members[g] if a < b and asking[g] & {a, b}}
    assert {k for k, n in met.items() if n} == expected and set(met.values()) <= {0, 1}
    # One of nine asks: a block of its own, and those of the others are not copied.
    assert sum(r.leader == 2 and not r.probes for r in rows) == 8


def test_sorted_members_of_texts_of_all_lengths():
    made = [t for _, t in family_rows()] + [None, "", "a", "b a", "c b a", "a", "a a a a a a"]
    for size in (1, 4, 5):
        shingles = shingle_join.Shingles(pa.array(made, pa.string()), size)
        assert shingles.sizes.tolist() == [len(s) for s in sets_of(enumerate(made), size)]
        assert all((np.diff(shingles.of(i)) > 0).all() for i in range(len(made)))
        assert shingles.bounds.tolist() == [0, *np.cumsum(shingles.sizes).tolist()]


def test_signatures_of_one_row_are_shared_by_none(spark):
    made = [(1, 10, 3), (2, 10, 3), (2, 11, 1), (3, 10, 1), (3, 12, 1), (4, 10, 2), (4, 10, 1), (5, 13, 2), (5, 14, 3), (5, 14, 3)]
    rows = spark.createDataFrame(made, "signature bigint, handle bigint, flag tinyint").repartition(3)
    found = sorted(tuple(r) for r in shingle_join.shared_signatures(rows).collect())
    assert found == [(2, 10, 2, True), (2, 11, 2, False), (5, 13, 2, True), (5, 14, 2, True)]


def test_blocks_link_what_is_linked():
    rng = np.random.default_rng(2)
    sets = [np.unique(np.concatenate([np.arange(k * 100, k * 100 + 40), rng.integers(0, 10**6, 3)])).astype(np.uint64) for k in range(6) for _ in range(8)]
    group = [k for k in range(6) for _ in range(8)]
    links = shingle_join.link_block(sets, None)
    assert len(links) == 42 and all(group[i] == group[j] for i, j in links)
    across = shingle_join.link_block(sets[::2], sets[1::2])
    half = group[::2] + group[1::2]
    assert all(half[i] == half[j] and i < 24 <= j for i, j in across) and len(across) == 42


def test_join_of_nothing(no_docs):
    assert shingle_join.near_duplicates(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(45)]
    links += [(7, 7), (300, 300), (3, 2), (2, 3)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: root(i) for i in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(seed=4, n=400, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, width))
    made = [(i, (centres[i % 5] + rng.normal(0, 0.2, width)).tolist()) for i in range(n)]
    made += [(n + i, made[3][1]) for i in range(40)]  # ties
    made += [(-50, made[0][1]), (1000, None), (1050, [1.0, None]), (1100, [float("nan")] * width), (1150, [float("inf")] * width), (1200, []), (1250, [2.0, 1.0]), (None, made[1][1])]
    made += [made[0], made[0], (50, made[50][1])]
    return made


def plain_top(made, k):
    usable = {}
    for i, v in made:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * x) for x in v]
    out = []
    for q in usable:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_vector_search(spark, small, monkeypatch):
    if small:
        for name, value in (("CELL_ROWS", 30), ("BLOCK_ROWS", 20), ("BLOCK_QUERIES", 3)):
            monkeypatch.setattr(vector_search, name, value)
    rows = spark.createDataFrame([(i, v, 1, 0.5) for i, v in vectors()], "vec_id bigint, embedding array<double>, cell int, score double")
    found = vector_search.top_k(rows.repartition(3), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain_top(vectors(), 5)


def test_few_vectors(spark):
    few = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (3, [0.0, 0.1])]
    rows = spark.createDataFrame(few, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in vector_search.top_k(rows, F.col("vec_id") % 50 == 0).collect()) == plain_top(few, 5)
    assert vector_search.top_k(rows.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    alone = vector_search.top_k(rows.where("vec_id = 0"), F.col("vec_id") % 50 == 0)
    assert alone.count() == 0 and alone.columns == ["query_id", "rank", "vec_id", "score"]
    empty = spark.createDataFrame([(0, []), (1, [])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in vector_search.top_k(empty, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 0)]
