"""Token counts and packing against the library, id by id."""

import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

from graphloom.llm import packing, pieces, token_counts
from tests.llm.conftest import passage

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return pieces.vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


AWKWARD = [
    "", " ", "  ", "a  b", "a   b ", "\n\n x", " \n", "x\n \ny", "don't we'll ''s 'S", "ab12cd_34-e", "  a  b", "½²Ⅷ x",
    "a\x1cb", "͸ unassigned", "日本 語  text", "é ‍😀😀", "<|endoftext|>", "x<|endoftext|> y", "_ __ a_b", "\t\tx\r\n  y",
    "١٢٣ ५६", "a" * 3000, "1" * 300, "?!" * 400, "É É", " 　 ", "x 　", "'", "'' '", "\x00 \x7f",
]


def test_ids_of_awkward_texts(path, library):
    vocab = pieces.Vocabulary(path)
    for text in AWKWARD + [a + b for a in AWKWARD for b in AWKWARD]:
        assert vocab.ids(text).tolist() == ids_of(library, text), repr(text)


def test_every_character_is_classed_as_the_library_does(path, library):
    vocab = pieces.Vocabulary(path)
    for start in range(0, 0x110000, 97):
        if not 0xD800 <= start < 0xE000:
            c = chr(start)
            text = f"a{c}1{c}!{c} {c}b"
            if not vocab.irregular(text):
                assert sum(vocab.count(vocab.split(text))) == len(ids_of(library, text)), hex(start)
                assert vocab.ids(text).tolist() == ids_of(library, text), hex(start)


def test_spaces_of_all_kinds_and_in_pairs(path, library):
    vocab = pieces.Vocabulary(path)
    spaces = [c for c in map(chr, range(0x110000)) if c.isspace() and not pieces.odd(c)]
    assert sorted(pieces._SPACE) == spaces
    for a in spaces:
        for b in ["", *spaces]:
            text = f"x{a}{b}y {a}1'{b}s é{a}'ll{b}"
            assert pieces.spaced(a + b) == bool(b) and vocab.ids(text).tolist() == ids_of(library, text), repr(text)


def test_ids_cost_no_more_than_plain_encoding(path):
    # An empty special string was looked for at each character, and what follows each space was looked at.
    vocab, texts = pieces.Vocabulary(path), [passage(k, 2000) for k in range(30)]
    took = {vocab.ids: [], vocab._encoder.encode_ordinary: []}
    for _ in range(7):
        for encode, seconds in took.items():
            start = time.process_time()
            for text in texts:
                encode(text)
            seconds.append(time.process_time() - start)
    ours, plain = map(min, took.values())
    assert ours < plain


def test_without_ranks_the_library_reads(path, library, monkeypatch):
    monkeypatch.setattr(pieces, "_ranked", lambda path: None)
    vocab = pieces.Vocabulary(path)
    assert vocab.irregular("plain") and vocab.ids(passage(3, 50)).tolist() == ids_of(library, passage(3, 50))


def test_other_files_have_no_ranks():
    assert pieces._ranked(pieces.vocabulary_path("word_bpe_49k.json")) is None


@pytest.mark.parametrize("small", [False, True])
def test_counts(docs, texts, path, library, small, monkeypatch):
    if small:
        monkeypatch.setattr(token_counts, "SHARD_DOCS", 4)
    found = token_counts.token_counts(docs, path)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    expected = sorted(((i, len((t or "").encode()), len(ids_of(library, t))) for i, t in texts), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_counts_of_nothing(no_docs, path):
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_piece_lists():
    for texts in ([], ["a"], ["", "é", "b\x00c"], [passage(1, 30)]):
        assert token_counts._unpack_texts(token_counts._pack_texts(texts)) == texts


@pytest.mark.parametrize("shard_docs", [512, 5])
def test_packing_keeps_every_id(docs, texts, path, library, shard_docs):
    found = packing.pack(docs, path, shard_docs=shard_docs).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    if shard_docs == 512:
        assert sum(sum(r["length"] for r in own) < 2048 for own in by_sequence.values()) == 1
    expected = defaultdict(list)
    for i, t in texts:
        ids = [*ids_of(library, t), 1]
        expected[i, len(ids)].append(ids)
    assert set(by_doc) == set(expected)
    for key, own in by_doc.items():
        n = len(expected[key])
        starts = defaultdict(list)
        for r in own:
            starts[r["start"]].append(r)
        assert sum(r["length"] for r in own) == n * key[1]
        if n == 1:
            joined = b"".join(starts[s][0]["ids"] for s in sorted(starts))
            assert np.frombuffer(joined, "<u4").tolist() == expected[key][0]


def test_packing_takes_the_likest(path):
    rng = np.random.default_rng(0)
    topics = [rng.choice(np.arange(100 * k, 100 * k + 100), (12, 60)) for k in range(1, 7)]
    docs = [d for group in zip(*topics) for d in group]
    index = packing.InvertedIndex(docs)
    for i in range(len(docs)):
        scores = index.scores(i)
        scores[i] = -1
        assert scores.argmax() % 6 == i % 6
    windows = defaultdict(list)
    for doc, _, _, sequence, _ in packing.fill(docs, 360):
        windows[sequence].append(doc % 6)
    assert np.mean([len(set(w)) for w in windows.values()]) < 1.5


@pytest.mark.parametrize("share", [1, 4, 1000])
@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_filling_takes_the_best_free_document(share, kind, monkeypatch):
    # Common and rare terms are scored by different ways, and copies are ties.
    monkeypatch.setattr(packing, "COMMON_SHARE", share)
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.3, rng.integers(1, 90)).clip(0, 300).astype(kind) for _ in range(60)]
    docs += [docs[i].copy() for i in rng.integers(0, 60, 20)]
    for doc in docs:
        for made, expected in zip(packing._terms(doc), np.unique(doc, return_counts=True)):
            assert made.tolist() == expected.tolist()
    index, free, taken, at = packing.InvertedIndex(docs), [True] * len(docs), [], 0

    def take(doc):
        nonlocal at
        free[doc], at = False, at + len(docs[doc])
        taken.append(doc)

    while any(free):
        seed = free.index(True)
        take(seed)
        while at % 100 and any(free):
            window = at // 100
            order = np.argsort(-index.scores(seed), kind="stable").tolist()
            while at // 100 == window and any(free):
                seed = next(d for d in order if free[d])
                take(seed)
    assert [d for d, start, *_ in packing.fill(docs, 100) if start == 0] == taken


def test_scores_are_bm25():
    docs = [np.array(d) for d in ([1, 2, 2, 3], [2, 5], [7, 7, 7, 8, 9], [3, 8], [1], [])]
    index = packing.InvertedIndex(docs)
    n, mean = len(docs), np.mean([len(d) for d in docs])
    for q in range(n):
        for d in range(n):
            total = 0.0
            for term in set(docs[q].tolist()):
                held = sum(term in x for x in docs)
                f = (docs[d] == term).sum()
                idf = max(0, np.log((n - held + 0.5) / (held + 0.5)))
                total += idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
            assert abs(index.scores(q)[d] - total) < 1e-9


def topical(n, topics=8):
    """Texts of many topics, each with words of its own, and their topics."""
    rng = np.random.default_rng(7)
    words = [passage(1000 + k, 60).split() for k in range(topics)]
    common = passage(999, 40).split()
    return [(i, " ".join([*rng.choice(words[i % topics], 30), *rng.choice(common, 10)])) for i in range(n)]


def test_shards_hold_what_is_alike(spark, path):
    rows = topical(640)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    tokens = packing.written(packing.token_ids(docs, path), "test-tokens")
    dtype = pieces.vocabulary(path).dtype
    corpus = packing.corpus_of(tokens, dtype)
    ids = [pieces.vocabulary(path).ids(t) for _, t in rows]
    held = np.bincount(np.concatenate([np.unique([*x, 1]) for x in ids]), minlength=len(corpus.idf))
    assert corpus.n == 640 and abs(corpus.mean - np.mean([len(x) + 1 for x in ids])) < 1e-9
    assert np.allclose(corpus.idf, np.maximum(0, np.log((640 - held + 0.5) / (held + 0.5))))
    shard = {r["doc_id"]: r["shard"] for r in packing.dealt(tokens, corpus, dtype, 80).collect()}
    assert len(shard) == 640 and len(set(shard.values())) >= 6
    index = packing.InvertedIndex(ids, corpus)
    kept = []
    for i in range(0, 640, 4):
        scores = index.scores(i)
        scores[i] = -1
        kept += [shard[j] == shard[i] for j in np.argsort(-scores)[:5].tolist()]
    assert np.mean(kept) > 0.7  # of an eighth by chance


def test_copies_make_no_large_shard(spark, path):
    rows = [(i, passage(5, 30)) for i in range(300)] + topical(100)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    tokens = packing.written(packing.token_ids(docs, path), "test-tokens")
    dtype = pieces.vocabulary(path).dtype
    sizes = packing.dealt(tokens, packing.corpus_of(tokens, dtype), dtype, 20).groupBy("shard").count().collect()
    assert sum(r["count"] for r in sizes) == 400 and max(r["count"] for r in sizes) < 60


def test_packing_of_nothing(no_docs, path):
    assert packing.pack(no_docs, path).count() == 0
