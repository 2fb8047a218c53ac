"""Line dedup, decontamination and URL filters against plain versions."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from graphloom.llm import decontaminate, line_dedup, url_filter
from graphloom.llm.cuckoo import CuckooFilter
from tests.llm.conftest import LINE, passage

_UPPER = {i: i + 32 for i in range(65, 91)}


def plain_dedup(made, min_chars=40, min_docs=5):
    held, last = defaultdict(int), {}
    for doc, text in made:
        for k in {p.strip(" \t\n\v\f\r").translate(_UPPER) for p in (text or "").split("\n")}:
            if len(k) >= min_chars:
                held[k] += 1
                last[k] = max((x for x in (last.get(k), doc) if x is not None), default=None)
    out = []
    for doc, text in made:
        parts = (text or "").split("\n")
        kept = []
        for p in parts:
            k = p.strip(" \t\n\v\f\r").translate(_UPPER)
            if not (held[k] >= min_docs and (doc is None or last[k] is None or doc < last[k])):
                kept.append(p)
        out.append((doc, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(docs, texts):
    found = line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "text", "row.hits").collect()
    assert sorted(((r[0], r[1], r[2], r[3] or "") for r in found), key=str) == plain_dedup(texts)
    assert {r[4] for r in found} == {1}
    assert any(r[2] for r in found)


def test_line_dedup_without_filters(docs, texts, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_FILTER_BYTES", -1)
    found = line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(((r[0], r[1], r[2], r[3] or "") for r in found), key=str) == plain_dedup(texts)


def test_line_dedup_of_nothing(no_docs):
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_index_takes_documents_back(spark, tmp_path):
    made = [(i, f"{LINE}\nown line number {i}") for i in range(8)]
    other = [(20 + i, f"another line that is long enough to be looked at at all\n{i}") for i in range(6)]
    table = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))

    def dropped(rows):
        return {r[0] for r in index.dedup(table(rows)).where("n_dropped > 0").select("row.doc_id").collect()}

    index.insert(table(made), 1)
    assert dropped(made) == set(range(7))
    index.insert(table(other), 2)
    assert dropped(made + other) == {*range(7), *range(20, 25)}
    index.delete(table(made[4:]), 3)
    assert dropped(made + other) == set(range(20, 25))
    counts = {r["n_docs"] for r in index.counts().collect()}
    assert counts == {1, 4, 6} or counts == {4, 6}
    index.delete(table(other), 4)
    assert dropped(made + other) == set()


def test_index_outgrows_its_filters_and_is_opened_again(spark, tmp_path):
    def docs(first, lines):
        rows = [(first + i, "\n".join(f"repeated line {n} that is long enough to be looked at" for n in lines)) for i in range(5)]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    path = str(tmp_path / "index")
    index = line_dedup.LineIndex(spark, path)
    few, many = docs(0, range(10)), docs(10, range(10, 2_000))
    assert not index.dedup(few).where("n_dropped > 0").count()  # nothing is in yet
    index.insert(few, 1)
    index.insert(many, 2)
    both = few.union(many)

    def dropped(of):
        return {r[0]: r[1] for r in of.dedup(both).select("row.doc_id", "n_dropped").collect()}

    all_in = {**{i: 10 for i in range(4)}, 4: 0, **{10 + i: 1_990 for i in range(4)}, 14: 0}
    assert dropped(index) == all_in == dropped(line_dedup.LineIndex(spark, path))
    again = line_dedup.LineIndex(spark, path)
    again.delete(many, 3)
    assert dropped(again) == {**all_in, **{10 + i: 0 for i in range(4)}} == dropped(line_dedup.LineIndex(spark, path))


def test_index_with_full_filters_builds_them_anew(spark, tmp_path):
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    docs = spark.createDataFrame(
        [(i, "\n".join(f"line {n} of these is long enough to be looked at" for n in range(300))) for i in range(5)],
        "doc_id bigint, text string",
    )
    index.insert(docs.limit(0), 1)
    index.room = 1_000  # more than the filters hold
    index.insert(docs, 2)
    assert {r[0] for r in index.dedup(docs).select("n_dropped").collect()} == {0, 300}
    assert sum(r[0] for r in index.dedup(docs).select("n_dropped").collect()) == 4 * 300


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    cuckoo = CuckooFilter.of(keys[:10_000])
    assert cuckoo.found(keys[:10_000]).all() and cuckoo.found(keys[10_000:]).mean() < 0.001
    cuckoo.delete(keys[:5_000])
    again = CuckooFilter.from_bytes(cuckoo.to_bytes())
    assert again.found(keys[5_000:10_000]).all() and again.found(keys[:5_000]).mean() < 0.001
    assert again.insert(keys[:5_000]) and again.found(keys[:10_000]).all()
    full = CuckooFilter(1)
    assert not full.insert(keys[:50]) and not full.table.any()
    assert len(CuckooFilter.of(keys[:0]).found(keys[:0])) == 0


def bench_rows():
    return [(1, passage(9, 25)), (2, "Two, words"), (3, None), (4, ""), (5, passage(9, 25)), (None, passage(6, 9_000)[:400]), (10, passage(77, 30))]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(bench_rows(), "item_id bigint, text string")


def plain_hits(made, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(_UPPER))
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in made:
        w = word.findall((text or "").translate(_UPPER))
        hits, names = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hits.update(range(i, i + n))
                    names.update(str(x) for x in own if x is not None)
        out.append((doc, len(w), sorted(hits), sorted(names)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [500_000, 7])
def test_contamination(docs, texts, bench, most):
    found = decontaminate.contamination(docs, bench, most_windows=most).select("row.doc_id", "n_words", "hits", "items").collect()
    expected = plain_hits(texts, bench_rows())
    assert sorted((tuple(r) for r in found), key=str) == expected
    assert sum(bool(h) for _, _, h, _ in expected) >= 4


def test_removal(docs, texts, bench):
    hit = {str((d, bool(h))) for d, _, h, _ in plain_hits(texts, bench_rows()) if h}
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == len(texts) - sum(bool(h) for _, _, h, _ in plain_hits(texts, bench_rows())) and hit
    cut = decontaminate.decontaminate(docs, bench, drop="spans")
    assert cut.columns == docs.columns and cut.count() == len(texts)
    by_id = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert by_id[17] == passage(4, 30) + "  " + passage(5, 30) and by_id[18] == "" and by_id[0] is None
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, drop="all")


def test_contamination_of_nothing(no_docs, docs, bench):
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("size(hits) > 0").count() == 0


def test_automaton_against_patterns():
    globs = ["*.com/**", "a?c*", "**z", "*", "**", "x\\*y", "*ab*ab*", "a" * 70 + "*b", "", "é?"]
    rng = random.Random(3)
    texts = ["".join(rng.choice("abz/.cx*é") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    texts += ["", "x*y", "a" * 70 + "b", "a" * 75 + "b", "m.com/x/y", "abxabz", "éa"]

    def pattern(glob):
        parts = re.findall(r"\\.|\*\*|.", glob, re.DOTALL)
        of = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
        return re.compile("".join(of.get(p, re.escape(p[-1])) for p in parts), re.DOTALL)

    # A ? stands for one byte, so texts are compared byte by byte.
    raw = [t.encode().decode("latin-1") for t in texts]
    plain = [[bool(pattern(g.encode().decode("latin-1")).fullmatch(t)) for g in globs] for t in raw]
    assert url_filter.Automaton(globs).matches([t.encode() for t in texts]).tolist() == plain


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.COM/x", "https://www.EXAMPLE.com/en/1?q#h", "http://example.com/en/",
        "http://x.example.com/en/x", "http://notexample.com/en/", "http://example.com", "http://b.net/es/../", "b://b.net/fr",
        "ftp://q.net/x.com/", "http://h?x=/com/", "http://" + "a" * 5000 + ".net/fr/" + "b" * 5000, "x://y://z.com/",
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] * 2, "page_id bigint, url string, host string, rule string")
    found = url_filter.judge_urls(pages, url_filter.CONTRACT_RULES)
    assert found.count() == 2 * len(urls)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in found.collect()}
    rules = [None, None, None, None, "com/", "www.example.com/en/", "example.com/en/", "example.com/en/", "com/", None, "net/es/", None, None, None, "net/fr/", None]
    block = {"example.com/en/", "net/es/", "net/fr/"}
    assert [got[i][0] for i in range(len(urls))] == rules
    assert [got[i][1] for i in range(len(urls))] == ["block" if r in block else "allow" for r in rules]
    assert url_filter.judge_urls(pages.limit(0), url_filter.CONTRACT_RULES).count() == 0
    assert url_filter.judge_urls(pages, []).where("verdict = 'allow' and rule is null").count() == 2 * len(urls)
