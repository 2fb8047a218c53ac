"""Each stage of the pipeline on its own input, and the queries against their SQL."""

import os
import random

import pytest

import check
import corpus_pipeline
from graphloom.llm.queries import QUERIES
from tests.llm.conftest import LINE, SCHEMA, wide
from tests.llm.test_lines_and_leaks import plain_hits
from tests.llm.test_models import written_in
from tests.llm.test_sets_and_vectors import plain_components

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the tables are not here")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with documents in three invented languages, with planted cases."""
    rng, path = random.Random(4), str(tmp_path_factory.mktemp("tables"))
    rows = []
    for i in range(150):
        language = rng.choice(["aa", "bb", "cc"])
        rows.append((i, written_in(rng, language, 60), language))
    rows += [(200, None, "aa"), (201, "12 34", "bb"), (202, "", None)]
    rows += [(210, rows[3][1], "aa"), (211, rows[3][1] + " mo mi", "aa")]  # copies
    rows += [(220 + i, f"{LINE}\n{written_in(rng, 'aa', 40)}", "aa") for i in range(6)]
    leak = written_in(rng, "bb", 15)
    rows += [(230, f"{written_in(rng, 'bb', 20)} {leak} {written_in(rng, 'bb', 20)}", "bb")]
    made = [(i, t, k, "s", len(t or ""), 7) for i, t, k in rows]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint, key int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    ids = [{r[0] for r in docs.select("doc_id").collect()}]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        docs = spark.read.parquet(str(tmp_path / name))
        if number < 4:
            assert docs.columns == columns
        ids.append({r[0] for r in docs.select("doc_id").collect()})
        if name == "jaccard_join":
            assert ids[-1] == {c for _, _, c in plain_components(before, 5, 80)[0]}
        if name == "decontamination":
            hits = plain_hits(before, [(1, spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"])])
            assert ids[-1] == {d for d, _, h, _ in hits if not h}
        if name == "line_dedup":
            texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.select("doc_id", "text", "n_chars").collect()}
            assert [LINE in texts[i][0] for i in range(220, 226)] == [False] * 5 + [True]
            assert all(len(t) == n for t, n in texts.values())
    assert ids[0] - ids[1] == {200, 201, 202} and ids[1] == ids[2]
    assert ids[2] - ids[3] == {210, 211} and ids[3] - ids[4] == {230} and ids[4] == ids[5]
    assert {r[0] for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()} == ids[5]


def test_one_row_of_each_group_stays(spark, folder):
    text, other = written_in(random.Random(1), "aa", 60), written_in(random.Random(2), "bb", 60)
    rows = [(None, text), (None, text), (7, text), (7, text), (9, text + " mo"), (7, other), (None, other + " x"), (None, None), (None, ""), (3, None)]
    docs = spark.createDataFrame([(i, t, "aa", "s", 1, 7) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, key int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), folder)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(7, text), (7, other), (None, None), (None, ""), (3, None)], key=str)


def test_stages_bear_awkward_rows(spark, folder, texts):
    awkward = spark.createDataFrame(wide(texts), SCHEMA)
    empty = awkward.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name
        assert stage(spark, awkward, folder).count() > 0 or name == "language_id", name


@there
@pytest.mark.parametrize("name", sorted(QUERIES.queries))
def test_query(spark, name):
    assert check.compare(spark, check.database(FOLDER), name, FOLDER, sql=QUERIES.sql, queries=QUERIES.queries) is None


@there
def test_every_number_is_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES.queries) == list(range(1, 14))
