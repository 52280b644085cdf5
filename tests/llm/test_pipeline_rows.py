"""The pipeline's stages on rows whose identifiers are null or repeated."""

import os

import pytest

import corpus_pipeline
from scriptorium.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"] for r in queries.op7_toxicity(spark, SF).where("predicted = 1").collect()}
    clean = sorted(t for k, t in texts.items() if k not in toxic and 300 < len(t) < 3000)
    return docs, texts[min(toxic)], clean


def left(spark, tables, stage, rows):
    docs = tables[0]
    new = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], docs.schema)
    out = stage(spark, docs.where("doc_id < 100000").unionByName(new), SF)
    assert out.columns == docs.columns
    wanted = {t for _, t in rows}
    return sorted(((r["doc_id"], r["text"]) for r in out.where("source = 'x'").collect() if r["text"] in wanted), key=str)


def test_toxic_rows_take_no_others_along(spark, tables):
    _, bad, clean = tables
    rows = [(None, bad), (None, clean[0]), (900001, bad), (900001, clean[1]), (None, clean[2])]
    assert left(spark, tables, corpus_pipeline.toxicity, rows) == sorted([(None, clean[0]), (900001, clean[1]), (None, clean[2])], key=str)


def test_contaminated_rows_take_no_others_along(spark, tables):
    item = max((r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    rows = [(None, f"It says {item} here"), (None, "nothing to see in this row"), (900001, f"{item}"), (900001, "nor is there in that one")]
    assert left(spark, tables, corpus_pipeline.decontamination, rows) == [(900001, "nor is there in that one"), (None, "nothing to see in this row")]


def test_copies_of_repeated_identifiers(spark, tables):
    # the row of 900001 with the first text must go though 900001 keeps another text
    rows = [(900001, "First text, a copy"), (900002, "First TEXT, a copy"), (900001, "Another text"), (None, "With none"), (None, "With none"), (None, "Another text"), (900003, "Twice"), (900003, "TWICE")]
    got = left(spark, tables, corpus_pipeline.exact_duplicates, rows)
    assert [(i, t.lower()) for i, t in got] == [(900001, "another text"), (900002, "first text, a copy"), (900003, "twice"), (None, "with none")]


def test_near_copies_of_repeated_identifiers(spark, tables):
    a, b = (" ".join(f"{x}{k}" for k in range(200)) for x in "uv")
    rows = [(900001, a), (900002, f"{a} more"), (900002, b), (None, f"{b} more"), (None, "alone here with none"), (None, f"{a} again")]
    assert left(spark, tables, corpus_pipeline.near_copies, rows) == sorted([(900001, a), (900002, b), (None, "alone here with none")], key=str)
