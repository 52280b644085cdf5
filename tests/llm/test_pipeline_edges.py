"""Each stage of the pipeline on awkward tables: nulls, empty and very long texts, repeated rows, clashing columns, no rows."""

import os

import pytest

import corpus_pipeline

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, _sha string, id string, score double, bands int, row_key string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, 1, "x", "y", 0.5, 2, "z") for i, t in rows], SCHEMA)


ROWS = [(None, None), (1, None), (2, ""), (3, " \n"), (4, "one"), (None, "one more row"), (5, "x " * 60_000), (6, "long" * 50_000), (7, "twice the same"), (7, "twice the same"), (8, "été 中 \U0001f600")]


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_awkward_rows(spark, name, stage):
    docs = table(spark, ROWS)
    out = stage(spark, docs, SF)
    got = out.collect()
    if name == "packing":
        assert {r["doc_id"] for r in got} == {i for i, _ in ROWS}
        assert sum(r["piece"] == 0 for r in got) == len(ROWS)
        return
    assert out.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got), key=str)
    if name == "exact dedup":  # null and empty are one text, a repeated row stays once
        assert kept == sorted({(i, t) for i, t in ROWS if (i, t) not in ((None, None), (1, None))}, key=str)
    else:
        assert kept == sorted(ROWS, key=str)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_no_rows(spark, name, stage):
    docs = table(spark, ROWS).limit(0)
    assert stage(spark, docs, SF).count() == 0
