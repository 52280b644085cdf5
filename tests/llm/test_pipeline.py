"""The pipeline's stages on the smallest tables, against plain Python where SQL says nothing."""

import os
import zlib

import pytest

import corpus_pipeline
from scriptorium.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        docs = corpus_pipeline.written(out, "test")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before) and all(after[k] == before[k] for k in after)
        gone = set(before) - set(after)
        if name == "exact dedup":
            texts = {}
            for k, t in before.items():
                texts.setdefault(t.encode().translate(FOLD), []).append(k)
            assert set(after) == {max(v) for v in texts.values()}
        if name == "decontamination":
            leaked = {k for k, t in before.items() if any(b in " ".join(t.lower().split()) for b in bench)}
            assert leaked <= gone and len(gone) <= len(leaked) + 2
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(before)
    assert max(r["offset"] + r["length"] for r in pieces) <= 4096


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_registered(spark, name):
    df = queries.queries()[name](spark, SF)
    n = df.count()
    assert n >= (1 if name.startswith(("op6", "q")) else 50)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, found.fetchall()))


def test_held_out_rule(spark):
    rows = queries.op7_toxicity(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
