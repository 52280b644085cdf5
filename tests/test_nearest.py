"""Benchmark items against all documents (q18), compared with every pair."""

import random

from scriptorium.operators import align, link
from scriptorium.plans import queries


def test_best_match_reads_all_documents(spark, tmp_path):
    rng = random.Random(8)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(k, text(rng.choice((1, 5, 20, 60, 300)))) for k in range(150)] + [(200, None), (201, ""), (202, "")]
    items = [(k, text(rng.randrange(1, 50))) for k in range(150)] + [(500, docs[7][1]), (501, ""), (502, None)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {}
    for i, a in items:
        if a is not None:
            score, j = max((align.ratio(a, b), -j) for j, b in docs if b is not None)
            want[i] = (-j, score)
    got = {r["left_id"]: (r["right_id"], r["score"]) for r in queries.q18_best_match(spark, str(tmp_path)).collect()}
    assert got == want and got[501] == (201, 100.0)
    blocks = link.nearest(bench, spark.createDataFrame(docs, "doc_id long, text string"), left_id="item_id", right_id="doc_id", block_chars=500)
    assert {r["left_id"]: (r["right_id"], r["score"]) for r in blocks.collect()} == want
