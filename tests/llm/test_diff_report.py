"""Rank and totals of the diff report (q20)."""

from scriptorium.operators import rollup
from scriptorium.llm import queries


def test_rank(spark):
    pairs = spark.createDataFrame([(k, 10, 10 + k) for k in range(6)], "pair_id long, n_chars int, n_other int")
    records = spark.createDataFrame([(k, w) for k, w in [(0, False), (1, False), (1, False), (2, True), (3, False), (3, True)]], "pair_id long, whitespace_only boolean")
    got = {r["pair_id"]: (r["n_text"], r["rank"]) for r in rollup.diff_report(pairs, records).collect()}
    assert got == {1: (2, 1), 0: (1, 2), 3: (1, 2), 2: (0, 4), 4: (0, 4), 5: (0, 4)}


def test_query_has_rank_and_totals(spark, tmp_path):
    text = " ".join(f"word{k}" for k in range(300))
    rows = [(1, text), (2, text), (3, text.replace("word7 ", "other ")), (4, text.replace("word7 ", "other ").replace("word90", "more"))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.q20_diff_report(spark, str(tmp_path)).collect()
    total = [r for r in got if r["pair_id"] is None]
    each = {r["pair_id"]: r for r in got if r["pair_id"] is not None}
    assert len(total) == 1 and set(each) == {2, 3, 4}
    assert [each[k]["rank"] for k in (4, 3, 2)] == [1, 2, 3]
    assert (total[0]["n_pairs"], total[0]["n_perfect"], total[0]["n_text"]) == (3, 1, sum(r["n_text"] for r in each.values()))
    assert total[0]["n_chars"] == sum(r["n_chars"] for r in each.values())
