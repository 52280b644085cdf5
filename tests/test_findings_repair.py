"""Repairs and differences: marks that are no words, texts of one word, long common runs found without bisection, memory of word lists."""

import random

import pandas as pd
import pytest

from scriptorium.operators import align
from scriptorium.plans import queries

duckdb = pytest.importorskip("duckdb")


def held_against_sql(spark, folder, name, texts):
    pd.DataFrame({"doc_id": range(len(texts)), "text": texts}).to_parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted(map(str, found.fetchall()))
    assert sorted(map(str, (tuple(r[c] for c in names) for r in queries.queries()[name](spark, str(folder)).collect()))) == want
    return want


def test_struck_word_is_no_word(spark, tmp_path):
    """Without its first word the text is 85 of 100 like itself; with a mark that counts as a word it is not."""
    assert held_against_sql(spark, tmp_path, "q94_repaired_anywhere", ["abcde abcdefgh ijklmnop", "abcdef abcdefgh ijklmnop"]) == ["(0, True, True)", "(1, False, False)"]


@pytest.mark.parametrize("name", ["q19_repaired_words", "q76_repair_if_better"])
def test_texts_of_one_word(spark, tmp_path, name):
    """The first of equal words, struck out, is put back in its place, not as another one at the end."""
    assert all("False" not in row for row in held_against_sql(spark, tmp_path, name, [" ".join(["Vich."] * 12), "Ab, " * 20 + "Ab!", "Ab Ab\n\n" * 9]))


def test_long_runs_need_no_bisection(monkeypatch):
    calls = []
    keys = align.Matcher._keys
    monkeypatch.setattr(align.Matcher, "_keys", lambda self, *a: calls.append(a) or keys(self, *a))
    draw = random.Random(3)
    text = "\n".join("".join(draw.choice("abcdefgh ") for _ in range(80)) for _ in range(200))
    found = align.opcodes(text, text.replace("\n", "¶¶"))
    assert [op["op"] for op in found] == ["equal", "replace"] * 199 + ["equal"]
    assert len(calls) < 200


def test_records_need_no_shuffle(spark, capsys):
    pairs = spark.createDataFrame([(1, "a b c", "a x c"), (1, "one", "two"), (None, "p", "pq")], "k int, a string, b string")
    found = align.diff_records(pairs, "k", "a", "b", context=1)
    assert sorted((r["k"] or 0, r["seq"], r["before"], r["after"], r["left"], r["right"]) for r in found.where("k IS NULL OR before = 'b'").collect()) == [(0, 1, "", "q", "p", ""), (1, 1, "b", "x", " ", " ")]
    found.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_short_texts_in_blocks(spark, monkeypatch):
    """Texts about as long as one number's bits, against all pairs; those that fit leave no candidates to fetch texts for."""
    from scriptorium.operators import similar

    monkeypatch.setattr(similar, "SHORT_BLOCK", 7)
    draw, texts = random.Random(8), ["é" * 64, "é" * 63 + "x", "ab", "ac", "ab"]
    while len(texts) < 60:
        base = "".join(draw.choice("abcdefgh/é") for _ in range(draw.randint(60, 68)))
        texts += [base, "".join("z" if draw.random() < 0.1 else c for c in base), base[draw.randint(0, 9) :]]
    assert similar.common_with_all(texts[6], *similar._padded(texts)).tolist() == [align.lcs_length(texts[6], t) for t in texts] or len(texts[6]) > 64
    rows = spark.createDataFrame([(f"n{k:02}", t) for k, t in enumerate(texts)], "id string, text string")
    names = {t: f"n{k:02}" for k, t in reversed(list(enumerate(texts)))}
    want = {(i, j, align.ratio(s, t)) for s, i in names.items() for t, j in names.items() if i < j and align.ratio(s, t) >= 70}
    assert {tuple(r) for r in similar.similar_pairs(rows, least=70.0).collect()} == want and len(want) > 40
    other = [(k, t[1:]) for k, t in enumerate(texts)]
    best = {(k, *min((-align.ratio(s, t), i) for t, i in names.items())) for k, s in other}
    found = similar.best_similar(spark.createDataFrame(other, "id long, text string"), rows, 70.0)
    assert {(r["left_id"], -r["score"], r["right_id"]) for r in found.collect()} == {x for x in best if -x[1] >= 70}
    monkeypatch.setattr(similar, "_verified", lambda least: lambda batches: ({}["no pair has to come here"] for b in batches if len(b)))
    assert similar.similar_pairs(rows.where("length(text) < 30"), least=50.0001).count() == 0
    assert similar.similar_pairs(rows.where("length(text) <= 64"), least=70.0).count() > 5


def test_word_lists_are_flat():
    """The words of many texts take some bytes each, not an object each: 400,000 of them stay under 60 MB at their peak."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["ab cde " * 500, None, "", "1 x <!-- no --> y"] * 400)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    found = align.word_lists(texts, "a-z")
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert peak < 60e6 and len(found) == 1600 and found[1].as_py() is None and found[2].as_py() == []
    assert len(found[0]) == 1000 and found[1599].as_py() == [{"word": "x", "start": 2, "end": 3}, {"word": "y", "start": 16, "end": 17}]


def test_small_ranges_take_few_bins(spark):
    """Ranges of up to 40 parts take at most four bins, and all such ranges share one look for each length."""
    from pyspark.sql import functions as F

    from scriptorium.functions.refs import ref_key
    from scriptorium.operators import ranges

    spans = spark.range(1, 400).select(F.lit(1).alias("doc_id"), F.concat("id", F.lit(".2")).alias("start"), F.concat(F.col("id") + F.col("id") % 40, F.lit(".3")).alias("end"))
    binned = ranges.in_bins(spans.withColumn("_a", ref_key(F.col("start"))).withColumn("_b", ref_key(F.col("end"))))
    assert binned.groupBy("start").count().agg(F.max("count")).first()[0] <= 4
    assert binned.select("_length", "_level").distinct().count() == 2
