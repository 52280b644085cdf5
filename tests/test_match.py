"""Best files of a folder and hashes in headers, on literal cases."""

import hashlib

from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.operators import match


def test_best_files(spark):
    files = [("d", "a.md", "अग्नि मीळे पुरोहितं"), ("d", "b.md", "---\nk: v\n---\n# head\n**अग्नि** मीळे <!-- अन्य --> पुरोहितम्"), ("d", "c.repaired.md", "अग्नि मीळे पुरोहितम् यज्ञस्य"), ("d", "e.md", "no script at all"), ("x", "a.md", "दूरे")]
    left = spark.createDataFrame([("d", "s.md", "अग्नि मीळे पुरोहितम् यज्ञस्य"), ("d", "t.md", "अग्नि मीळे पुरोहितं"), ("none", "u.md", "अग्नि")], "dir string, name string, text string")
    got = {(r["dir"], r["name"]): (r["match"], round(r["score"], 3), r["n_different"]) for r in match.best_files(left, spark.createDataFrame(files, left.schema)).collect()}
    a, b = "अग्नि मीळे पुरोहितम् यज्ञस्य", "अग्नि मीळे पुरोहितम्"
    assert got == {("d", "s.md"): ("b.md", round(200 * len(b) / (len(a) + len(b)), 3), len(a) - len(b)), ("d", "t.md"): ("a.md", 100.0, 0)}


def test_with_content_hash(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    whole = f"---\ntitle: नाम\ngrantha_hash: {sha('नामअग्निमीळे')}\n---\nअग्नि मीळे ॥ १ ॥\n"
    rows = [(1, "---\ntitle: नाम\n---\nअग्नि मीळे ॥ १ ॥\n"), (2, whole), (3, whole.replace(sha("नामअग्निमीळे"), "old")), (4, "no header"), (5, None), (6, "---\n---\nx")]
    df = spark.createDataFrame(rows, "k int, t string")
    got = {r["k"]: r["o"] for r in df.select("k", match.with_content_hash(F.col("t")).alias("o")).collect()}
    assert got == {1: whole, 2: None, 3: whole, 4: None, 5: None, 6: f"---\ngrantha_hash: {sha('')}\n---\nx"}
    assert [r["o"] for r in df.where("k = 1").select(match.with_content_hash(F.col("t"), n_different=F.lit(6), most=5).alias("o")).collect()] == [None]
    assert df.select(match.content_hash(F.col("t"), script.LATIN).alias("h")).where("h IS NOT NULL").count() == 4
