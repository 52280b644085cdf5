"""Cleaning of all documents, with number signs and bold marks in them, against plain Python."""

import re

from scriptorium.plans import queries


def test_all_documents(spark, tmp_path):
    texts = ["plain", "a # b", "top\n# A heading\nbody", "##  two\nleft", "#tag stays\n#\tgoes", "**bold** and ** more", "x <!-- # in\n## comment --> y", "---\nnot a header\n---\nz", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def cleaned(t):
        t = f"---\nid: x\n---\n# Heading 1\n**{t}** <!-- note\nmore -->\n".strip().split("---", 2)[2]
        t = re.sub(r"^#+\s+.*$", "", t, flags=re.M)
        return re.sub(r"\s+", " ", re.sub(r"<!--.*?-->", " ", t, flags=re.S).replace("**", "")).strip()

    got = {r["doc_id"]: r["text"] for r in queries.q26_cleaned(spark, str(tmp_path)).collect()}
    assert got == {k: t if t is None else cleaned(t) for k, t in enumerate(texts)}
