"""Whole conversions by a stand-in model."""

import sys

from pyspark import cloudpickle

from scriptorium.functions import script
from scriptorium.plans import model

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks cannot import tests


class Echo:
    """Answers with what follows the instruction, fenced; spoils some words; fails where told."""

    def generate(self, prompt):
        text = prompt.split("\n\n", 1)[1]
        if "fail here" in text:
            raise RuntimeError("no")
        if "silence" in text:
            return ""
        return "```markdown\n" + text.replace("alpha beta", "alpha bexta").replace("entirely other", "words of quite another kind here") + "\n```"


def test_convert_documents(spark):
    many = " ".join(f"word{chr(97 + k % 26)}" for k in range(60))
    rows = [(1, f"{many} alpha beta. {many} end."), (2, f"first part. fail here"), (3, "entirely other"), (4, many), (5, "silence")]
    plan = [(0, "", ". "), (1, "", "never")]
    plans = spark.createDataFrame([(1, plan), (2, plan), (4, [])], "doc_id long, plan array<struct<chunk_id:int,start_marker:string,end_marker:string>>")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = model.convert_documents(docs, plans, Echo(), "Convert.", chars=script.LATIN, word_chars="A-Za-zÀ-ÿ", first_delay=0.0)
    got = {r["doc_id"]: (r["status"], r["n_chunks"], r["body"]) for r in out.collect()}
    assert got[1] == ("ok", 2, f"{many} alpha beta.\n\n{many} end.")
    assert got[2][0] == got[3][0] == got[5][0] == "failed" and got[2][2] is None
    assert got[4] == ("ok", 1, many)


class Reader:
    def generate(self, prompt):
        path, pages = prompt.split("\n")[1].split(" ")
        if path == "bad.pdf" and pages == "4-8":
            raise RuntimeError("unreadable")
        return f"```markdown\npages {pages} of {path}\n```"


def test_read_pages(spark):
    files = spark.createDataFrame([("a.pdf", 9), ("bad.pdf", 8), ("none.pdf", 0)], "path string, n_pages int")
    got = {r["path"]: (r["body"], r["n_chunks"]) for r in model.read_pages(files, Reader(), "Read.", 4, 4, first_delay=0.0).collect()}
    assert got == {"a.pdf": ("pages 0-4 of a.pdf\n\npages 4-8 of a.pdf\n\npages 8-9 of a.pdf", 3)}
