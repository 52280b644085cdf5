"""Operators on literal cases: matches by string identifiers, tidied differences, places, schemas, schemes, reports."""

import time

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.operators import align, link, render, rules, segment
from scriptorium.sources import documents as sources


def test_best_match_by_name(spark):
    left = spark.createDataFrame([("d", "a.md", "one two three"), ("d", "b.md", "four five")], "dir string, id string, text string")
    right = spark.createDataFrame([("d", "z.txt", "four fine"), ("d", "c.md", "one two three!"), ("d", "d.md", "one two three!"), ("e", "y.md", "four five")], "dir string, id string, text string")
    got = {r["left_id"]: r["right_id"] for r in link.best_match(left, right, ["dir"]).collect()}
    assert got == {"a.md": "c.md", "b.md": "z.txt"}


def test_tidied():
    def op(name, before, after, position):
        return {"op": name, "before": before, "after": after, "position": position}

    ops = [op("replace", "cat", "dog", 0), op("equal", "s", "s", 3), op("replace", "run", "walk", 4), op("equal", " along the road", " along the road", 7), op("insert", "", "!", 22)]
    assert align.tidied(ops) == [op("replace", "catsrun", "dogswalk", 0), ops[3], ops[4]]
    assert align.tidied([ops[3]]) == [ops[3]] and align.tidied([]) == []
    long = [op("delete", "ab", "", 0), op("equal", "xyz", "xyz", 2), op("insert", "", "cdef", 5)]
    assert align.tidied(long) == long
    for a, b in (("The quick brown fox", "The slick brawn fix"), ("", "abc"), ("same", "same")):
        found = align.tidied(align.opcodes(a, b))
        assert "".join(x["before"] for x in found) == a and "".join(x["after"] for x in found) == b


def test_places(spark):
    rows = [("abc", "abd"), ("abc", "abc"), ("ab", "abc"), ("", "x"), ("é" * 50_000 + "a", "é" * 50_000 + "b"), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    start = time.time()
    assert [r[0] for r in df.select(align.first_difference(F.col("a"), F.col("b"))).collect()] == [3, None, 3, 1, 50_001, None]
    text = " a\nb  c" + " d" * 20_000
    df = spark.createDataFrame([(text, k) for k in (1, 2, 3, 20_003, 20_004, 0)], "t string, k int")
    at = align.original_index(F.col("t"), "\\s", F.col("k"))
    got = [tuple(r) for r in df.select(at, align.line_at(F.col("t"), at), align.context_at(F.col("t"), at, 2)).collect()]
    assert got[:3] == [(2, 1, " a\nb"), (4, 2, "a\nb  "), (7, 2, "  c d")]
    assert got[3][0] == len(text) and got[4] == got[5] == (None, None, None)
    assert time.time() - start < 60


SCHEMA = {
    "type": "object",
    "required": ["a", "b"],
    "additionalProperties": False,
    "properties": {
        "a": {"type": "string", "minLength": 2, "pattern": "^x"},
        "b": {"type": "array", "minItems": 1, "items": {"anyOf": [{"type": "integer", "maximum": 3}, {"const": "z"}]}},
        "c": {"oneOf": [{"type": "number"}, {"type": "integer"}]},
        "d": {"allOf": [{"$ref": "#/definitions/e"}]},
    },
    "definitions": {"e": {"enum": [1, None]}},
}


def test_schema_errors(spark):
    assert rules.schema_errors({"a": "xy", "b": [1, "z"], "c": 0.5, "d": None}, SCHEMA) == []
    assert rules.schema_errors([], SCHEMA) == ["root: [] is not of type object"]
    assert rules.schema_errors({"a": "y", "b": [], "c": 1, "d": 2, "f": 0}, SCHEMA) == [
        'a: "y" does not match ^x', 'a: "y" is too short', "b: [] has too few items", "c: 1 fits not one of the given schemas", "d: 2 is not one of [1, null]", "root: 'f' is not allowed",
    ]
    assert rules.schema_errors({"a": "xy", "b": [4]}, SCHEMA) == ["b.0: 4 fits none of the given schemas"]
    assert rules.schema_errors(True, {"type": "integer"}) == ["root: true is not of type integer"]
    df = spark.createDataFrame([('{"b": [1]}',), ("no json",), (None,)], "t string")
    assert [r[0] for r in df.select(rules.against_schema(F.col("t"), SCHEMA)).collect()] == [["root: 'a' is a required property"], ["root: not valid JSON"], None]


@pytest.mark.parametrize(("scheme", "want"), [("HK", "zrIkRSNaH"), ("IAST", "śrīkṛṣṇaḥ"), ("ITRANS", "shrIkRRiShNaH")])
def test_schemes(scheme, want):
    text = "श्रीकृष्णः"
    assert script.romanise(text, scheme) == want


def test_feminine_ordinals(spark):
    df = spark.createDataFrame([(1, "x\n**द्वितीया वल्ली**\n**पञ्चमी** **वल्ली**")], "doc_id long, text string")
    got = [(r["type"], r["line_number"], r["marker_text"]) for r in segment.boundaries(df).orderBy("line_number").collect()]
    assert got == [("valli", 2, "**द्वितीया वल्ली**"), ("valli", 3, "**पञ्चमी** **वल्ली**")]


def test_report(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "x")], "n int, t string")
    assert [r["line"] for r in sources.report_lines(df, "Report", ["n", "t"]).collect()] == ["# Report", "| n | t |", "| 1 | x |", "| 2 | - |"]
    sources.write_report(df, f"{tmp_path}/out", "Report", ["n", "t"])
    assert spark.read.text(f"{tmp_path}/out").count() == 4


def test_nested_body(spark):
    schema = "doc_id int, passage_type string, ref string, label map<string,string>, content map<string,string>, seq int"
    rows = [
        (1, "main", "1.10", None, {"devanagari": "ten"}, 2), (1, "main", "1.2", None, {"devanagari": "two", "roman": "ii", "kannada": ""}, 1), (1, "main", "2", None, {"devanagari": "too high"}, 3),
        (1, "prefatory", "0.1", {"devanagari": "P"}, {"devanagari": "peace"}, 0), (1, "concluding", "9", None, {"devanagari": "end"}, 0),
    ]
    notes = spark.createDataFrame([(1, "1.2", "c", {"devanagari": "note"}, 0), (1, "7.7", "c", {"devanagari": "lost"}, 0)], "doc_id int, ref string, commentary_id string, content map<string,string>, ord int")
    block = lambda t, s="devanagari": f"<!-- sanskrit:{s} -->\n\n{t}\n\n<!-- /sanskrit:{s} -->"
    want = [
        '# Prefatory: 0.1 (devanagari: "P")', block("peace"), "", "# Part 1", "", "## Verse 1.2", "", block("two"), block("ii", "roman"), "",
        '<!-- commentary: {"commentary_id": "c"} -->', "", "### Commentary: 1.2", "", block("note"), '<!-- /commentary: {"commentary_id": "c"} -->', "",
        "## Verse 1.10", "", block("ten"), "", "# Part 2", "", '# Concluding: 9 (devanagari: "")', block("end"), "",
    ]
    got = render.nested_body(spark.createDataFrame(rows, schema), notes, ["Part", "Verse"]).collect()
    assert [tuple(r) for r in got] == [(1, "\n".join(want))]
