"""JSON works with commentaries, read, written and verified; and schemas across files."""

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import rules, schemas
from scriptorium.sources import documents, works

DEVA = re.compile("[ऀ-ॿ]+")


def content(*texts, english=None, bare=False):
    found = {s: t for s, t in zip(("devanagari", "roman", "kannada"), texts) if t is not None}
    return found if bare else {"sanskrit": found, **({"english_translation": english} if english else {})}


FIRST = {
    "grantha_id": "first", "canonical_title": "एक", "text_type": "upanishad", "language": "sanskrit", "structure_levels": [{"key": "M", "scriptNames": {"devanagari": "मन्त्र"}}],
    "prefatory_material": [{"ref": "0", "passage_type": "prefatory", "label": {"devanagari": "शान्तिः"}, "content": content("आदौ", "ādau")}],
    "passages": [{"ref": str(k), "passage_type": "main", "content": content(f"मन्त्र {k} वाक्य", f"mantra {k}", english=f"verse {k}" if k % 2 else None)} for k in range(1, 13)],
    "commentaries": [
        {"commentary_id": "b", "commentary_title": "Bhāṣya", "commentator": {"devanagari": "शङ्कर", "latin": "S"}, "passages": [
            {"ref": "2", "prefatory_material": [{"type": "intro", "label": "l", "content": {"sanskrit": {"devanagari": "पूर्व"}, "english": "before"}}, {"type": "x", "content": {"english": "y"}}], "content": {"sanskrit": {"devanagari": "भाष्य द्वे", "roman": None}}},
            {"ref": "1", "content": {"sanskrit": {"devanagari": "भाष्य एक"}, "english": "one"}}]},
        {"commentary_id": "a", "commentary_title": "Ṭīkā \"q\"", "commentator": {"devanagari": "र"}, "passages": [{"ref": "1-3", "content": {"sanskrit": {"devanagari": "टीका"}}}]},
        {"commentary_id": "none", "passages": []},
    ],
}
SECOND = {
    "grantha_id": "second", "canonical_title": {"devanagari": "द्वे"}, "text_type": "upanishad", "language": "sanskrit", "structure": {"levels": []},
    "passages": [{"ref": "1", "passage_type": "main", "content": content("सर्वे", bare=True)}],
    "concluding_material": [{"ref": "9", "passage_type": "concluding", "label": {"devanagari": "इति"}, "content": content("अन्ते")}],
    "commentaries": {"k": {"commentary_id": "other", "commentary_title": "K", "commentator": {"devanagari": "क"}, "passages": [{"ref": "1", "content": {"sanskrit": {"devanagari": "कथा"}}}]}},
}
THIRD = {"grantha_id": "third", "canonical_title": "त्रि", "text_type": "upanishad", "language": "sanskrit", "structure_levels": [], "passages": []}


def hash_of(work, scripts, chosen):
    def text(c, all_scripts):
        s = c.get("sanskrit", c)
        return "".join(s.get(k) or "" for k in ("devanagari", "roman", "kannada") if all_scripts is None or k in all_scripts) + (c.get("english_translation") or c.get("english") or "")

    out = [text(p["content"], scripts) for sec in ("prefatory_material", "passages", "concluding_material") for p in work.get(sec, [])]
    notes = work.get("commentaries", [])
    for cid, c in [(c["commentary_id"], c) for c in notes] if isinstance(notes, list) else notes.items():
        if chosen and cid in chosen:
            for p in c.get("passages", []):
                out += [text(x["content"], scripts) for x in p.get("prefatory_material", [])] + [text(p["content"], scripts)]
    return hashlib.sha256(" ".join(DEVA.findall("".join(out))).encode()).hexdigest()


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("works")
    for k, w in enumerate((FIRST, SECOND, THIRD)):
        (folder / f"w{k}.json").write_text(json.dumps(w, ensure_ascii=False, indent=1), encoding="utf-8")
    return documents.read_works(spark, str(folder)).cache()


def rows(df):
    return sorted(json.dumps(r.asDict(True), ensure_ascii=False, sort_keys=True, default=str) for r in df.collect())


def test_commentary_passages(read):
    got = {(r["grantha_id"], r["commentary_id"], r["seq"]): r for r in works.commentary_passages(read).collect()}
    assert set(got) == {("first", "b", 0), ("first", "b", 1), ("first", "a", 0), ("second", "k", 0)}
    b = got["first", "b", 0]
    assert b["ref"] == "2" and b["content"] == {"devanagari": "भाष्य द्वे"} and b["title"] == "Bhāṣya" and b["commentator"] == {"devanagari": "शङ्कर", "latin": "S"}
    assert [(x["type"], x["label"], x["content"], x["english"]) for x in b["before"]] == [("intro", "l", {"devanagari": "पूर्व"}, "before"), ("x", None, {}, "y")] or b["before"][1]["content"] in ({}, None)
    assert got["first", "b", 1]["english"] == "one" and got["first", "b", 1]["before"] == []
    assert {r["commentary_id"] for r in works.commentary_passages(read, chosen=["a", "zz"]).collect()} == {"a"}


@pytest.mark.parametrize("as_map", [False, True])
def test_read_write_read(spark, read, as_map):
    own, notes = documents.work_passages(read), works.commentary_passages(read)
    header = read.select("grantha_id", "canonical_title", "text_type")
    written = works.whole_works(header, own, notes, as_map=as_map)
    found = {r["grantha_id"]: json.loads(r["json"]) for r in written.collect()}
    assert set(found) == {"first", "second", "third"} and found["third"]["passages"] == [] and "commentaries" not in found["third"]
    assert "concluding_material" not in found["first"] and found["first"]["passages"][0]["content"] == FIRST["passages"][0]["content"]
    assert list(found["first"]["commentaries"]) == (["b", "a"] if as_map else found["first"]["commentaries"])
    again = spark.read.schema(documents.WORK).json(written.select("json").rdd.map(lambda r: r[0]))
    assert rows(documents.work_passages(again)) == rows(own)
    assert rows(works.commentary_passages(again)) == rows(notes)


def test_chosen_scripts_and_commentaries(read):
    made = works.whole_works(read.select("grantha_id"), documents.work_passages(read), works.commentary_passages(read), scripts=("roman",), chosen=["a"])
    first = json.loads({r["grantha_id"]: r["json"] for r in made.collect()}["first"])
    assert [c["commentary_id"] for c in first["commentaries"]] == ["a"] and first["commentaries"][0]["passages"][0]["content"] == {"sanskrit": {}}
    assert first["passages"][1]["content"] == {"sanskrit": {"roman": "mantra 2"}}


@pytest.mark.parametrize("scripts,chosen", [(["devanagari"], None), (["devanagari", "roman"], ["a", "b"]), (None, ["k"]), (["devanagari"], ["b"]), ([], [])])
def test_verified(spark, read, scripts, chosen):
    ids = {"first": FIRST, "second": SECOND, "third": THIRD}
    data = [(i, scripts, chosen, "sha256:" + hash_of(w, scripts, chosen)) for i, w in ids.items()] + [("absent", scripts, chosen, "00")]
    headers = spark.createDataFrame(data, "grantha_id string, scripts array<string>, commentaries array<string>, validation_hash string")
    assert {r["grantha_id"]: r["same"] for r in works.verified(read, headers).collect()} == {"first": True, "second": True, "third": True, "absent": False}
    altered = read.withColumn("commentaries", F.replace("commentaries", F.lit("भाष्य एक"), F.lit("भाष्य त्रि")))
    named = chosen is not None and "b" in chosen
    assert {r["grantha_id"]: r["same"] for r in works.verified(altered, headers).collect()}["first"] == (not named)
    assert not any(r["same"] for r in works.verified(read, headers.withColumn("validation_hash", F.lit(None).cast("string"))).collect())


def test_header_choice(spark):
    df = spark.createDataFrame([('{"scripts": ["roman"], "commentaries": ["x"], "validation_hash": "sha256:1"}',), ("{}",)], "h string").select(works.header_choice(F.col("h")).alias("c"))
    assert [r["c"].asDict() for r in df.collect()] == [{"scripts": ["roman"], "commentaries": ["x"], "validation_hash": "sha256:1"}, {"scripts": ["devanagari"], "commentaries": None, "validation_hash": None}]


# --- schemas

PASSAGE = {
    "type": "object", "required": ["ref", "passage_type", "content"],
    "properties": {"ref": {"type": "string"}, "passage_type": {"enum": ["prefatory", "main", "concluding"]}, "label": {"type": "object"}, "content": {"type": "object"}, "when": {"type": "string", "format": "date"}},
    "if": {"properties": {"passage_type": {"enum": ["prefatory", "concluding"]}}}, "then": {"required": ["label"]},
}
LEVEL = {"type": "object", "required": ["key"], "properties": {"children": {"oneOf": [{"type": "array", "items": {"$ref": "#/definitions/level"}}, {"$ref": "#/definitions/level"}]}}}
WHOLE = {"$id": "https://example.org/s/whole.json", "definitions": {"passage": PASSAGE, "level": LEVEL, "a/b~c": {"type": "integer"}}, "properties": {"passages": {"type": "array", "items": {"$ref": "#/definitions/passage"}}, "levels": {"$ref": "#/definitions/level"}, "odd": {"$ref": "#/definitions/a~1b~0c"}}, "required": ["passages"]}
PART = {
    "type": "object", "required": ["part_num"], "unevaluatedProperties": False,
    "properties": {"part_num": {"type": "integer", "minimum": 1}, "passages": {"type": "array", "items": {"$ref": "whole.json#/definitions/passage"}}, "all": {"$ref": "whole.json"},
                   "commentaries": {"oneOf": [{"type": "object", "additionalProperties": {"$ref": "whole.json#/definitions/level"}}, {"type": "array"}]}},
}


def test_references_across_files_and_conditions():
    good = {"ref": "1", "passage_type": "main", "content": {}}
    check = lambda v: schemas.schema_errors(v, PART, {"whole.json": WHOLE})
    assert check({"part_num": 1, "passages": [good], "commentaries": {"c": {"key": "k"}}, "more": 1}) == []
    bad = {"ref": "0", "passage_type": "prefatory", "content": {}}
    assert check({"part_num": 1, "passages": [good, bad]}) == ["passages.1: 'label' is a required property"]
    assert check({"part_num": 1, "passages": [{**bad, "label": {}}]}) == []
    assert sorted(check({"part_num": 0, "all": {"passages": [{"ref": 1}]}})) == [
        "all.passages.0.ref: 1 is not of type string", "all.passages.0: 'content' is a required property", "all.passages.0: 'label' is a required property",
        "all.passages.0: 'passage_type' is a required property", "part_num: 0 is less than the minimum of 1",
    ]
    assert check({"part_num": 1, "commentaries": 3}) == ["commentaries: 3 fits not one of the given schemas"]
    children = [{"key": 2, "children": {"key": 3, "children": [{}]}}]
    assert schemas.schema_errors({"passages": [], "odd": "x", "levels": {"key": 1, "children": children}}, WHOLE) == [
        'odd: "x" is not of type integer', f"levels.children: {json.dumps(children)} fits not one of the given schemas",
    ]


def test_circles_and_missing_targets():
    deep = {"key": 1}
    for k in range(50):
        deep = {"key": k, "children": deep}
    assert schemas.schema_errors(deep, {"$ref": "#/definitions/level", "definitions": {"level": LEVEL}}) == []
    with pytest.raises(ValueError, match="unknown file"):
        schemas.Schema(PART)
    with pytest.raises(ValueError, match="not there"):
        schemas.Schema({"$ref": "#/definitions/no"})
    with pytest.raises(ValueError, match="circle"):
        schemas.Schema({"definitions": {"a": {"$ref": "#/definitions/b"}, "b": {"$ref": "#/definitions/a"}}, "$ref": "#/definitions/a"})


@pytest.mark.parametrize(
    "schema,good,bad",
    [
        ({"maxLength": 2, "minLength": 1}, ["a", "ab", 7], ["", "abc"]),
        ({"exclusiveMinimum": 1, "exclusiveMaximum": 3}, [2, 2.5, "x"], [1, 3, 0]),
        ({"multipleOf": 0.5}, [1, 1.5], [0.7]),
        ({"items": [{"type": "integer"}, {"type": "string"}], "additionalItems": False}, [[], [1], [1, "a"]], [["a"], [1, 2], [1, "a", 3]]),
        ({"items": [{"type": "integer"}], "additionalItems": {"type": "null"}}, [[1, None, None]], [[1, 2]]),
        ({"items": {"type": "integer"}, "uniqueItems": True, "maxItems": 2, "minItems": 1}, [[1], [1, 2]], [[], [1, 1], [1, 2, 3], ["a"]]),
        ({"contains": {"const": 1}}, [[0, 1], {}], [[], [True], [2]]),
        ({"patternProperties": {"^n_": {"type": "integer"}}, "additionalProperties": False, "properties": {"x": {}}}, [{"n_a": 1, "x": None}], [{"n_a": "s"}, {"y": 1}]),
        ({"propertyNames": {"maxLength": 2}, "minProperties": 1, "maxProperties": 2}, [{"ab": 1}], [{}, {"abc": 1}, {"a": 1, "b": 1, "c": 1}]),
        ({"dependencies": {"a": ["b"], "c": {"required": ["d"]}}}, [{}, {"a": 1, "b": 1}, {"c": 1, "d": 1}], [{"a": 1}, {"c": 1}]),
        ({"not": {"type": "string"}}, [1], ["a"]),
        ({"if": {"const": 1}, "then": {"type": "string"}, "else": {"minimum": 5}}, [6, "x"], [1, 2]),
        ({"allOf": [{"minimum": 1}, {"maximum": 2}], "anyOf": [{"const": 1}, {"const": 2}]}, [1, 2], [0, 3, 1.5]),
        ({"properties": {"no": False, "yes": True}}, [{"yes": 1}, {}], [{"no": 1}]),
        ({"enum": [1, None, {"a": [1]}]}, [1, 1.0, None, {"a": [1]}], [True, {"a": [2]}, "1"]),
        (True, [1, None], []),
        (False, [], [1, None]),
    ],
)
def test_keywords(schema, good, bad):
    assert [v for v in good if schemas.schema_errors(v, schema)] == [] and [v for v in bad if not schemas.schema_errors(v, schema)] == []


def test_formats_are_checked_where_asked():
    schema = {"items": {"format": "date"}}
    assert schemas.schema_errors(["2024-02-31x"], schema) == []
    assert [m for _, _, m in schemas.Schema(schema, formats=True).breaches(["2024-12-31", "2024-13-01"])] == ['"2024-13-01" is not a date']


def test_schema_report(spark):
    good, bad = {"ref": "1", "passage_type": "main", "content": {}}, {"ref": "0", "passage_type": "concluding", "content": {}}
    docs = [(1, json.dumps({"part_num": 1, "passages": [good, bad, bad]})), (2, json.dumps({"part_num": 1, "passages": [bad]})), (3, "{"), (4, None), (5, json.dumps({"part_num": "x"}))]
    df = spark.createDataFrame(docs, "doc_id long, j string")
    got = {tuple(r) for r in schemas.schema_report(df, "j", PART, {"whole.json": WHOLE}).collect()}
    assert got == {("passages.*", "required", 3, 2, 1), ("root", "json", 1, 1, 3), ("part_num", "type", 1, 1, 5)}
    assert rules.against_schema is schemas.against_schema
