"""Scalar functions on literal cases."""

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import markup, refs, script
from scriptorium.sources.documents import part_number


def one(spark, column, **values):
    cells = ", ".join(f"{k} string" for k in values)
    df = spark.createDataFrame([tuple(values.values())], cells) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("अग्निमीळे English पुरोहितं", "अग्निमीळे पुरोहितं"),
        ("अग्निमीळे। पुरोहितं॥ यज्ञस्य।", "अग्निमीळे। पुरोहितं॥ यज्ञस्य।"),
        ("", ""),
        ("none here", ""),
        ("ࣿऀxॿঀ", "ऀ ॿ"),
    ],
)
def test_script_text(spark, text, want):
    assert one(spark, script.script_text(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("॥ १ ॥", 1), ("॥१॥", 1), ("॥ 5 ॥", 5), ("॥ १८ ॥", 18), ("none", None), (None, None)])
def test_verse_number(spark, text, want):
    assert one(spark, script.verse_number(F.col("t")), t=text) == want


def test_normalised_and_stats(spark):
    assert one(spark, script.normalised(F.col("t")), t="क ख‌।॥१२\nग") == "कखग"
    s = one(spark, script.text_stats(F.col("t")), t="क ख क १")
    assert (s["total"], s["distinct"], s["characters"]) == (3, 2, ["क", "ख"])
    assert one(spark, script.single_dandas(F.col("t")), t="क॥") == "क।।"
    assert one(spark, script.whitespace_only(F.col("t")), t="  \n") is True


def test_romanised():
    assert script.romanise("अग्निमीळे पुरोहितं") == "agnimILe purohitaM"
    assert script.romanise("कर्म॥ १") == "karma|| 1"
    assert script.romanise(None) is None


DOC = "---\nid: a\n---\n# मन्त्रः 1\n**अग्नि****मीळे** <!-- x\ny --> पुरोहितं\n"


def test_cleaned(spark):
    assert one(spark, markup.cleaned(F.col("t")), t=DOC) == "अग्निमीळे पुरोहितं"
    assert one(spark, markup.cleaned(F.col("t"), skip_headings=False), t=DOC) == "# मन्त्रः 1 अग्निमीळे पुरोहितं"


def test_headers(spark):
    f = one(spark, markup.frontmatter(F.col("t")), t="---\na: 1\n---\n\nbody\n")
    assert (f["header"], f["body"]) == ("a: 1", "body")
    f = one(spark, markup.frontmatter(F.col("t")), t="no header")
    assert (f["header"], f["body"]) == (None, None)
    f = one(spark, markup.lenient_frontmatter(F.col("t")), t="no header")
    assert (f["header"], f["body"]) == (None, "no header")
    assert one(spark, markup.third_part(F.col("t")), t="---a---b---c") == "b---c"
    assert one(spark, markup.header_value(F.col("t"), "grantha_id"), t="x: 1\ngrantha_id: 'isa'\n") == "isa"
    t = one(spark, markup.toml_header(F.col("t")), t='+++\ntitle = "A = b"\nnoise\ntitle = \'C\'\n+++\nbody')
    assert (t["header"], t["body"]) == ({"title": "C"}, "body")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("[simple]", "<!-- hide -->[simple]<!-- /hide -->"),
        ("[link](url)", "[link](url)"),
        ("<!-- hide -->[x]<!-- /hide --> [y]", "<!-- hide -->[x]<!-- /hide --> <!-- hide -->[y]<!-- /hide -->"),
        ("\\[x]", "<!-- hide -->\\[x]<!-- /hide -->"),
    ],
)
def test_hide_notes(spark, text, want):
    assert one(spark, markup.hide_notes(F.col("t")), t=text) == want
    assert one(spark, markup.hide_notes(F.col("t")), t=want) == want


def test_tags_noise(spark):
    assert one(spark, markup.without_tags(F.col("t")), t="<p>Line 1</p>\n\n\n\nLine 2 ") == "Line 1\n\nLine 2"
    assert one(spark, markup.without_noise(F.col("t")), t="****x**** ** y ** ।।१।।") == "**x** **y** ।। १ ।।"
    assert one(spark, markup.without_bold(F.col("t")), t="**a**") == "a"


def test_fences(spark):
    text = "```json\n{}\n```"
    for f in (markup.fenced_lines, markup.outer_fence, markup.first_last_fence):
        assert one(spark, f(F.col("t")), t=text) == "{}"
    assert one(spark, markup.markdown_fence(F.col("t")), t="```md\n# a\n```") == "# a"
    assert one(spark, markup.markdown_fence(F.col("t")), t=text) == text
    assert one(spark, markup.fenced_lines(F.col("t")), t="a\n```\nb") == "a\n```\nb"


@pytest.mark.parametrize(
    ("text", "status"),
    [('```json\n{"a": 1}\n```', "ok"), ('{"a": 1}', "ok"), ('{"regex": "\\d+", "b": 2}', "repaired"), ("", "error"), ("{", "error")],
)
def test_parsed_json(spark, text, status):
    assert one(spark, markup.parsed_json(F.col("t"))["status"], t=text) == status
    assert one(spark, markup.json_block(F.col("t")), t="x\n```json\n[1]\n```\ny") == "[1]"
    assert one(spark, markup.json_braces(F.col("t")), t="x {a {b}} y") == "{a {b}}"


def test_sampled(spark):
    s = one(spark, markup.sampled(F.col("t"), 10, 2, 2, 2, "|"), t="0123456789ab")
    assert (s["text"], s["sampled"]) == ("01|56|ab", True)
    s = one(spark, markup.sampled(F.col("t"), 10, 2, 2, 2), t="0123456789")
    assert (s["text"], s["sampled"]) == ("0123456789", False)
    for sizes in ((10, -1, 2, 2), (10, 5, 5, 5)):
        with pytest.raises(ValueError, match="sizes"):
            markup.sampled(F.lit("x"), *sizes)


def test_script_blocks(spark):
    both = "<!-- sanskrit:devanagari -->\nक\n<!-- /sanskrit:devanagari -->\n<!-- sanskrit:roman -->ka<!-- /sanskrit:roman -->"
    assert one(spark, markup.script_blocks(F.col("t")), t=both) == {"devanagari": "क", "roman": "ka"}
    assert one(spark, markup.script_blocks(F.col("t")), t="<!-- sanskrit:devanagari -->\nक ख") == {"devanagari": "क ख"}
    assert one(spark, markup.script_blocks(F.col("t")), t="<!-- hide -->x<!-- /hide --> क") == {"devanagari": "x क"}


def test_prompt(spark):
    assert one(spark, markup.prompt(F.lit("a {x} {x} {y}"), F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2")))) == "a 1 1 2"
    assert one(spark, markup.prompt(F.lit("a {z}"), F.create_map(F.lit("x"), F.lit("1")))) is None


def test_refs(spark):
    assert one(spark, refs.ref_key(F.lit("1.2.3"))) == [1, 2, 3]
    assert one(spark, refs.ref_key(F.lit("1.a"))) is None
    assert one(spark, refs.ref_key(F.lit(""))) is None
    assert one(spark, refs.compare_refs(F.lit("1.10"), F.lit("1.2"))) == 1
    assert one(spark, refs.compare_refs(F.lit("1.2"), F.lit("1.2.1"))) == -1
    r = one(spark, refs.ref_range(F.lit("1.1.1-5")))
    assert (r["start"], r["end"]) == ("1.1.1", "5")
    assert one(spark, refs.ref_range(F.lit("1-2-3"))) is None
    assert one(spark, refs.expanded(F.lit("1.1.2-4"))) == ["1.1.2", "1.1.3", "1.1.4"]
    assert one(spark, refs.expanded(F.lit("3.1"))) == ["3.1"]
    assert one(spark, refs.expanded(F.lit("1.a-b"))) is None
    assert one(spark, refs.in_range(F.lit("1.10"), F.lit("1.2"), F.lit("2.1"))) is True
    assert one(spark, refs.ancestors(F.lit("1.2.3"))) == [[1], [1, 2], [1, 2, 3]]


@pytest.mark.parametrize(
    ("name", "want"),
    [("01-02.md", 2), ("part-3.md", 3), ("part4.md", 4), ("x-prathama.md", 1), ("x-dvitIyA-valla.md", 2), ("brihadaranyaka-03.md", 3), ("05.md", 5), ("isa.md", 1)],
)
def test_part_number(spark, name, want):
    assert one(spark, part_number(F.col("t")), t=name) == want


def test_content_text(spark):
    content = F.create_map(F.lit("roman"), F.lit("ka"), F.lit("devanagari"), F.lit("क"))
    assert one(spark, script.content_text(content, F.lit("e"), F.lit(None))) == "कkae"
    assert one(spark, script.content_text(content, F.lit(None), F.lit("f"), ("roman",))) == "kaf"
