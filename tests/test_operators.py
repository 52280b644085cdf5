"""Operators on small tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import align, chunk, fingerprint, link, render, rollup, rules, segment
from scriptorium.plans import model
from scriptorium.sources import documents

BODY = """# Prefatory: 0.1 (devanagari: "शान्तिः")
<!-- sanskrit:devanagari -->
ॐ
<!-- /sanskrit:devanagari -->

# Valli 1
lost text
# Mantra 1.1
<!-- sanskrit:devanagari -->
अग्नि
# Mantra 1.2

text <!-- commentary: {"commentary_id": "c1"} -->
# Commentary: 1.1
टीका
# Commentary: 1.2
no metadata
<!-- commentary: {"commentary_id": "zz"} -->
# Commentary: 1.2
undeclared
<!-- commentary: {"commentary_id": "c1"} -->
# Commentary: 1.1-2
ranged
# Mantra 1.3
# Concluding: 1.2 (devanagari: "अन्त")
अन्तः"""


def parse(spark, strict=True):
    docs = spark.createDataFrame([(1, BODY)], "doc_id int, body string")
    levels = spark.createDataFrame([(1, "Valli", False), (1, "Mantra", True)], "doc_id int, level string, is_lowest boolean")
    declared = spark.createDataFrame([(1, "c1")], "doc_id int, commentary_id string")
    return segment.parse_structured(docs, levels, declared, strict_reference=strict)


def test_parse_structured(spark):
    passages, commentaries = parse(spark)
    got = [(r["passage_type"], r["ref"], r["content"]["devanagari"]) for r in passages.orderBy("block").collect()]
    assert got == [("prefatory", "0.1", "ॐ"), ("main", "1.1", "अग्नि"), ("main", "1.2", "text"), ("concluding", "1.2", "अन्तः")]
    assert passages.where("passage_type = 'prefatory'").first()["label"] == {"devanagari": "शान्तिः"}
    assert [(r["ref"], r["commentary_id"], r["content"]["devanagari"]) for r in commentaries.orderBy("block").collect()] == [("1.1", "c1", "टीका")]


def test_parse_ranged(spark):
    _, commentaries = parse(spark, strict=False)
    assert [r["ref"] for r in commentaries.orderBy("block").collect()] == ["1.1", "1.1-2"]


def test_details(spark):
    text = "x\n<details open><summary>मूलम्</summary>\nक ॥ १ ॥\n</details>\n<details><summary>टीका</summary>\nख\n</details>\n<details open><summary>मूलम्</summary>ग ॥ २ ॥</details>"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    blocks = segment.details_blocks(docs)
    assert [(r["idx"], r["summary"], r["is_open"], r["start_line"]) for r in blocks.orderBy("idx").collect()] == [(0, "मूलम्", True, 2), (1, "टीका", False, 5), (2, "मूलम्", True, 8)]
    is_text = (F.col("summary") == "मूलम्") & F.col("is_open")
    flagged = segment.with_prefatory(blocks, is_text)
    assert not [r for r in flagged.collect() if r["is_prefatory"]]
    pairs = segment.paired(flagged, is_text, F.col("summary") == "टीका").orderBy("idx").collect()
    assert [r["commentary"] for r in pairs] == ["ख", None]


def test_boundaries_and_chunks(spark):
    text = "intro\n**प्रथमः** **खण्डः**\naaa\n**खण्डः 2**\nbbb\n**वल्ली 1**\nccc"
    docs = spark.createDataFrame([(1, text), (2, "plain")], "doc_id int, text string")
    found = segment.boundaries(docs).orderBy("position").collect()
    assert [(r["type"], r["position"], r["line_number"], r["ordinal"]) for r in found] == [("khanda", 6, 2, "प्रथम"), ("khanda", text.index("**खण्डः 2"), 4, None), ("valli", text.index("**वल्ली"), 6, None)]
    got = chunk.boundary_chunks(docs, most=5).orderBy("doc_id", "chunk").collect()
    assert [r["content"] for r in got if r["doc_id"] == 1] == ["intro\n", "**प्रथमः** **खण्डः**\naaa", "**खण्डः 2**\nbbb\n**वल्ली 1**\nccc"]
    assert [r["content"] for r in got if r["doc_id"] == 2] == ["plain"]
    assert {r["doc_id"]: r["n_chunks"] for r in chunk.chunk_estimate(docs, most=10).collect()} == {1: 2, 2: 1}


@pytest.mark.parametrize(
    ("text", "markers", "want"),
    [
        ("aaENDbb ENDcc", ["END", "END"], ["aaEND", "bb END"]),
        ("a END b END c", ["END"], ["a END b END"]),
        ("abc", ["missing", "x"], ["abc"]),
        ("a.b.c", [".", ".", "zz"], ["a.", "b.", "c"]),
    ],
)
def test_plan_chunks(spark, text, markers, want):
    plan = F.array(*[F.struct(F.lit(k).alias("chunk_id"), F.lit("").alias("start_marker"), F.lit(m).alias("end_marker")) for k, m in enumerate(markers)])
    assert spark.createDataFrame([(text,)], "t string").select(chunk.plan_chunks(F.col("t"), plan).alias("c")).first()["c"] == want


def test_pages_and_merge(spark):
    files = spark.createDataFrame([("a", 5), ("b", 0)], "path string, n_pages int")
    ranges = chunk.page_ranges(files, 3, 2)
    assert [(r["first"], r["until"]) for r in ranges.orderBy("chunk").collect()] == [(0, 3), (2, 5), (4, 5)]
    assert chunk.all_present(ranges, ranges.where("chunk < 2")).count() == 0
    assert chunk.all_present(ranges, ranges).count() == 1
    parts = spark.createDataFrame([(1, 2, " b "), (1, 1, "a"), (1, 3, " "), (2, 1, "x"), (2, 3, "z")], "doc_id int, chunk int, content string")
    got = {r["doc_id"]: (r["body"], r["complete"]) for r in chunk.ordered_merge(parts).collect()}
    assert got == {1: ("a\n\nb", True), 2: ("x\n\nz", False)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fingerprints(spark):
    df = spark.createDataFrame([("ॐ   शान्तिः x",)], "t string")
    assert df.select(fingerprint.text_hash(F.col("t")).alias("h")).first()["h"] == sha("ॐ शान्तिः")
    rows = spark.createDataFrame([(1, 1, 2, "ख"), (1, 1, 1, "क"), (1, 0, 9, "अ"), (1, 2, 0, None)], "work_id int, section int, seq int, text string")
    assert fingerprint.work_hash(rows).first()["hash"] == sha("अकख")
    good = sha("क")
    cases = [("क", None, good, "version_missing"), ("क", 2, good, "version_mismatch"), ("क", 3, None, "hash_missing"), ("क", 3, "sha256:0", "hash_mismatch"), ("क", 3, f"sha256:{good}", "ok")]
    gate = spark.createDataFrame(cases, "b string, v int, h string, want string").select("want", fingerprint.hash_gate(F.col("b"), F.col("v"), F.col("h")).alias("got"))
    assert all(r["want"] == r["got"] for r in gate.collect())
    files = spark.createDataFrame([("d", "b", bytearray(b"2")), ("d", "a", bytearray(b"1"))], "dir string, path string, content binary")
    assert fingerprint.directory_hash(files).first()["hash"] == sha("a1b2")
    v = spark.createDataFrame([("1.3.0", True), ("2.3.0", False), ("1.1.9", False)], "v string, want boolean").select("want", fingerprint.version_compatible(F.col("v"), F.lit("1.2.0")).alias("got"))
    assert all(r["want"] == r["got"] for r in v.collect())


def test_links(spark):
    p = spark.createDataFrame([(1, "1.1"), (1, "1.2")], "doc_id int, ref string")
    c = spark.createDataFrame([(1, "1.1-3"), (1, "9.a-b")], "doc_id int, ref string")
    assert [r["member"] for r in link.uncovered(c, p).collect()] == ["1.3"]
    left = spark.createDataFrame([("d", "a.md", "abcd"), ("d", "b.md", "xyz")], "block string, id string, text string").withColumn("id", F.when(F.col("id") == "a.md", 1).otherwise(2))
    right = spark.createDataFrame([("d", 7, "abcx"), ("d", 8, "abcx"), ("e", 9, "abcd")], "block string, id int, text string")
    best = {r["left_id"]: (r["right_id"], r["score"]) for r in link.best_match(left, right, ["block"], least=50).collect()}
    assert best == {1: (7, 75.0)}
    parts = spark.createDataFrame([(1, "1.1", 1, "old"), (1, "1.1", 2, "new")], "work_id int, ref string, part_num int, text string")
    assert [r["text"] for r in link.routed(parts, ["work_id", "ref"]).collect()] == ["new"]
    a = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    b = spark.createDataFrame([("y",), ("x",)], "name string")
    assert [(r["n"], r["left_name"], r["right_name"]) for r in link.zipped(a, b).orderBy("n").collect()] == [(1, "a", "x"), (2, "b", "y")]
    gaps = link.reference_gaps(spark.createDataFrame([("u",), ("s",)], "id string"), spark.createDataFrame([("d",), ("s",)], "id string"), ["id"])
    assert {(r["id"], r["problem"]) for r in gaps.collect()} == {("u", "undeclared"), ("d", "unused")}
    points = spark.createDataFrame([(1, "3.1.2"), (1, "3.2"), (2, "3.1.2")], "doc_id int, ref string")
    ranges = spark.createDataFrame([(1, "3.1.1", "3.1.9")], "doc_id int, start string, end string")
    assert [r["ref"] for r in link.containing(points, ranges).collect()] == ["3.1.2"]


def test_alignment(spark):
    assert align.ratio("abcd", "abxd") == 75.0
    assert align.ratio("", "") == 100.0
    assert align.ratio("abc", "") == 0.0
    pairs = spark.createDataFrame([(1, "a b c", "a x c"), (2, "same", "same"), (3, "ab", "a  b")], "pair_id int, a string, b string")
    got = [(r["pair_id"], r["type"], r["whitespace_only"], r["before"], r["after"], r["position"]) for r in align.diff_records(pairs, "pair_id", "a", "b").orderBy("pair_id").collect()]
    assert got == [(1, "REPLACEMENT", False, "b", "x", 2), (3, "INSERTION", True, "", "  ", 1)]
    report = rollup.diff_report(pairs.select("pair_id", F.length("a").alias("n_chars"), F.length("b").alias("n_other")), align.diff_records(pairs, "pair_id", "a", "b"))
    assert rollup.diff_totals(report).first().asDict() == {"n_pairs": 3, "n_chars": 11, "n_space": 1, "n_text": 1, "n_perfect": 1}


SOURCE = "# heading क\nअग्निमीळे पुरोहितं यज्ञस्य देवम् ऋत्विजम् होतारं रत्नधातमम् अग्निः पूर्वेभिः ऋषिभिः"


@pytest.mark.parametrize(
    ("output", "message"),
    [
        (SOURCE, "identical"),
        (SOURCE.replace("पुरोहितं", "**पुरोहितः**"), "repaired"),
        (SOURCE.replace("यज्ञस्य ", ""), "repaired"),
        (SOURCE.replace("यज्ञस्य", "यज्ञस्य अधिकं"), "repaired"),
        (SOURCE.replace("# heading क", "# other ख <!-- ग -->"), "identical"),
        (SOURCE.replace("अग्निमीळे ", ""), "repaired"),
    ],
)
def test_word_repair(output, message):
    got = align.repair_words(SOURCE, output)
    assert (got["success"], got["message"]) == (True, message)
    assert [w for w, _, _ in align.positioned_words(got["text"])] == [w for w, _, _ in align.positioned_words(SOURCE)]
    assert got["text"].count("\n") == output.count("\n")


def test_word_repair_refuses():
    got = align.repair_words(SOURCE, "पूर्णतः भिन्नम्")
    assert not got["success"] and got["text"] == "पूर्णतः भिन्नम्"
    assert align.respaced("क  ख\nग", "क ख\nग") == "क  ख\nग"


def test_rollups(spark):
    parts = spark.createDataFrame([("w", 2, "h2"), ("w", 1, "h1"), ("v", 1, "g"), ("v", 3, "g"), ("v", 3, "g")], "work_id string, part_num int, header string")
    got = {r["work_id"]: (r["header"], r["files"], r["consecutive"]) for r in rollup.envelopes(parts).collect()}
    assert got["w"] == ("h1", ["part1.json", "part2.json"], True) and not got["v"][2]
    assert {(r["part_num"], r["problem"]) for r in rollup.part_problems(parts).where("work_id = 'v'").collect()} == {(2, "missing"), (3, "duplicate")}
    heads = spark.createDataFrame([("w", "a", {"x": "1", "y": "1"}), ("w", "b", {"x": "2"}), ("w", "c", {"x": "2"})], "work_id string, file string, header map<string,string>")
    profile = rollup.header_profile(heads)
    assert [(r["field"], r["value"], r["n"], r["deviating"]) for r in profile.collect()] == [("x", "2", 2, 1)]
    assert [(r["file"], r["value"]) for r in rollup.deviating_files(heads, profile).collect()] == [("a", "1")]
    changed = rollup.applied_changes(heads, spark.createDataFrame([("w", "a", "x", "2")], "work_id string, file string, field string, new string"), ["work_id", "file"])
    assert changed.where("file = 'a'").first()["header"] == {"x": "2", "y": "1"}
    files = spark.createDataFrame([("b", "s", 2), ("a", "t", 1)], "path string, sha256 string, size_bytes long")
    works = spark.createDataFrame([("w", "T", False, "z", 1), ("w", "E", True, "y", 2)], "work_id string, title string, is_envelope boolean, path string, n_commentaries int")
    m = rollup.manifest(files, works, "1.0.0", "2024-01-01").first()
    assert (m["n_files"], m["n_bytes"], m["n_works"], m["n_commentaries"], m["works"][0]["title"]) == (2, 3, 1, 2, "E")
    chunks = spark.createDataFrame([(1, 1, {"a": "1"}, [("c1", "t")]), (1, 2, {"a": "2"}, [("c1", "u"), ("c2", "v")])], "doc_id int, chunk int, header map<string,string>, commentaries array<struct<commentary_id:string,title:string>>")
    h = rollup.merged_headers(chunks).first()
    assert h["header"]["a"] == "1" and h["header"]["language"] == "sanskrit" and [c["title"] for c in h["commentaries"]] == ["t", "v"]


def test_line_grammar(spark):
    body = '# Mantra 1.1\n<!-- sanskrit:devanagari -->\nfree # text\n<!-- /sanskrit:roman -->\n# Mantra 1.1\nnoise\n<!-- commentary: {"x": 1} -->\n# Commentary: 1.1-2\n# Commentary: 1.1\n<!-- sanskrit:devanagari -->'
    got = {(r["line_num"], r["rule_id"]) for r in rules.line_grammar(spark.createDataFrame([(1, body)], "doc_id int, body string")).collect()}
    assert got == {(4, "mismatched_end"), (5, "duplicate_ref"), (6, "unrecognised"), (7, "bad_meta"), (8, "no_passage"), (9, "missing_meta"), (10, "unclosed_block")}


def test_header_rules(spark):
    schema = "doc_id int, header struct<grantha_id:string,part_num:int,canonical_title:string,text_type:string,language:string,structure_levels:array<struct<key:string,script_names:map<string,string>>>,hash_version:int,validation_hash:string>"
    rows = [(1, ("isa", 1, "T", "upanishad", "sanskrit", [("Mantra", {"devanagari": "म"})], 3, "h")), (2, ("Bad Id", 0, None, "novel", "sanskrit", [], None, None))]
    got = rules.violations(spark.createDataFrame(rows, schema), ["doc_id"], rules.header_rules())
    assert {r["rule_id"] for r in got.collect()} == {"id_pattern", "part_num", "required:canonical_title", "text_type", "levels_empty", "hash_version", "validation_hash"}
    assert got.where("doc_id = 1").count() == 0


def test_render_parse_identity(spark):
    passages = spark.createDataFrame(
        [(1, "prefatory", "0.1", {"devanagari": "शान्तिः"}, {"devanagari": "ॐ"}, 0), (1, "main", "1.1", None, {"devanagari": "क", "roman": "ka"}, 0), (1, "main", "1.2", None, {"devanagari": "ख"}, 1)],
        "doc_id int, passage_type string, ref string, label map<string,string>, content map<string,string>, seq int",
    )
    notes = spark.createDataFrame([(1, "1.1", "c1", {"devanagari": "टीका"}, 0), (1, "7.7", "c1", {"devanagari": "x"}, 0)], "doc_id int, ref string, commentary_id string, content map<string,string>, ord int")
    docs = render.rendered(render.document_fragments(passages, notes))
    levels = spark.createDataFrame([(1, "Mantra", True)], "doc_id int, level string, is_lowest boolean")
    back, comments = segment.parse_structured(docs, levels, spark.createDataFrame([(1, "c1")], "doc_id int, commentary_id string"))
    assert [(r["passage_type"], r["ref"], r["content"], r["label"]) for r in back.orderBy("block").collect()] == [(r["passage_type"], r["ref"], r["content"], r["label"]) for r in passages.collect()]
    assert [(r["ref"], r["content"]) for r in comments.collect()] == [("1.1", {"devanagari": "टीका"})]


def test_edits(spark):
    p = spark.createDataFrame([("1.1", "a"), ("1.2", "b")], "ref string, text string")
    e = spark.createDataFrame([("1.2", "B", 0), ("1.3", "c", 0), ("1.3", "C", 1)], "ref string, text string, version int")
    assert {(r["ref"], r["text"]) for r in render.upsert(p, e, ["ref"]).collect()} == {("1.1", "a"), ("1.2", "B"), ("1.3", "C")}
    assert render.removed(p, spark.createDataFrame([("1.1",), ("9",)], "ref string"), ["ref"]).count() == 1
    assert [r["ref"] for r in render.updates_without_target(p, e, ["ref"]).distinct().collect()] == ["1.3", "1.3"]
    works = spark.createDataFrame([("w", "T")], "work_id string, canonical_title string")
    rows = spark.createDataFrame([("w", "main", 0, "1", {"devanagari": "क", "roman": "ka"})], "work_id string, passage_type string, seq int, ref string, content map<string,string>")
    assert render.work_json(works, rows, scripts=("roman",)).first()["json"] == '{"canonical_title":"T","passages":[{"ref":"1","content":{"roman":"ka"}}]}'


@pytest.mark.parametrize(("age", "state"), [(1, "fresh"), (45.99, "fresh"), (46, "validate"), (47.9, "validate"), (48, "expired"), (None, "expired")])
def test_cache_state(spark, age, state):
    then = F.lit(None).cast("timestamp") if age is None else F.timestamp_micros(F.lit(int(1.7e15 - age * 3.6e9)))
    assert spark.range(1).select(model.cache_state(F.timestamp_micros(F.lit(int(1.7e15))), then).alias("s")).first()["s"] == state


def test_retry():
    delays, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert model.with_retry(flaky, sleep=delays.append) == "ok" and delays == [2.0, 4.0]
    with pytest.raises(ZeroDivisionError):
        model.with_retry(lambda: 1 / 0, sleep=delays.append)


def test_conversion(spark):
    chunks = spark.createDataFrame([(1, 1, "क"), (1, 2, "ख"), (2, 1, "ग"), (3, 1, "घ")], "doc_id int, chunk int, content string")
    answers = spark.createDataFrame([(1, 2, "```\n**ख**\n```"), (1, 1, "# क"), (2, 1, "altered")], "doc_id int, chunk int, response string")
    got = {r["doc_id"]: (r["status"], r["body"]) for r in model.converted(chunks, answers).collect()}
    assert got == {1: ("ok", "# क\n\n**ख**"), 2: ("failed", None), 3: ("failed", None)}
    out = model.generated(spark.createDataFrame([(1, "x")], "doc_id int, prompt string"), model.NoClient(), ["doc_id"], attempts=1).first()
    assert out["response"] is None and out["error"].startswith("RuntimeError")


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    header = "---\ngrantha_id: isa\nstructure_levels:\n- key: Valli\n  children:\n  - key: Khanda\n  - key: Mantra\ncommentaries_metadata:\n  c1:\n    title: x\n---\n# Mantra 1\nक\n"
    (tmp_path / "a" / "isa-02.md").write_text(header)
    (tmp_path / "a" / "isa-01.md").write_text("no header")
    (tmp_path / "a" / "skip.txt").write_text("x")
    texts = documents.read_texts(spark, str(tmp_path))
    assert texts.count() == 2
    docs = documents.structured_documents(texts).where("body IS NOT NULL").first()
    assert [x["key"] for x in docs["levels"] if x["is_lowest"]] == ["Mantra"] and docs["commentaries"][0]["commentary_id"] == "c1"
    target = documents.directory_targets(texts).first()
    assert target["multipart"] and [f.rsplit("/", 1)[1] for f in target["files"]] == ["isa-01.md", "isa-02.md"]
    (tmp_path / "w.json").write_text('{"grantha_id": "isa", "canonical_title": {"devanagari": "ईश"}, "structure": {"levels": [{"key": "Mantra"}]}, "passages": [{"ref": "1", "passage_type": "main", "content": {"sanskrit": {"devanagari": "क"}, "english_translation": "k"}}], "concluding_material": [{"ref": "2", "content": {"roman": "kha"}}]}')
    works = documents.read_works(spark, str(tmp_path))
    assert works.first()["canonical_title"] == "ईश" and "Mantra" in works.first()["structure_levels"]
    rows = documents.work_passages(works).orderBy("section").collect()
    assert [(r["ref"], r["content"], r["english"]) for r in rows] == [("1", {"devanagari": "क"}, "k"), ("2", {"roman": "kha"}, None)]


def test_stream(spark, tmp_path):
    from scriptorium.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("---\nx: 1\n---\nक")
    seen = []
    q = ingest.upserted(ingest.fingerprinted(ingest.document_stream(spark, str(tmp_path / "in"))), str(tmp_path / "ck"), lambda df, n: seen.extend(r["hash"] for r in df.collect()))
    q.awaitTermination(60)
    assert seen == [sha("क")]


def test_commentary_edits(spark):
    c = spark.createDataFrame([(1, "c1", "1.1", 1, "a"), (1, "c1", "1.1", 5, "b"), (1, "c2", "1.1", 2, "c")], "doc_id int, commentary_id string, ref string, block int, text string")
    assert [r["text"] for r in link.commentary_at(c, "c1", "1.1").collect()] == ["b"]
    names = spark.createDataFrame([(1, ["c1", "c2"], ["n1", "c2"])], "doc_id int, old array<string>, new array<string>")
    assert sorted(r["commentary_id"] for r in link.renamed_commentaries(c, names).collect()) == ["c2", "n1", "n1"]
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id int, hash string")
    b = spark.createDataFrame([(1, "x"), (2, "q")], "doc_id int, hash string")
    assert {r["doc_id"]: r["same"] for r in link.round_trip(a, b).collect()} == {1: True, 2: False, 3: False}


def test_transliterated_and_positions(spark):
    from scriptorium.functions import script

    df = spark.createDataFrame([("कर्म x\n# गृह\nयोगः",)], "t string")
    assert df.select(script.transliterated("t").alias("x")).first()["x"] == "karma x\n# gRha\nyogaH"
    found = df.select(align.words_with_positions()("t").alias("w")).first()["w"]
    assert [(r["word"], r["start"], r["end"]) for r in found] == [("कर्म", 0, 4), ("योगः", 13, 17)]
    assert df.select(align.original_index(F.lit("a b c"), "\\s", F.lit(3)).alias("i")).first()["i"] == 5
    pairs = spark.createDataFrame([(1, "क ख ग घ ङ च छ ज", "क ख ग x घ ङ च ज"), (2, "क", "ख")], "pair_id int, source_text string, output_text string")
    got = {r["pair_id"]: r["final"] for r in align.repair_if_better(pairs, least=80).collect()}
    assert got == {1: "क ख ग x घ ङ च छ ज", 2: "ख"}


def test_caches(spark):
    files = spark.createDataFrame([("/a/b.md", "h1"), ("/a/c.md", "h2")], "path string, file_hash string")
    known = files.select(model.analysis_key(F.col("path")).alias("cache_key"), F.lit("h1").alias("file_hash"), F.lit('{"a": 1}').alias("analysis"))
    assert {r["path"]: r["analysis"] for r in model.cached_analyses(files, known).collect()} == {"/a/b.md": '{"a": 1}', "/a/c.md": None}
    cache = spark.createDataFrame([("1", "2024-01-01 00:00:00"), ("2", "2024-01-03 00:00:00"), ("3", "never")], "hash string, uploaded_at string")
    assert [r["hash"] for r in model.cleaned_cache(cache, F.lit("2024-01-03 01:00:00").cast("timestamp")).collect()] == ["2"]
    assert link.still_to_do(spark.createDataFrame([("a",), ("b",), ("c",)], "stem string"), spark.createDataFrame([("a", 3), ("b", 0)], "stem string, size int")).count() == 2


def test_details_document(spark):
    blocks = spark.createDataFrame([(1, 0, None, "intro", None, True), (1, 1, 1, "क", "टीका", False), (1, 2, None, "ख", None, False)], "doc_id int, idx int, number int, content string, commentary string, is_prefatory boolean")
    row = render.details_to_structured(blocks).first()
    assert row["problems"] == 1 and "# Mantra 1\nक\n\n# Commentary: 1\nटीका" in row["body"] and row["body"].startswith("# Prefatory: 0")
    text = spark.range(1).select(render.with_header(F.lit("id: x\nhash_version: 1\nvalidation_hash: old"), F.lit("क")).alias("t")).first()["t"]
    assert text == f"---\nid: x\nhash_version: 3\nvalidation_hash: {sha('क')}\n---\nक"
