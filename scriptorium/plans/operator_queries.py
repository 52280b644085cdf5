"""Queries that call one operator each over the driver's tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, script
from ..operators import align, chunk, fingerprint, link, render, rollup, rules, segment
from ..sources import documents as sources
from . import model


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lit_map(**values: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def _lines_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, and its text with each line feed written as two paragraph signs."""
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pair_id"), F.col("text").alias("source_text"))
    return docs.withColumn("output_text", F.replace("source_text", F.lit("\n"), F.lit("¶¶")))


def q17_diff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.diff_records(_lines_doubled(spark, sf_dir), "pair_id", "source_text", "output_text")
    return found.select("pair_id", "type", "whitespace_only", "before", "after", F.col("position").cast("long").alias("position"))


def q19_repaired_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first word of each document struck out, and repaired from the document."""
    repaired = align.word_repair("A-Za-zÀ-ÿ")("source_text", "output_text")
    rows = _struck(spark, sf_dir).withColumn("r", repaired)
    return rows.select("doc_id", "r.success", (F.col("r.text") == F.col("source_text")).alias("restored"))


def _struck(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.regexp_extract("text", f"^[{script.LATIN}]+", 0)
    struck = F.concat(F.repeat(F.lit("÷"), F.length(first)), F.substring(F.col("text"), F.length(first) + 1, F.length("text")))
    return _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source_text"), struck.alias("output_text"))


def q76_repair_if_better(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.repair_if_better(_struck(spark, sf_dir), "A-Za-zÀ-ÿ", script=script.LATIN)
    return out.select("doc_id", (F.col("final") == F.col("source_text")).alias("restored"))


def q20_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _lines_doubled(spark, sf_dir)
    records = align.diff_records(pairs, "pair_id", "source_text", "output_text")
    sized = pairs.select("pair_id", F.length("source_text").alias("n_chars"), F.length("output_text").alias("n_other"))
    out = rollup.diff_report(sized, records)
    return out.select("pair_id", F.col("n_chars").cast("long").alias("n_chars"), "n_space", "n_text", F.round("delta_percent", 6).alias("delta_percent"), F.col("rank").cast("long").alias("rank"))


def q39_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = script.text_stats(F.col("text"), script.LATIN)
    return _t(spark, sf_dir, "documents").select("doc_id", s["total"].alias("total"), s["distinct"].alias("distinct"), F.array_join(s["characters"], "").alias("characters"))


def q40_directory_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("dir"), F.col("n_name").alias("path"), F.encode(F.lower("n_name"), "UTF-8").alias("content"))
    return fingerprint.directory_hash(files)


def q41_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _t(spark, sf_dir, "nation")
    files = nation.select(F.col("n_name").alias("path"), F.sha2("n_name", 256).alias("sha256"), F.length("n_name").cast("long").alias("size_bytes"))
    works = nation.select(F.col("n_regionkey").alias("work_id"), F.col("n_name").alias("title"), (F.col("n_nationkey") % 7 == 0).alias("is_envelope"), F.col("n_name").alias("path"), F.lit(2).alias("n_commentaries"))
    m = rollup.manifest(files, works, "1.0.0", "2025-01-01")
    return m.select("version", "n_files", "n_bytes", "n_works", F.col("n_commentaries").cast("long").alias("n_commentaries"), F.array_join(F.transform("files", lambda f: f["path"]), ",").alias("paths"), F.array_join(F.transform("works", lambda w: w["title"]), ",").alias("titles"), F.length("checksum").cast("long").alias("n_hex"))


def q42_header_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    level = F.struct(F.when(c % 5 != 0, F.lit("Mantra")).alias("key"), F.create_map(F.when(c % 7 == 0, "roman").otherwise("devanagari"), F.lit("x")).alias("script_names"))
    header = F.struct(
        F.when(c % 11 != 0, F.col("c_name")).alias("grantha_id"), (c % 4).alias("part_num"), F.col("c_name").alias("canonical_title"), F.lower("c_mktsegment").alias("text_type"),
        F.when(c % 2 == 0, "sanskrit").otherwise("latin").alias("language"), F.array(level).alias("structure_levels"), F.lit(3).alias("hash_version"), F.when(c % 3 == 0, F.lit("h")).alias("validation_hash"),
    )
    return rules.violations(_t(spark, sf_dir, "customer").select("c_custkey", header.alias("header")), ["c_custkey"], rules.header_rules()).drop("message")


def q43_details_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.concat(F.lit("<details"), F.when(F.col("turn") % 2 == 0, " open").otherwise(""), F.lit(">\n<summary>"), F.col("role"), F.lit("</summary>\n"), F.col("text"), F.lit("\n</details>\n"))
    turns = _t(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", block.alias("block")).alias("b"))
    docs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["block"]), "").alias("text"))
    found = segment.details_blocks(docs)
    return found.select("doc_id", F.col("idx").cast("long").alias("idx"), "summary", "content", "is_open", F.col("start_line").cast("long").alias("start_line"))


def q44_commentary_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("n_name")
    listed = F.concat(F.lit('[{"commentary_id": "a"}, {"commentary_id": "'), name, F.lit('"}]'))
    mapped = F.concat(F.lit('{"'), name, F.lit('": {"title": "x"}}'))
    found = sources.commentaries_of(F.when(F.col("n_nationkey") % 2 == 0, listed).otherwise(mapped))
    rows = _t(spark, sf_dir, "nation").select("n_nationkey", F.inline(found))
    return rows.select("n_nationkey", "commentary_id", F.col("ord").cast("long").alias("ord"))


def q45_content_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = _lit_map(roman=F.lower("p_name"), devanagari=F.col("p_name"), other=F.lit("never"))
    english = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return _t(spark, sf_dir, "part").select("p_partkey", script.content_text(content, english, F.col("p_type")).alias("text"))


def q46_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.col("role").alias("commentary_id"))
    names = turns.select("doc_id").distinct().where("doc_id % 2 = 0").select("doc_id", F.array(F.lit("user"), F.lit("assistant")).alias("old"), F.array(F.lit("reader"), F.lit("assistant")).alias("new"))
    return link.renamed_commentaries(turns, names).select("doc_id", "turn", "commentary_id")


def _turn_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    return turns.select(F.col("conv_id").alias("doc_id"), (F.col("turn") % 3).cast("string").alias("ref"), F.col("turn").alias("block"), F.col("role").alias("commentary_id"), "text")


def q47_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.lookup(_turn_passages(spark, sf_dir), "1").select("doc_id", "block", "text")


def q47_passages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turn_passages(spark, sf_dir).withColumn("passage_type", F.when(F.col("commentary_id") == "user", "main").otherwise("prefatory"))
    rows = rows.withColumn("ref_key", F.array(F.col("ref").cast("int"))).withColumn("content", _lit_map(devanagari=F.col("text"), roman=F.lit("r")))
    return link.passages_of(rows, "main", ("devanagari",)).select("doc_id", "block", F.size("content").cast("long").alias("n_scripts"), F.element_at("content", "devanagari").alias("text"))


def q47_commentary_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.commentary_at(_turn_passages(spark, sf_dir), "assistant", "1").select("doc_id", "block", "text")


def q48_header_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("n_chars") < 1000, "short").otherwise("long")
    header = F.when(F.col("doc_id") % 3 == 0, _lit_map(lang=F.col("lang"), size=size, rare=F.lit("x"))).otherwise(_lit_map(lang=F.col("lang"), size=size))
    files = _t(spark, sf_dir, "documents").select(F.col("source").alias("work_id"), F.col("doc_id").alias("file"), header.alias("header"))
    return rollup.header_profile(files)


def q48_deviating(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = _t(spark, sf_dir, "documents").select(F.col("source").alias("work_id"), F.col("doc_id").alias("file"), _lit_map(lang=F.col("lang")).alias("header"))
    profile = headers.select("work_id").distinct().select("work_id", F.lit("lang").alias("field"), F.lit("en").alias("value"))
    return rollup.deviating_files(headers, profile)


def q49_merged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk"), _lit_map(title=F.col("text")).alias("header"), F.array(F.struct(F.col("role").alias("commentary_id"))).alias("commentaries"))
    m = rollup.merged_headers(chunks)
    names = F.array_join(F.transform("commentaries", lambda c: c["commentary_id"]), ",")
    return m.select("doc_id", F.element_at("header", "title").alias("title"), F.element_at("header", "text_type").alias("text_type"), names.alias("commentaries"))


def q50_ordered_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _t(spark, sf_dir, "conversations").where("conv_id % 3 <> 0 OR turn <> 1").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk"), F.concat(F.lit(" \n"), F.col("text"), F.lit("\t")).alias("content"))
    return chunk.ordered_merge(chunks)


def q51_chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 5000, "fine").otherwise("long")
    return rollup.chunk_summary(_t(spark, sf_dir, "documents").select(status.alias("status"), (F.col("n_chars") % 7).alias("char_diff")))


#: A schema with each kind of rule that the query breaks.
NATION_SCHEMA = {
    "type": "object",
    "required": ["name", "region", "files"],
    "properties": {
        "name": {"type": "string", "pattern": "^NATION_[0-9]$"},
        "region": {"$ref": "#/definitions/key"},
        "files": {"type": "array", "minItems": 1, "items": {"type": "object", "properties": {"part": {"$ref": "#/definitions/key"}}}},
    },
    "definitions": {"key": {"type": "integer", "minimum": 2}},
}


def q52_schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    text = F.concat(F.lit('{"name": "'), F.col("n_name"), F.lit('", "region": '), F.col("n_regionkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(', "files": [{"part": 5}, {"part": '), key, F.lit("}]"))).otherwise(""), F.lit("}"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", F.explode(rules.against_schema(text, NATION_SCHEMA)).alias("error"))


def q52_envelope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    rows = _t(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("grantha_id"), F.when(s % 2 == 0, "1.0.0").otherwise("1").alias("schema_version"), F.when(s % 3 == 0, F.col("s_name")).alias("canonical_title"), F.lit("upanishad").alias("text_type"),
        F.lit("english").alias("language"), F.when(s % 5 == 0, F.array(F.lit("part1.json"))).when(s % 5 == 1, F.array(F.lit("x.json"))).otherwise(F.array().cast("array<string>")).alias("parts"),
    )
    return rules.violations(rows, ["s_suppkey"], rules.schema_rules("envelope")).drop("severity")


def q53_passage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    ref = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("1."), F.col("turn").cast("string"))).when(F.col("turn") % 3 == 1, "a-b")
    kind = F.when(F.col("role") == "user", "main").when(F.col("role") == "system", "prefatory").otherwise("note")
    rows = turns.select("conv_id", "turn", ref.alias("ref"), kind.alias("passage_type"), F.lit(None).cast("map<string,string>").alias("label"), F.create_map(F.when(F.col("turn") % 2 == 0, "devanagari").otherwise("roman"), F.col("text")).alias("content"))
    return rules.violations(rows, ["conv_id", "turn"], rules.passage_rules()).select("conv_id", "turn", "rule_id")


def q53_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.repeated(_t(spark, sf_dir, "documents").select("lang", (F.col("n_chars") % 1000).alias("size")), ["lang", "size"])


def q54_hash_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    version = F.when(d % 5 != 0, F.when(d % 7 == 0, 2).otherwise(3))
    expected = F.when(d % 2 == 0, F.concat(F.lit("sha256:"), F.sha2(script.script_text(F.col("text"), script.LATIN), 256))).when(d % 3 == 0, F.lit("0"))
    return _t(spark, sf_dir, "documents").select("doc_id", fingerprint.hash_gate(F.col("text"), version, expected, script.LATIN).alias("state"))


def q55_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    back = docs.where("doc_id % 5 <> 0").withColumn("hash", F.when(F.col("doc_id") % 7 == 0, "altered").otherwise(F.col("hash")))
    return link.round_trip(docs, back)


def q56_original_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = align.original_index(F.col("text"), "\\s", F.lit(200))
    rows = _t(spark, sf_dir, "documents").select("doc_id", "text", at.alias("at"))
    line, near = align.line_at(F.col("text"), F.col("at")), align.context_at(F.col("text"), F.col("at"), 5)
    return rows.select("doc_id", F.col("at").cast("long").alias("at"), line.cast("long").alias("line"), near.alias("near"))


def q57_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").withColumn("content", _lit_map(devanagari=F.col("text")))
    passages = turns.where("role = 'user'").select(F.col("conv_id").alias("doc_id"), F.lit("main").alias("passage_type"), F.col("turn").cast("string").alias("ref"), F.lit(None).cast("map<string,string>").alias("label"), "content", F.col("turn").alias("seq"))
    notes = turns.where("role = 'assistant'").select(F.col("conv_id").alias("doc_id"), (F.col("turn") - 1).cast("string").alias("ref"), F.lit("assistant").alias("commentary_id"), "content", F.lit(0).alias("ord"))
    return render.rendered(render.document_fragments(passages, notes))


def q58_work_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    works = turns.select(F.col("conv_id").alias("work_id")).distinct().withColumn("title", F.concat(F.lit("Work "), F.col("work_id").cast("string")))
    kind = F.when(F.col("role") == "system", "prefatory").otherwise("main")
    passages = turns.select(F.col("conv_id").alias("work_id"), kind.alias("passage_type"), F.col("turn").alias("seq"), F.col("turn").cast("string").alias("ref"), _lit_map(devanagari=F.col("text"), other=F.lit("x")).alias("content"))
    value = lambda path: F.get_json_object("json", path)
    found = render.work_json(works, passages)
    return found.select("work_id", value("$.title").alias("title"), F.coalesce(F.json_array_length(value("$.passages")), F.lit(0)).cast("long").alias("n_main"), value("$.passages[0].ref").alias("first_ref"), value("$.passages[0].content.devanagari").alias("first_text"), value("$.passages[0].content.other").isNull().alias("filtered"))


def q59_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = render.with_header(F.concat(F.lit("lang: "), F.col("lang"), F.lit("\nhash_version: 1\n\n")), F.col("text"), script.LATIN)
    return _t(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def q60_applied_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _t(spark, sf_dir, "nation")
    headers = nation.select("n_nationkey", _lit_map(name=F.col("n_name"), kind=F.lit("old")).alias("header"))
    changes = nation.where("n_nationkey % 2 = 0").select("n_nationkey", F.lit("kind").alias("field"), F.lower("n_name").alias("new"))
    out = rollup.applied_changes(headers, changes, ["n_nationkey"])
    return out.select("n_nationkey", F.element_at("header", "name").alias("name"), F.element_at("header", "kind").alias("kind"))


def q61_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk"), F.col("text").alias("content"))
    return chunk.replayed(chunks, chunks.where("chunk % 2 = 0").select("doc_id", "chunk", F.sha2("content", 256).alias("response"))).drop("content")


def q61_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk"), F.col("text").alias("content"))
    answer = F.concat(F.lit("```markdown\n"), F.col("content"), F.when(F.col("doc_id") % 4 == 0, " altered").otherwise(""), F.lit("\n```"))
    responses = chunks.where("doc_id % 5 <> 0 OR chunk <> 0").select("doc_id", "chunk", answer.alias("response"))
    return model.converted(chunks, responses, chars=script.LATIN).select("doc_id", "status", "n_chunks")


def q62_cached_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _t(spark, sf_dir, "documents").select(F.concat(F.lit("/a/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.sha2("text", 256).alias("file_hash"))
    doc = F.regexp_extract("path", "(\\d+)\\.md$", 1).cast("long")
    cache = files.select(model.analysis_key(F.col("path")).alias("cache_key"), F.when(doc % 3 == 0, "stale").otherwise(F.col("file_hash")).alias("file_hash"), F.when(doc % 2 == 0, F.lit('{"k": 1}')).otherwise("no json {").alias("analysis"))
    return model.cached_analyses(files, cache).select("path", "cache_key", "analysis")


def q62_cleaned_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").cast("string").alias("uploaded_at"))
    now = _t(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return model.cleaned_cache(rows, now).select("event_id")


def q63_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ref"), F.col("n_name").alias("text"))
    edits = nation.where("ref % 3 = 0").select(F.when(F.col("ref") % 2 == 0, F.col("ref")).otherwise(F.col("ref") + 100).alias("ref"), F.lit("edited").alias("text"), F.lit(1).alias("version"))
    after = render.removed(render.upsert(nation, edits, ["ref"]), nation.where("ref % 5 = 0").select("ref"), ["ref"])
    new = render.updates_without_target(nation, edits, ["ref"])
    return after.select("ref", "text", F.lit("kept").alias("state")).unionByName(new.select("ref", "text", F.lit("new").alias("state")))


def q64_details_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("idx"), F.when(F.col("turn") % 3 != 2, F.col("turn")).alias("number"), F.col("text").alias("content"), F.when(F.col("role") == "user", F.col("role")).alias("commentary"), (F.col("role") == "system").alias("is_prefatory"))
    return render.details_to_structured(turns)


def q65_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    yaml = F.concat(F.lit("---\nlang: "), F.col("lang"), F.lit("\nsource: '"), F.col("source"), F.lit("'\n---\nBody\n"))
    toml = F.concat(F.lit('+++\nlang = "'), F.col("lang"), F.lit('"\nlang = "last"\n+++\nBody'))
    f, g = markup.frontmatter(yaml), markup.toml_header(toml)
    return _t(spark, sf_dir, "documents").select("doc_id", markup.header_value(f["header"], "lang").alias("lang"), markup.header_value(f["header"], "source").alias("source"), f["body"].alias("body"), F.element_at(g["header"], "lang").alias("toml_lang"), g["body"].alias("toml_body"), markup.third_part(yaml).alias("third"), markup.lenient_frontmatter(F.lit("---\na: b\n--- x"))["body"].alias("lenient"))


def q66_plain_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("**** "), F.col("n_name"), F.lit(" **** <b>x</b>\n\n\n\n । ॥ १ ॥"))
    fenced = F.concat(F.lit("```markdown\n"), F.col("n_name"), F.lit("\n```"))
    return _t(spark, sf_dir, "nation").select(
        "n_nationkey", markup.without_tags(text).alias("no_tags"), markup.without_noise(F.concat(F.lit("** "), F.col("n_name"), F.lit(" **"))).alias("no_noise"), markup.without_bold(text).alias("no_bold"), script.single_dandas(text).alias("dandas"),
        script.whitespace_only(F.lit(" \t")).alias("blank"), markup.fenced_lines(fenced).alias("lines"), markup.outer_fence(fenced).alias("outer"), markup.first_last_fence(fenced).alias("first_last"), markup.markdown_fence(fenced).alias("markdown"),
        markup.json_braces(F.concat(F.lit("so {"), F.col("n_name"), F.lit("} it is"))).alias("braces"),
    )


def q67_word_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.words_with_positions("A-Za-zÀ-ÿ")("text")
    rows = _t(spark, sf_dir, "documents").select("doc_id", found.alias("w"))
    letters = F.aggregate("w", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rows.select("doc_id", F.size("w").cast("long").alias("n_words"), letters.alias("n_letters"), F.get("w", F.lit(0))["word"].alias("first"))


def q68_chunk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    estimate = chunk.chunk_estimate(docs, most=2000)
    return docs.select("doc_id", chunk.should_chunk(F.col("text"), 2000).alias("needed")).join(estimate, "doc_id").select("doc_id", "needed", F.col("n_chunks").cast("long").alias("n_chunks"))


def q68_page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").alias("n_pages"))
    ranges = chunk.page_ranges(files, 10, 8)
    there = ranges.where("path % 2 = 0 OR chunk <> 1").select("path", "chunk")
    return ranges.join(chunk.all_present(ranges, there), "path").select("path", F.col("chunk").cast("long").alias("chunk"), F.col("first").cast("long").alias("first"), F.col("until").cast("long").alias("until"))


def q69_transliterated(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.translate(F.col("n_nationkey").cast("string"), "0123456789", script.NATIVE_DIGITS)
    text = F.concat(F.lit("शान्तिः "), digits)
    return _t(spark, sf_dir, "nation").select("n_nationkey", *[script.transliterated(text, s).alias(s.lower()) for s in ("HK", "IAST", "ITRANS")])


def q70_best_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's name with the most similar of its region's names that end in one letter more, by string identifiers."""
    left = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("dir"), F.concat(F.col("n_name"), F.lit(".md")).alias("id"), F.col("n_name").alias("text"))
    right = left.select("dir", F.concat(F.col("text"), F.lit("x.txt")).alias("id"), F.concat(F.col("text"), F.lit("x")).alias("text"))
    return link.best_match(left, right, ["dir"])


def queries() -> dict:
    """Every query of this module."""
    return {k: f for k, f in globals().items() if k.startswith("q") and k[1:3].isdigit()}


_LETTERS = "A-Za-z\\x{00C0}-\\x{00FF}"
_FOUND = f"regexp_extract_all(text, '[{_LETTERS}]+')"
_NO_SKIPPED = "regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?m)^#+\\s+.*$', '', 'g')"
_NEWLINES = "length(text) - length(replace(text, chr(10), ''))"
ORACLES = {
    "q17_diff_lines": """
        WITH r AS (SELECT doc_id, text, regexp_extract_all(text, '\\n+') AS runs, regexp_split_to_array(text, '\\n+') AS parts FROM documents),
             e AS (SELECT doc_id, parts, runs, unnest(range(1, len(runs) + 1)) AS k FROM r)
        SELECT doc_id AS pair_id, 'REPLACEMENT' AS type, false AS whitespace_only, runs[k] AS before, repeat('¶¶', length(runs[k])) AS after,
               CAST(list_sum(list_transform(parts[1:k], lambda p: length(p))) + coalesce(list_sum(list_transform(runs[1:k-1], lambda p: length(p))), 0) AS BIGINT) AS position FROM e""",
    "q19_repaired_words": f"""
        WITH w AS (SELECT doc_id, text, length(regexp_extract(text, '^[{_LETTERS}]+')) AS k, length(array_to_string(regexp_extract_all({_NO_SKIPPED}, '[{_LETTERS}]+'), ' ')) AS n FROM documents)
        SELECT doc_id, k = 0 OR CAST(200 * (n - k) AS DOUBLE) / (2 * n) >= 85.0 AS success, k = 0 OR CAST(200 * (n - k) AS DOUBLE) / (2 * n) >= 85.0 AS restored FROM w""",
    "q76_repair_if_better": f"""
        WITH w AS (SELECT doc_id, length(regexp_extract(text, '^[{_LETTERS}]+')) AS k, length(array_to_string(regexp_extract_all({_NO_SKIPPED}, '[{_LETTERS}]+'), ' ')) AS n FROM documents)
        SELECT doc_id, k = 0 OR CAST(200 * (n - k) AS DOUBLE) / (2 * n) >= 85.0 AS restored FROM w""",
    "q20_line_report": f"""
        WITH c AS (SELECT doc_id AS pair_id, length(text) AS n_chars, {_NEWLINES} AS nl, len(regexp_extract_all(text, '\\n+')) AS n_text FROM documents)
        SELECT pair_id, CAST(n_chars AS BIGINT) AS n_chars, CAST(0 AS BIGINT) AS n_space, CAST(n_text AS BIGINT) AS n_text, CASE WHEN n_chars > 0 THEN round(100.0::DOUBLE * nl / n_chars, 6) END AS delta_percent,
               CAST(rank() OVER (ORDER BY n_text DESC) AS BIGINT) AS rank FROM c""",
    "q39_text_stats": f"""
        WITH t AS (SELECT doc_id, array_to_string({_FOUND}, '') AS t FROM documents)
        SELECT doc_id, CAST(length(t) AS BIGINT) AS total, CAST(CASE WHEN t = '' THEN 0 ELSE len(list_distinct(string_split(t, ''))) END AS BIGINT) AS "distinct",
               CASE WHEN t = '' THEN '' ELSE array_to_string(list_sort(list_distinct(string_split(t, ''))), '') END AS characters FROM t""",
    "q40_directory_hash": "SELECT n_regionkey AS dir, sha256(string_agg(n_name || lower(n_name), '' ORDER BY n_name)) AS hash FROM nation GROUP BY 1",
    "q41_manifest": """
        WITH f AS (SELECT n_regionkey, arg_min(n_name, (CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 1 END, n_name)) AS title FROM nation GROUP BY 1)
        SELECT '1.0.0' AS version, count(*) AS n_files, CAST(sum(length(n_name)) AS BIGINT) AS n_bytes, (SELECT count(*) FROM f) AS n_works, (SELECT CAST(2 * count(*) AS BIGINT) FROM f) AS n_commentaries,
               string_agg(n_name, ',' ORDER BY n_name) AS paths, (SELECT string_agg(title, ',' ORDER BY n_regionkey) FROM f) AS titles, CAST(64 AS BIGINT) AS n_hex FROM nation""",
    "q42_header_rules": """
        WITH h AS (SELECT c_custkey, c_custkey AS c, c_name, lower(c_mktsegment) AS kind FROM customer)
        SELECT c_custkey, 'required:grantha_id' AS rule_id, 'error' AS severity FROM h WHERE c % 11 = 0
        UNION ALL SELECT c_custkey, 'id_pattern', 'error' FROM h WHERE c % 11 <> 0 AND NOT regexp_full_match(c_name, '[a-z0-9-]+')
        UNION ALL SELECT c_custkey, 'text_type', 'error' FROM h WHERE kind NOT IN ('upanishad', 'commentary')
        UNION ALL SELECT c_custkey, 'language', 'error' FROM h WHERE c % 2 <> 0
        UNION ALL SELECT c_custkey, 'part_num', 'error' FROM h WHERE c % 4 < 1
        UNION ALL SELECT c_custkey, 'level_key', 'error' FROM h WHERE c % 5 = 0
        UNION ALL SELECT c_custkey, 'level_script', 'error' FROM h WHERE c % 7 = 0
        UNION ALL SELECT c_custkey, 'validation_hash', 'warning' FROM h WHERE c % 3 <> 0""",
    "q43_details_blocks": f"""
        WITH t AS (SELECT conv_id, role, text, turn, row_number() OVER w - 1 AS idx, 4 + {_NEWLINES} AS nl FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id AS doc_id, CAST(idx AS BIGINT) AS idx, role AS summary, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS content, turn % 2 = 0 AS is_open,
               CAST(1 + coalesce(sum(nl) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_line FROM t""",
    "q44_commentary_metadata": """
        SELECT n_nationkey, 'a' AS commentary_id, CAST(0 AS BIGINT) AS ord FROM nation WHERE n_nationkey % 2 = 0
        UNION ALL SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END FROM nation""",
    "q45_content_text": "SELECT p_partkey, p_name || lower(p_name) || CASE WHEN p_size > 25 THEN p_brand ELSE '' END || p_type AS text FROM part",
    "q46_renamed": "SELECT conv_id AS doc_id, turn, CASE WHEN conv_id % 2 = 0 AND role = 'user' THEN 'reader' ELSE role END AS commentary_id FROM conversations",
    "q47_lookup": "SELECT conv_id AS doc_id, max(turn) AS block, arg_max(text, turn) AS text FROM conversations WHERE turn % 3 = 1 GROUP BY 1",
    "q47_passages_of": "SELECT conv_id AS doc_id, turn AS block, CAST(1 AS BIGINT) AS n_scripts, text FROM conversations WHERE role = 'user'",
    "q47_commentary_at": "SELECT conv_id AS doc_id, max(turn) AS block, arg_max(text, turn) AS text FROM conversations WHERE turn % 3 = 1 AND role = 'assistant' GROUP BY 1",
    "q48_header_profile": """
        WITH c AS (SELECT source AS work_id, doc_id, unnest([{'f': 'lang', 'v': lang}, {'f': 'size', 'v': CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END}]) AS x FROM documents),
             rare AS (SELECT source AS work_id FROM documents GROUP BY 1 HAVING bool_and(doc_id % 3 = 0)),
             n AS (SELECT work_id, x.f AS field, x.v AS value, count(*) AS n, min(doc_id) AS first FROM c GROUP BY ALL
                   UNION ALL SELECT source, 'rare', 'x', count(*), min(doc_id) FROM documents WHERE source IN (SELECT work_id FROM rare) GROUP BY 1)
        SELECT work_id, field, arg_max(value, (n, -first)) AS value, max(n) AS n, CAST(sum(n) - max(n) AS BIGINT) AS deviating FROM n GROUP BY 1, 2""",
    "q48_deviating": "SELECT source AS work_id, 'lang' AS field, doc_id AS file, lang AS value, 'en' AS expected FROM documents WHERE lang <> 'en'",
    "q49_merged_headers": """
        WITH f AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1, 2)
        SELECT c.conv_id AS doc_id, arg_min(c.text, c.turn) AS title, 'upanishad' AS text_type, (SELECT string_agg(role, ',' ORDER BY t) FROM f WHERE f.conv_id = c.conv_id) AS commentaries FROM conversations c GROUP BY 1""",
    "q50_ordered_merge": """
        WITH c AS (SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM conversations WHERE conv_id % 3 <> 0 OR turn <> 1)
        SELECT conv_id AS doc_id, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE t <> ''), '') AS body, count(*) AS n_chunks, count(DISTINCT turn) = max(turn) - min(turn) + 1 AS complete FROM c GROUP BY 1""",
    "q51_chunk_summary": "SELECT CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 5000 THEN 'fine' ELSE 'long' END AS status, count(*) AS n, CAST(sum(n_chars % 7) AS BIGINT) AS char_diff FROM documents GROUP BY ROLLUP (1)",
    "q52_schema_errors": """
        SELECT n_nationkey, 'root: ''files'' is a required property' AS error FROM nation WHERE n_nationkey % 2 <> 0
        UNION ALL SELECT n_nationkey, 'name: "' || n_name || '" does not match ^NATION_[0-9]$' FROM nation WHERE NOT regexp_full_match(n_name, 'NATION_[0-9]')
        UNION ALL SELECT n_nationkey, 'region: ' || n_regionkey || ' is less than the minimum of 2' FROM nation WHERE n_regionkey < 2
        UNION ALL SELECT n_nationkey, 'files.1.part: ' || n_nationkey || ' is less than the minimum of 2' FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey < 2""",
    "q52_envelope_rules": """
        SELECT s_suppkey, 'grantha_id' AS rule_id, '$.grantha_id: pattern' AS message FROM supplier WHERE NOT regexp_full_match(s_name, '[a-z0-9-]+')
        UNION ALL SELECT s_suppkey, 'schema_version', '$.schema_version: semantic version' FROM supplier WHERE s_suppkey % 2 <> 0
        UNION ALL SELECT s_suppkey, 'canonical_title', '$.canonical_title: required' FROM supplier WHERE s_suppkey % 3 <> 0
        UNION ALL SELECT s_suppkey, 'parts', '$.parts: at least one' FROM supplier WHERE s_suppkey % 5 > 1
        UNION ALL SELECT s_suppkey, 'part_names', '$.parts: pattern' FROM supplier WHERE s_suppkey % 5 = 1""",
    "q53_passage_rules": """
        SELECT conv_id, turn, 'ref_missing' AS rule_id FROM conversations WHERE turn % 3 = 2
        UNION ALL SELECT conv_id, turn, 'ref_form' FROM conversations WHERE turn % 3 = 1
        UNION ALL SELECT conv_id, turn, 'type' FROM conversations WHERE role NOT IN ('user', 'system')
        UNION ALL SELECT conv_id, turn, 'label' FROM conversations WHERE role <> 'user'
        UNION ALL SELECT conv_id, turn, 'content' FROM conversations WHERE turn % 2 <> 0""",
    "q53_repeated": "SELECT lang, n_chars % 1000 AS size, count(*) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1",
    "q54_hash_gate": """
        SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'version_missing' WHEN doc_id % 7 = 0 THEN 'version_mismatch' WHEN doc_id % 2 <> 0 AND doc_id % 3 <> 0 THEN 'hash_missing'
                            WHEN doc_id % 2 <> 0 THEN 'hash_mismatch' ELSE 'ok' END AS state FROM documents""",
    "q55_round_trip": "SELECT doc_id, doc_id % 5 <> 0 AND doc_id % 7 <> 0 AS same FROM documents",
    "q56_original_index": """
        WITH p AS (SELECT doc_id, text, length(regexp_extract(text, '^(?:[\\s\\x{0085}\\x{00A0}\\x{2000}-\\x{200A}\\x{3000}]*[^\\s\\x{0085}\\x{00A0}\\x{2000}-\\x{200A}\\x{3000}]){200}')) AS n FROM documents)
        SELECT doc_id, CASE WHEN n > 0 THEN CAST(n AS BIGINT) END AS at, CASE WHEN n > 0 THEN CAST(n - length(replace(left(text, n), chr(10), '')) + 1 AS BIGINT) END AS line,
               CASE WHEN n > 0 THEN substring(text, n - 5, 11) END AS near FROM p""",
    "q57_documents": """
        WITH f AS (SELECT conv_id, turn AS seq, 0 AS sub, '# Mantra ' || turn || chr(10) || '<!-- sanskrit:devanagari -->' || chr(10) || text || chr(10) || '<!-- /sanskrit:devanagari -->' AS t FROM conversations WHERE role = 'user'
             UNION ALL SELECT a.conv_id, u.turn, 1, '<!-- commentary: {"commentary_id":"assistant"} -->' || chr(10) || '# Commentary: ' || u.turn || chr(10) || '<!-- sanskrit:devanagari -->' || chr(10) || a.text || chr(10) || '<!-- /sanskrit:devanagari -->'
                       FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user' WHERE a.role = 'assistant')
        SELECT conv_id AS doc_id, string_agg(t, chr(10) || chr(10) ORDER BY seq, sub) AS body FROM f GROUP BY 1""",
    "q58_work_json": """
        SELECT conv_id AS work_id, 'Work ' || conv_id AS title, count(*) FILTER (WHERE role <> 'system') AS n_main, CAST(min(turn) FILTER (WHERE role <> 'system') AS VARCHAR) AS first_ref,
               arg_min(text, turn) FILTER (WHERE role <> 'system') AS first_text, true AS filtered FROM conversations GROUP BY 1""",
    "q59_with_header": f"""
        SELECT doc_id, '---' || chr(10) || 'lang: ' || lang || chr(10) || 'hash_version: 3' || chr(10) || 'validation_hash: ' || sha256(array_to_string({_FOUND}, ' ')) || chr(10) || '---' || chr(10) || text AS text FROM documents""",
    "q60_applied_changes": "SELECT n_nationkey, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE 'old' END AS kind FROM nation",
    "q61_replayed": "SELECT conv_id AS doc_id, turn AS chunk, CASE WHEN turn % 2 = 0 THEN sha256(text) END AS response FROM conversations",
    "q61_converted": """
        SELECT conv_id AS doc_id, CASE WHEN conv_id % 4 = 0 OR conv_id % 5 = 0 AND min(turn) = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS n_chunks FROM conversations GROUP BY 1, conv_id""",
    "q62_cached_analyses": """
        SELECT '/a/' || doc_id || '.md' AS path, doc_id || '_' || left(sha256('/a/' || doc_id || '.md'), 8) AS cache_key, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0 THEN '{"k": 1}' END AS analysis FROM documents""",
    "q62_cleaned_cache": "SELECT event_id FROM (SELECT event_id, (epoch_us(max(ts) OVER ()) - epoch_us(ts)) / 3.6e9 AS age FROM events) WHERE age < 48",
    "q63_edits": """
        WITH e AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE n_nationkey + 100 END AS ref FROM nation WHERE n_nationkey % 3 = 0),
             a AS (SELECT n_nationkey AS ref, CASE WHEN n_nationkey IN (SELECT ref FROM e) THEN 'edited' ELSE n_name END AS text FROM nation UNION ALL SELECT ref, 'edited' FROM e WHERE ref >= 100)
        SELECT ref, text, 'kept' AS state FROM a WHERE ref NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 5 = 0) UNION ALL SELECT ref, 'edited', 'new' FROM e WHERE ref >= 100""",
    "q64_details_documents": """
        WITH b AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN '# Prefatory: 0 (devanagari: "")' WHEN turn % 3 <> 2 THEN '# Mantra ' || turn END || chr(10) || text
                          || CASE WHEN role = 'user' THEN chr(10) || chr(10) || '# Commentary: ' || CASE WHEN turn % 3 <> 2 THEN CAST(turn AS VARCHAR) END || chr(10) || 'user' ELSE '' END AS t,
                          role <> 'system' AND turn % 3 = 2 AS bad FROM conversations)
        SELECT conv_id AS doc_id, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY turn), '') AS body, count(*) FILTER (WHERE bad) AS problems FROM b GROUP BY 1""",
    "q65_headers": """
        SELECT doc_id, lang, source, 'Body' AS body, 'last' AS toml_lang, 'Body' AS toml_body, chr(10) || 'Body' || chr(10) AS third, ' x' AS lenient FROM documents""",
    "q66_plain_marks": """
        SELECT n_nationkey, '**** ' || n_name || ' **** x' || chr(10) || chr(10) || ' । ॥ १ ॥' AS no_tags, '**' || n_name || '**' AS no_noise, ' ' || n_name || '  <b>x</b>' || repeat(chr(10), 4) || ' । ॥ १ ॥' AS no_bold,
               '**** ' || n_name || ' **** <b>x</b>' || repeat(chr(10), 4) || ' । ।। १ ।।' AS dandas, true AS blank, n_name AS lines, n_name AS outer, n_name AS first_last, n_name AS markdown, '{' || n_name || '}' AS braces FROM nation""",
    "q67_word_places": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all({_NO_SKIPPED}, '[{_LETTERS}]+') AS w FROM documents)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS n_letters, w[1] AS first FROM w""",
    "q68_chunk_sizes": "SELECT doc_id, strlen(text) >= 2000 AS needed, CAST(1 AS BIGINT) AS n_chunks FROM documents",
    "q68_page_ranges": """
        WITH r AS (SELECT p_partkey AS path, p_size, unnest(range(0, p_size, 8)) AS first FROM part)
        SELECT path, CAST(first // 8 AS BIGINT) AS chunk, CAST(first AS BIGINT) AS first, CAST(least(first + 10, p_size) AS BIGINT) AS until FROM r WHERE path % 2 = 0 OR p_size <= 8""",
    "q69_transliterated": "SELECT n_nationkey, 'zAntiH ' || n_nationkey AS hk, 'śāntiḥ ' || n_nationkey AS iast, 'shAntiH ' || n_nationkey AS itrans FROM nation",
    "q70_best_names": """
        SELECT n_name || '.md' AS left_id, n_name || 'x.txt' AS right_id, 100.0::DOUBLE * 2 * length(n_name) / (2 * length(n_name) + 1) AS score FROM nation""",
}
