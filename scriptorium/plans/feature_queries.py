"""Queries of the larger features: similarity joins, diffs, schemas, nested works, digests, edit logs; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, script
from ..operators import align, chunk, digest, edit_log, edits, match, ranges, render, rollup, rules, schemas, similar, tree
from ..sources import documents as sources
from ..sources import works


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q72_similar_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of page addresses that are similar to 85 of 100."""
    return similar.similar_pairs(_t(spark, sf_dir, "pages"), "page_id", "url", least=85.0)


def q73_best_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each address without scheme and query the most similar full one, from 70 on."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    bare = pages.withColumn("url", F.regexp_replace("url", "^https?://|[?#].*$", ""))
    return similar.best_similar(bare, pages, 70.0, "page_id", "page_id", "url", "url")


def q74_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word of each document, a different one in each, replaced, struck with its space, or doubled by strange marks; and what the difference counts."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text", F.split("text", " ").alias("w"))
    k = F.pmod(F.col("doc_id"), F.size("w")).cast("int") + 1
    word = F.element_at("w", k)
    changed = F.when(F.col("doc_id") % 3 == 0, F.repeat(F.lit("÷"), F.length(word))).when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise(F.concat(word, F.lit("¶¶")))
    rest = F.concat(F.slice("w", F.lit(1), k - 1), F.filter(F.array(changed), lambda x: x.isNotNull()), F.slice("w", k + 1, F.size("w")))
    rows = docs.select("doc_id", F.col("text").alias("a"), F.array_join(rest, " ").alias("b"))
    return rows.select("doc_id", edits.edit_counts("a", "b").alias("c")).select("doc_id", *[F.col(f"c.{c}").cast("long").alias(c) for c in ("segments", "deleted", "inserted")])


def _conversation_works(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(works, passages, commentary passages) of conversations: users' turns, and two commentaries on them, of which one has introductions."""
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("work_id"), "turn", "role", "text")
    heads = turns.groupBy("work_id").agg(F.count("*").alias("part_num")).select("work_id", F.concat(F.lit("conversation-"), F.col("work_id")).alias("grantha_id"), "part_num")
    by_script = lambda c: F.create_map(F.lit("devanagari"), c, F.lit("roman"), F.concat(F.lit("r:"), c))
    section = F.when(F.col("role") == "system", 0).otherwise(1)
    kind = F.when(F.col("role") == "system", "prefatory").otherwise("main")
    label = F.when((F.col("role") == "system") & (F.col("work_id") % 3 > 0), F.create_map(F.lit("devanagari"), F.lit("आदिः")))
    own = turns.where("role <> 'assistant'").select("work_id", section.alias("section"), F.col("turn").alias("seq"), F.col("turn").cast("string").alias("ref"), kind.alias("passage_type"), label.alias("label"), by_script(F.col("text")).alias("content"), F.lit(None).cast("string").alias("english"))
    none = F.array().cast("array<struct<type:string,label:string,content:map<string,string>,english:string>>")
    intro = F.array(F.struct(F.lit("intro").alias("type"), F.lit(None).cast("string").alias("label"), F.create_map(F.lit("devanagari"), F.lit("intro ")).alias("content"), F.lit(None).cast("string").alias("english")))
    notes = turns.where("role = 'assistant'").withColumn("ord", F.explode(F.array(F.lit(0), F.lit(1))))
    notes = notes.select(
        "work_id", F.when(F.col("ord") == 0, "zeta").otherwise("alpha").alias("commentary_id"), "ord", F.lit("Notes").alias("title"), F.create_map(F.lit("devanagari"), F.lit("क")).alias("commentator"), F.col("turn").alias("seq"),
        (F.col("turn") - 1).cast("string").alias("ref"), F.when(F.col("ord") == 0, intro).otherwise(none).alias("before"), by_script(F.when(F.col("ord") == 0, F.col("text")).otherwise(F.reverse("text"))).alias("content"), F.lit(None).cast("string").alias("english"),
    )
    return heads, own, notes


def _as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(work_id, json) of the works of conversations; every second work has its commentaries as a map."""
    heads, own, notes = _conversation_works(spark, sf_dir)
    even = lambda df, n: df.where(F.col("work_id") % 2 == n)
    made = [works.whole_works(even(heads, n), even(own, n), even(notes, n), key="work_id", as_map=n == 1) for n in (0, 1)]
    return made[0].unionByName(made[1])


def _read_back(made: DataFrame) -> DataFrame:
    return made.select("work_id", F.from_json("json", sources.WORK).alias("w")).select("work_id", "w.*")


def q75_works_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and commentary passages read from the JSON of works, one script of each."""
    read = _read_back(_as_json(spark, sf_dir))
    own = sources.work_passages(read, "work_id").select("work_id", F.lit("").alias("commentary_id"), "ref", F.lit(0).cast("long").alias("n_before"), F.element_at("content", "roman").alias("text"))
    notes = works.commentary_passages(read, "work_id")
    return own.unionByName(notes.select("work_id", "commentary_id", "ref", F.size("before").cast("long").alias("n_before"), F.element_at("content", "roman").alias("text")))


def q77_verified_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes by what each header names, and whether they hold after the first commentary of every third work was changed."""
    made = _as_json(spark, sf_dir)
    named = F.when(F.col("work_id") % 4 == 0, F.array(F.lit("zeta"))).when(F.col("work_id") % 4 == 1, F.array(F.lit("alpha"), F.lit("zeta"))).when(F.col("work_id") % 4 == 2, F.array(F.lit("alpha")))
    # from the works, not from their JSON, which each use of the headers would make again
    headers = _conversation_works(spark, sf_dir)[0].select("work_id", F.array(F.lit("devanagari")).alias("scripts"), named.alias("commentaries"))
    found = works.header_hash(_read_back(made), headers, "work_id", script.LATIN)
    altered = made.withColumn("json", F.when(F.col("work_id") % 3 == 0, F.replace("json", F.lit('"intro "'), F.lit('"changed "'))).otherwise(F.col("json")))
    checked = works.verified(_read_back(altered), headers.join(found.withColumnRenamed("hash", "validation_hash"), "work_id"), "work_id", script.LATIN)
    return found.join(checked, "work_id").select("work_id", "hash", "same")


#: A work's schema in two files, with a condition and references between them.
_PASSAGE_FILE = {
    "definitions": {
        "passage": {
            "type": "object", "required": ["ref", "passage_type", "content"], "properties": {"ref": {"type": "string"}, "passage_type": {"enum": ["prefatory", "main", "concluding"]}},
            "if": {"properties": {"passage_type": {"enum": ["prefatory", "concluding"]}}}, "then": {"required": ["label"]},
        },
        "commentary": {"type": "object", "required": ["commentary_id", "passages"], "properties": {"passages": {"type": "array", "items": {"type": "object", "required": ["ref", "content"]}}}},
    }
}
_WORK_FILE = {
    "type": "object", "required": ["grantha_id", "part_num"],
    "properties": {
        "part_num": {"type": "integer", "maximum": 6}, "prefatory_material": {"type": "array", "items": {"$ref": "passage.json#/definitions/passage"}}, "passages": {"type": "array", "items": {"$ref": "passage.json#/definitions/passage"}},
        "commentaries": {"oneOf": [{"type": "array", "items": {"$ref": "passage.json#/definitions/commentary"}}, {"type": "object", "additionalProperties": {"$ref": "passage.json#/definitions/commentary"}}]},
    },
}


def q78_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of a schema in two files by place and keyword: prefatory passages without label, works of more than six turns."""
    return schemas.schema_report(_as_json(spark, sf_dir), "json", _WORK_FILE, {"passage.json": _PASSAGE_FILE}, "work_id")


def q79_directory_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest over all documents of a source, as files in a directory."""
    files = _t(spark, sf_dir, "documents").select(F.col("source").alias("dir"), F.concat("lang", F.lit("/"), "doc_id", F.lit(".md")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return digest.directory_digests(files)


def q80_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of turns that no user took, in a range of a thousand million for each conversation."""
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    notes = turns.select(F.col("conv_id").alias("doc_id")).distinct().withColumn("ref", F.concat("doc_id", F.lit(".0-1000000000")))
    there = turns.where("role = 'user'").select(F.col("conv_id").alias("doc_id"), F.concat("conv_id", F.lit("."), "turn").alias("ref"))
    return ranges.coverage_gaps(notes, there)


def q81_lines_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines (order.number) lie in the range that each order spans, within groups of customers and suppliers."""
    points = _t(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).alias("doc_id"), F.concat("l_orderkey", F.lit("."), "l_linenumber").alias("ref"))
    key = F.col("o_orderkey")
    spans = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("doc_id"), key.alias("o_orderkey"), F.concat(key, F.lit(".2")).alias("start"), F.concat(key + key % 40, F.lit(".3")).alias("end"))
    return ranges.containing(points, spans).groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count_distinct("ref").alias("n_refs"))


def q82_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as trees, ten in all: system turns stand on the level of their conversation, others below."""
    turns = _t(spark, sf_dir, "conversations")
    ref = F.when(F.col("role") == "system", F.col("conv_id").cast("string")).otherwise(F.concat("conv_id", F.lit("."), "turn"))
    rows = turns.select((F.col("conv_id") % 10).alias("doc_id"), ref.alias("ref"), F.col("turn").alias("seq"), "role")
    return tree.hierarchy_trees(rows, F.concat(F.lit('"'), F.col("role"), F.lit('"')))


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as logs: system turns add prefatory passages, users' add one of three passages, answers update, remove or comment on one."""
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("work_id"), "turn", "role", "text")
    answer = F.when(F.col("turn") % 4 == 1, "update").when(F.col("turn") % 4 == 3, "remove").otherwise("comment")
    action = F.when(F.col("role") == "assistant", answer).otherwise("add")
    ref = F.when(F.col("role") == "system", F.lit(0)).otherwise(F.col("turn") % 3).cast("string")
    kind = F.when(F.col("role") == "system", "prefatory").when(F.col("role") == "user", "main")
    note = F.when(action == "comment", "notes")
    log = turns.select("work_id", F.floor(F.col("turn") / 4).alias("version"), (F.col("turn") % 4).alias("seq"), action.alias("action"), ref.alias("ref"), kind.alias("passage_type"), F.lit(None).cast("string").alias("label"), note.alias("commentary_id"), F.col("text").alias("content"), F.lit(None).cast("string").alias("value"))
    heads = log.select("work_id").distinct()
    field = lambda name, n, value: heads.select("work_id", F.lit(-1).cast("long").alias("version"), F.lit(n).cast("long").alias("seq"), F.lit("set").alias("action"), F.lit(name).alias("ref"), value.cast("string").alias("value"))
    sets = field("grantha_id", 0, F.concat(F.lit("w"), F.col("work_id"))).unionByName(field("canonical_title", 1, F.when(F.col("work_id") % 3 > 0, F.lit("Title"))))
    return log.unionByName(sets, allowMissingColumns=True)


def q83_edit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands after all edits, passages and comments; the first batch is in the log twice."""
    log = _edits(spark, sf_dir)
    passages, notes = edit_log.folded(log.unionByName(log.where("version = 0")))
    long = lambda c: F.col(c).cast("long").alias(c)
    return passages.select("work_id", long("section"), long("n"), "ref", "content").unionByName(notes.select("work_id", F.lit(3).cast("long").alias("section"), long("n"), "ref", "content"))


def q84_edit_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_log.problems(_edits(spark, sf_dir)).drop("seq", "version")


#: Small documents, each with one breach of the line grammar but the first, which has none; {t} is a line of text.
_NOTE = '<!-- commentary: {"commentary_id": "c"} -->\n'
_LINES = (
    "# Mantra 1\n<!-- sanskrit:devanagari -->\n{t}\n<!-- /sanskrit:devanagari -->",
    "# Mantra 1\n\n# Mantra 2\n# Mantra 1",
    "# Mantra 1\n# Commentary: 1",
    f"# Mantra 1\n{_NOTE}# Mantra 2",
    '# Mantra 1\n<!-- commentary: {"x": 1} -->\n# Commentary: 1',
    f"# Mantra 1\n{_NOTE}# Commentary: 3-1",
    "# Mantra 1\n{t}",
    "# Mantra 1\n<!-- sanskrit:devanagari -->\n{t}\n<!-- /sanskrit:roman -->",
    "# Mantra 1\n\n<!-- sanskrit:roman -->\n{t}",
    f"# Mantra 1\n{_NOTE}# Commentary: 1-3",
)


def q85_grammar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the line grammar, on a small document around the start of each turn."""
    turns = _t(spark, sf_dir, "conversations")
    key = F.col("conv_id") * 1000 + F.col("turn")
    line = F.concat(F.lit("t "), F.regexp_replace(F.left("text", F.lit(20)), "[^A-Za-z]", "x"))
    docs = turns.select(key.alias("doc_id"), F.replace(F.element_at(F.array(*map(F.lit, _LINES)), ((F.col("conv_id") + F.col("turn")) % 10 + 1).cast("int")), F.lit("{t}"), line).alias("body"))
    return rules.line_grammar(docs).select("doc_id", F.col("line_num").cast("long").alias("line_num"), "rule_id", "detail")


def q86_preservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One character of each document altered, at another place in each; every fifth is whole, every fifth cut there."""
    docs = _t(spark, sf_dir, "documents").withColumn("at", F.pmod("doc_id", F.length("text")).cast("int") + 1)
    kind = F.col("doc_id") % 5
    other = F.when(kind == 0, F.col("text")).when(kind == 1, F.left("text", F.col("at") - 1)).otherwise(F.overlay("text", F.lit("÷"), F.col("at")))
    p = rules.preservation(F.col("text"), F.col("other"))
    return docs.withColumn("other", other).select("doc_id", p["same"].alias("same"), p["length_diff"].cast("long").alias("length_diff"), p["first_difference"].cast("long").alias("first_difference"))


def q87_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose JSON is sound, or has single backslashes in a pattern, or breaks off."""
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.concat(F.lit('{"regex": "a'), "event_id", F.lit('"}'))).when(kind == 1, F.concat(F.lit('{"regex": "\\d+\\.'), "event_id", F.lit('"}'))).otherwise(F.concat(F.lit('{"regex": "'), "event_id"))
    found = markup.parsed_json(F.concat(F.lit("```json\n"), text, F.lit("\n```")))
    rows = _t(spark, sf_dir, "events").select("event_id", found.alias("p"))
    return rows.select("event_id", "p.status", F.try_variant_get("p.value", "$.regex", "string").alias("pattern"))


def q88_manifest_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    files = part.select(F.concat(F.lit("p/"), "p_partkey").alias("path"), F.sha2("p_name", 256).alias("sha256"), F.length("p_name").cast("long").alias("size_bytes"))
    works = part.select(F.col("p_brand").alias("work_id"), F.col("p_name").alias("title"), (F.col("p_size") == 1).alias("is_envelope"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("path"), F.col("p_size").cast("long").alias("n_commentaries"))
    return rollup.manifest(files, works, "1.0.0", "2025-01-01").select("n_files", "n_bytes", "n_works", "n_commentaries", "checksum")


def q89_chunk_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates for documents with a heading after each line feed."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n**प्रथमः** **खण्डः**\n")).alias("text"))
    return chunk.chunk_estimate(docs, most=500).select("doc_id", F.col("n_chunks").cast("long").alias("n_chunks"))


def q90_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All consonants and signs, as orders and customers number them, in one scheme."""
    letters, signs = list(script.CONSONANTS), ["", script.VIRAMA, *script.SIGNS]
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    text = F.concat(pick(letters, F.col("o_orderkey")), pick(signs, F.col("o_custkey")))
    return _t(spark, sf_dir, "orders").select(text.alias("text")).groupBy("text").agg(F.count("*").alias("n")).select(script.transliterated(F.col("text")).alias("hk"), "n")


def q91_directory_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders by brand, with their part numbers in several forms."""
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("part-"), k)).when(k % 3 == 1, F.concat(F.lit("x-"), F.lpad((k % 97).cast("string"), 2, "0"))).otherwise(F.lit("whole"))
    files = _t(spark, sf_dir, "part").select(F.concat(F.lit("/lib/"), F.translate("p_brand", "#", "-"), F.lit("/"), name, F.lit(".md")).alias("path")).distinct()
    return sources.directory_targets(files).select("dir", F.array_join("files", " ").alias("files"), "multipart")


def q92_best_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn, marked up and with one word more, against all turns of its conversation as files."""
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("dir"), F.format_string("%06d.md", F.col("turn").cast("int")).alias("name"), "text")
    marked = turns.withColumn("text", F.concat(F.lit("---\nlang: xx\n---\n# Heading\n<!-- a comment -->\n**"), "text", F.lit("** zz")))
    repaired = turns.withColumn("name", F.lit("0.repaired.md")).withColumn("text", F.concat("text", F.lit(" zz")))
    return match.best_files(marked, turns.unionByName(repaired), chars=script.LATIN)


def q93_content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their hash put in the header; null for every third, which has no header, and above a count of differences."""
    docs = _t(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("---\nlang: "), "lang", F.when(F.col("doc_id") % 2 == 0, "\ngrantha_hash: old").otherwise(""), F.lit("\n---\n"), "text")).otherwise(F.col("text"))
    stamped = match.with_content_hash(text, chars=script.LATIN, n_different=F.col("doc_id") % 7, most=5)
    return docs.select("doc_id", stamped.alias("text"))


def q94_repaired_anywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words in a row, one of them struck out, another one in each document; repaired where enough is left."""
    words = script.script_words(F.col("text"), script.LATIN)
    docs = _t(spark, sf_dir, "documents").select("doc_id", words.alias("w")).where(F.size("w") > 0).withColumn("k", F.pmod("doc_id", F.size("w")).cast("int"))
    struck = F.transform("w", lambda x, i: F.when(i == F.col("k"), F.lit("¶¶")).otherwise(x))  # no letters: a division sign is one of the class
    pairs = docs.select("doc_id", "w", F.array_join("w", ", ").alias("source_text"), F.array_join(struck, ", ").alias("output_text"))
    found = pairs.withColumn("r", align.word_repair("A-Za-zÀ-ÿ")("source_text", "output_text"))
    return found.select("doc_id", "r.success", (script.script_words(F.col("r.text"), script.LATIN) == F.col("w")).alias("restored"))


def q95_nested_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the nested form, ten documents with a level for the conversation and one for the turn."""
    turns = _t(spark, sf_dir, "conversations").withColumn("content", F.create_map(F.lit("devanagari"), F.col("text")))
    ref = lambda n: F.concat("conv_id", F.lit("."), (F.col("turn") - n).cast("string"))
    key, order = (F.col("conv_id") % 10).alias("doc_id"), F.col("conv_id") * 1000 + F.col("turn")
    label = F.create_map(F.lit("devanagari"), F.lit("आदिः"))
    kind = F.when(F.col("role") == "system", "prefatory").otherwise("main")
    passages = turns.where("role <> 'assistant'").select(key, kind.alias("passage_type"), F.when(F.col("role") == "system", F.col("conv_id").cast("string")).otherwise(ref(0)).alias("ref"), label.alias("label"), "content", order.alias("seq"))
    notes = turns.where("role = 'assistant'").select(key, ref(1).alias("ref"), F.lit("c").alias("commentary_id"), "content", F.lit(0).alias("ord"))
    return render.nested_body(passages, notes, ["Talk", "Turn"])


def queries() -> dict:
    """Every query of this module."""
    return {k: f for k, f in globals().items() if k.startswith("q") and k[1:3].isdigit()}


def _ratio_sql(column: str, table: str, pairs: str) -> str:
    """A select of the indel ratio of ``pairs`` (a, b): bits of a 128-bit number are the characters of ``a``, at most 120."""
    return f"""
             letters AS (SELECT a, c, bit_or(1::HUGEINT << k) AS m FROM (SELECT a, unnest(string_split(a, '')) AS c, unnest(range(length(a))) AS k FROM (SELECT DISTINCT {column} AS a FROM {table})) GROUP BY 1, 2),
             masks AS (SELECT a, map_from_entries(list((c, m))) AS ms, (1::HUGEINT << length(a)) - 1 AS every FROM letters GROUP BY 1),
             scored AS (SELECT a, b, 100.0::DOUBLE * 2 * (length(a) - bit_count(list_reduce(list_transform(string_split(b, ''), lambda c: coalesce(ms[c], 0::HUGEINT)),
                          lambda v, m: ((v + (v & m)) | (v - (v & m))) & every, every))) / (length(a) + length(b)) AS score
                        FROM ({pairs}) JOIN masks USING (a))"""


_LATIN_WORDS = "regexp_extract_all({}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')"
ORACLES = {
    "q74_edit_counts": """
        WITH w AS (SELECT doc_id, CAST(length(string_split(text, ' ')[1 + doc_id % len(string_split(text, ' '))]) AS BIGINT) AS n, len(string_split(text, ' ')) AS m FROM documents)
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN n > 0 THEN 2 ELSE 0 END WHEN doc_id % 3 = 1 THEN CASE WHEN n > 0 OR m > 1 THEN 1 ELSE 0 END ELSE 1 END::BIGINT AS segments,
               CASE WHEN doc_id % 3 = 0 THEN n WHEN doc_id % 3 = 1 THEN n + CASE WHEN m > 1 THEN 1 ELSE 0 END ELSE 0 END AS deleted, CASE WHEN doc_id % 3 = 0 THEN n WHEN doc_id % 3 = 1 THEN 0 ELSE 2 END AS inserted FROM w""",
    "q75_works_both_ways": """
        SELECT conv_id AS work_id, '' AS commentary_id, CAST(turn AS VARCHAR) AS ref, CAST(0 AS BIGINT) AS n_before, 'r:' || text AS text FROM conversations WHERE role <> 'assistant'
        UNION ALL SELECT conv_id, c, CAST(turn - 1 AS VARCHAR), CASE c WHEN 'zeta' THEN 1 ELSE 0 END, 'r:' || CASE c WHEN 'zeta' THEN text ELSE reverse(text) END FROM conversations, (VALUES ('zeta'), ('alpha')) v(c) WHERE role = 'assistant'""",
    "q77_verified_works": f"""
        WITH n(work_id, c) AS (SELECT conv_id, unnest(CASE conv_id % 4 WHEN 0 THEN ['zeta'] WHEN 1 THEN ['alpha', 'zeta'] WHEN 2 THEN ['alpha'] ELSE [] END) FROM (SELECT DISTINCT conv_id FROM conversations)),
             r AS (SELECT conv_id AS work_id, CASE role WHEN 'system' THEN 0 ELSE 1 END AS a, turn AS b, text AS t FROM conversations WHERE role <> 'assistant'
                   UNION ALL SELECT work_id, CASE c WHEN 'zeta' THEN 2 ELSE 3 END, turn, CASE c WHEN 'zeta' THEN 'intro ' || text ELSE reverse(text) END FROM conversations JOIN n ON conv_id = work_id WHERE role = 'assistant'),
             j AS (SELECT work_id, string_agg(t, '' ORDER BY a, b) AS t FROM r GROUP BY 1),
             x AS (SELECT DISTINCT work_id FROM n JOIN conversations ON conv_id = work_id WHERE c = 'zeta' AND role = 'assistant' AND work_id % 3 = 0)
        SELECT w.conv_id AS work_id, sha256(array_to_string({_LATIN_WORDS.format("coalesce(t, '')")}, ' ')) AS hash, w.conv_id NOT IN (SELECT work_id FROM x) AS same FROM (SELECT DISTINCT conv_id FROM conversations) w LEFT JOIN j ON w.conv_id = work_id""",
    "q79_directory_digests": """
        SELECT source AS dir, sha256(string_agg(lang || '/' || doc_id || '.md' || text, '' ORDER BY lang || '/' || doc_id || '.md')) AS hash, count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents GROUP BY 1""",
    "q80_coverage_gaps": """
        WITH e AS (SELECT conv_id, turn FROM conversations WHERE role = 'user' UNION SELECT conv_id, -1 FROM conversations UNION SELECT conv_id, 1000000001 FROM conversations),
             g AS (SELECT conv_id, turn AS n, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS m FROM e)
        SELECT conv_id AS doc_id, conv_id || '.0-1000000000' AS ref, CAST(n + 1 AS BIGINT) AS first, CAST(m - 1 AS BIGINT) AS last, CAST(m - n - 1 AS BIGINT) AS n FROM g WHERE m > n + 1""",
    "q81_lines_in_ranges": """
        WITH p AS (SELECT l_suppkey % 10 AS g, l_orderkey AS a, l_linenumber AS b FROM lineitem), r AS (SELECT o_custkey % 10 AS g, o_orderkey AS k, o_orderkey + o_orderkey % 40 AS e FROM orders)
        SELECT k AS o_orderkey, count(*) AS n, count(DISTINCT a * 100 + b) AS n_refs FROM r JOIN p ON r.g = p.g AND a BETWEEN k AND e AND (a > k OR b >= 2) AND (a < e OR b <= 3) GROUP BY 1""",
    "q82_trees": """
        WITH c AS (SELECT conv_id, coalesce(string_agg('"' || role || '"', ',' ORDER BY turn) FILTER (WHERE role = 'system'), '') AS own,
                          coalesce(string_agg('"' || turn || '":{"_passages":["' || role || '"],"_children":{}}', ',' ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS below FROM conversations GROUP BY 1)
        SELECT conv_id % 10 AS doc_id, '{' || string_agg('"' || conv_id || '":{"_passages":[' || own || '],"_children":{' || below || '}}', ',' ORDER BY conv_id) || '}' AS tree FROM c GROUP BY 1""",
    "q83_edit_log": """
        WITH e AS (SELECT conv_id AS w, turn AS t, text, CASE WHEN role <> 'assistant' THEN 'add' WHEN turn % 4 = 1 THEN 'update' WHEN turn % 4 = 3 THEN 'remove' ELSE 'comment' END AS action, role, CASE role WHEN 'system' THEN '0' ELSE CAST(turn % 3 AS VARCHAR) END AS ref FROM conversations),
             m AS (SELECT *, coalesce(last_value(CASE WHEN action <> 'update' THEN action END IGNORE NULLS) OVER (PARTITION BY w, ref ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'add', false) AS there FROM e WHERE role <> 'system' AND action <> 'comment'),
             v AS (SELECT *, CASE WHEN action = 'add' AND NOT there THEN t END AS born FROM m WHERE action = 'add' OR there),
             s AS (SELECT w, ref, max(born) AS born, arg_max(text, t) AS text FROM v GROUP BY 1, 2 HAVING arg_max(action, t) <> 'remove')
        SELECT w AS work_id, CAST(1 AS BIGINT) AS section, row_number() OVER (PARTITION BY w ORDER BY born) - 1 AS n, ref, text AS content FROM s
        UNION ALL SELECT w, 0, row_number() OVER (PARTITION BY w ORDER BY t) - 1, ref, text FROM e WHERE role = 'system'
        UNION ALL SELECT w, 3, row_number() OVER (PARTITION BY w ORDER BY t) - 1, ref, text FROM e WHERE action = 'comment'""",
    "q84_edit_problems": """
        WITH e AS (SELECT conv_id AS w, turn AS t, CASE WHEN role <> 'assistant' THEN 'add' WHEN turn % 4 = 1 THEN 'update' WHEN turn % 4 = 3 THEN 'remove' ELSE 'comment' END AS action, role, CAST(turn % 3 AS VARCHAR) AS ref FROM conversations),
             m AS (SELECT *, coalesce(last_value(CASE WHEN action <> 'update' THEN action END IGNORE NULLS) OVER (PARTITION BY w, ref ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'add', false) AS there FROM e WHERE role <> 'system' AND action <> 'comment'),
             s AS (SELECT w FROM m WHERE action = 'add' OR there GROUP BY w, ref HAVING arg_max(action, t) <> 'remove')
        SELECT w AS work_id, 'update_without_passage' AS problem, ref AS detail FROM m WHERE action = 'update' AND NOT there
        UNION ALL SELECT DISTINCT w, 'missing_field', 'canonical_title' FROM e WHERE w % 3 = 0
        UNION ALL SELECT DISTINCT w, 'no_passage', NULL FROM e WHERE w NOT IN (SELECT w FROM s)""",
    "q85_grammar_rules": """
        WITH k AS (SELECT conv_id * 1000 + turn AS doc_id, (conv_id + turn) % 10 AS kind, 't ' || regexp_replace(left(text, 20), '[^A-Za-z]', 'x', 'g') AS t FROM conversations),
             r(kind, line_num, rule_id, detail) AS (VALUES (1, 4, 'duplicate_ref', '1'), (2, 2, 'missing_meta', '1'), (3, 2, 'meta_without_commentary', '<!-- commentary: {"commentary_id": "c"} -->'), (4, 2, 'bad_meta', '<!-- commentary: {"x": 1} -->'),
                     (5, 3, 'bad_range', '3-1'), (6, 2, 'unrecognised', NULL), (7, 4, 'mismatched_end', 'devanagari'), (8, 4, 'unclosed_block', 'roman'), (9, 3, 'no_passage', '2'), (9, 3, 'no_passage', '3'))
        SELECT doc_id, CAST(line_num AS BIGINT) AS line_num, rule_id, coalesce(detail, t) AS detail FROM k JOIN r USING (kind)""",
    "q86_preservation": """
        WITH d AS (SELECT doc_id, text, 1 + doc_id % length(text) AS pos, doc_id % 5 AS kind FROM documents)
        SELECT doc_id, kind = 0 AS same, CAST(CASE WHEN kind = 1 THEN length(text) - pos + 1 ELSE 0 END AS BIGINT) AS length_diff, CASE WHEN kind > 0 THEN CAST(pos AS BIGINT) END AS first_difference FROM d""",
    "q87_json_repair": """
        SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'repaired' ELSE 'error' END AS status, CASE event_id % 3 WHEN 0 THEN 'a' || event_id WHEN 1 THEN '\\d+\\.' || event_id END AS pattern FROM events""",
    "q88_manifest_checksum": """
        WITH w AS (SELECT p_brand AS id, arg_min(p_name, (p_size <> 1, lpad(CAST(p_partkey AS VARCHAR), 9, '0'))) AS title, arg_min(p_size, (p_size <> 1, lpad(CAST(p_partkey AS VARCHAR), 9, '0'))) AS c FROM part GROUP BY 1),
             f AS (SELECT string_agg('{"path":"p/' || p_partkey || '","sha256":"' || sha256(p_name) || '","size_bytes":' || length(p_name) || '}', ',' ORDER BY 'p/' || p_partkey) AS j, count(*) AS n, CAST(sum(length(p_name)) AS BIGINT) AS b FROM part),
             g AS (SELECT string_agg('{"work_id":"' || id || '","title":"' || title || '"}', ',' ORDER BY id) AS j, count(*) AS n, CAST(sum(c) AS BIGINT) AS c FROM w)
        SELECT f.n AS n_files, f.b AS n_bytes, g.n AS n_works, g.c AS n_commentaries,
               sha256('{"version":"1.0.0","release_date":"2025-01-01","files":[' || f.j || '],"n_files":' || f.n || ',"n_bytes":' || f.b || ',"works":[' || g.j || '],"n_works":' || g.n || ',"n_commentaries":' || g.c || ',"checksum":""}') AS checksum FROM f, g""",
    "q89_chunk_estimates": """
        WITH d AS (SELECT doc_id, length(text) - length(replace(text, chr(10), '')) AS n, length(replace(text, chr(10), chr(10) || '**प्रथमः** **खण्डः**' || chr(10))) AS size FROM documents)
        SELECT doc_id, CAST(greatest(1, least(size // 500 + 1, CASE WHEN n > 0 THEN n ELSE 1 END)) AS BIGINT) AS n_chunks FROM d""",
    "q90_syllables": """
        WITH l AS (SELECT string_split('k kh g gh G c ch j jh J T Th D Dh N t th d dh n p ph b bh m y r l v z S s h L', ' ') AS c, string_split('a,,A,i,I,u,U,R,RR,lR,lRR,e,ai,o,au', ',') AS s)
        SELECT c[1 + o_orderkey % len(c)] || s[1 + o_custkey % len(s)] AS hk, count(*) AS n FROM orders, l GROUP BY 1""",
    "q91_directory_targets": """
        WITH f AS (SELECT DISTINCT '/lib/' || replace(p_brand, '#', '-') AS dir, CASE p_partkey % 3 WHEN 0 THEN 'part-' || p_partkey WHEN 1 THEN 'x-' || lpad(CAST(p_partkey % 97 AS VARCHAR), 2, '0') ELSE 'whole' END AS name,
                          CASE p_partkey % 3 WHEN 0 THEN p_partkey WHEN 1 THEN p_partkey % 97 ELSE 1 END AS part FROM part)
        SELECT dir, string_agg(dir || '/' || name || '.md', ' ' ORDER BY part, dir || '/' || name || '.md') AS files, count(*) > 1 AS multipart FROM f GROUP BY 1""",
    "q92_best_files": f"""
        WITH w AS (SELECT conv_id AS dir, printf('%06d.md', turn) AS name, array_to_string({_LATIN_WORDS.format("text")}, ' ') AS t FROM conversations)
        SELECT a.dir, a.name, min(b.name) AS match, 100.0::DOUBLE * 2 * length(any_value(a.t)) / (2 * length(any_value(a.t)) + 3) AS score, CAST(3 AS BIGINT) AS n_different FROM w a JOIN w b ON a.dir = b.dir AND a.t = b.t GROUP BY 1, 2""",
    "q93_content_hashes": f"""
        WITH d AS (SELECT doc_id, lang, text, doc_id % 2 = 0 AS old, array_to_string({_LATIN_WORDS.format("'lang ' || lang || CASE WHEN doc_id % 2 = 0 THEN ' grantha hash old ' ELSE ' ' END || text")}, '') AS t FROM documents)
        SELECT doc_id, CASE WHEN doc_id % 3 > 0 AND doc_id % 7 <= 5 THEN '---' || chr(10) || 'lang: ' || lang || chr(10) || 'grantha_hash: ' || sha256(t) || chr(10) || '---' || chr(10) || text END AS text FROM d""",
    "q94_repaired_anywhere": f"""
        WITH d AS (SELECT doc_id, {_LATIN_WORDS.format("text")} AS w FROM documents), n AS (SELECT doc_id, length(array_to_string(w, ' ')) AS a, len(w) AS m, length(w[1 + doc_id % len(w)]) AS x FROM d WHERE len(w) > 0),
             r AS (SELECT doc_id, CASE WHEN m = 1 THEN 0 ELSE 200.0::DOUBLE * (a - x - 1) / (2 * a - x - 1) END >= 85 AS ok FROM n)
        SELECT doc_id, ok AS success, ok AS restored FROM r""",
    "q95_nested_bodies": """
        WITH t AS (SELECT *, conv_id % 10 AS d, '<!-- sanskrit:devanagari -->' || chr(10) || chr(10) || text || chr(10) || chr(10) || '<!-- /sanskrit:devanagari -->' AS x FROM conversations WHERE text <> ''),
             f AS (SELECT d, 0 AS a, 0 AS p, 0 AS q, 0 AS s, conv_id * 1000 + turn AS n, '# Prefatory: ' || conv_id || ' (devanagari: "आदिः")' || chr(10) || x || chr(10) AS t FROM t WHERE role = 'system'
                   UNION ALL SELECT DISTINCT d, 1, conv_id, -1, 0, 0, '# Talk ' || conv_id || chr(10) FROM t WHERE role = 'user'
                   UNION ALL SELECT d, 1, conv_id, turn, 0, 0, '## Turn ' || conv_id || '.' || turn || chr(10) FROM t WHERE role = 'user'
                   UNION ALL SELECT d, 1, conv_id, turn, 1, conv_id * 1000 + turn, x || chr(10) FROM t WHERE role = 'user'
                   UNION ALL SELECT a.d, 1, a.conv_id, u.turn, 2, 0, '<!-- commentary: {"commentary_id": "c"} -->' || chr(10) || chr(10) || '### Commentary: ' || u.conv_id || '.' || u.turn || chr(10) || chr(10) || a.x || chr(10) || '<!-- /commentary: {"commentary_id": "c"} -->' || chr(10)
                             FROM t a JOIN t u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user' WHERE a.role = 'assistant')
        SELECT d AS doc_id, string_agg(t, chr(10) ORDER BY a, p, q, s, n) AS body FROM f GROUP BY 1""",
    "q78_schema_report": """
        SELECT 'prefatory_material.*' AS "where", 'required' AS keyword, count(*) AS n, count(DISTINCT conv_id) AS n_docs, min(conv_id) AS first FROM conversations WHERE role = 'system' AND conv_id % 3 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'part_num', 'maximum', count(*), count(*), min(conv_id) FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 6) HAVING count(*) > 0""",
    "q72_similar_addresses": f"""
        WITH t AS (SELECT url, min(page_id) AS id FROM pages WHERE url IS NOT NULL GROUP BY 1), {_ratio_sql("url", "t", "SELECT x.url AS a, y.url AS b FROM t x JOIN t y ON x.id < y.id")}
        SELECT x.id AS left_id, y.id AS right_id, score FROM scored JOIN t x ON x.url = a JOIN t y ON y.url = b WHERE score >= 85""",
    "q73_best_address": f"""
        WITH p AS (SELECT page_id, regexp_replace(url, '^https?://|[?#].*$', '', 'g') AS bare, url FROM pages WHERE url IS NOT NULL),
             {_ratio_sql("bare", "p", "SELECT DISTINCT x.bare AS a, y.url AS b FROM p x, p y")},
             best AS (SELECT a, arg_min(b, struct_pack(s := -score, i := id)) AS b, max(score) AS score FROM scored JOIN (SELECT url AS b, min(page_id) AS id FROM p GROUP BY 1) USING (b) WHERE score >= 70 GROUP BY 1)
        SELECT page_id AS left_id, (SELECT min(page_id) FROM p q WHERE q.url = b) AS right_id, score FROM p JOIN best ON a = bare""",
}
