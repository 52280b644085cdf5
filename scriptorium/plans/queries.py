"""Queries over the driver's tables for the structured-text operators, and SQL that gives the same rows.

The tables hold no text in the default script, so script operators run over Latin letters here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import markup, refs, script
from ..operators import chunk, fingerprint, link, render, rollup, rules, segment
from . import feature_queries, model, operator_queries

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q01_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = script.script_words(F.col("text"), script.LATIN)
    return _t(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("long").alias("n_words"), fingerprint.text_hash(F.col("text"), script.LATIN).alias("hash"))


def q02_clean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("html", "(?s)<!--.*?-->", " "), "<[^>]+>", ""), "[ \\t\\n\\r]+", " ")
    return _t(spark, sf_dir, "pages").select("page_id", F.btrim(text).alias("text"))


def q03_smart_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = markup.sampled(F.col("text"), 2000, 400, 200, 200, "[...]")
    return _t(spark, sf_dir, "documents").withColumn("s", s).select("doc_id", "s.text", "s.sampled")


def q04_cache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = rows.agg(F.max("ts")).scalar()
    return rows.select("event_id", model.cache_state(now, F.col("ts")).alias("state"))


def q05_normalise_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = script.text_stats(F.col("text"), script.LATIN)
    return _t(spark, sf_dir, "documents").select("doc_id", stats["total"].alias("n_total"), stats["distinct"].alias("n_distinct"))


def q06_duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"), F.octet_length("text").alias("length"))
    rows = fingerprint.file_hashes(files)
    return rows.groupBy(F.col("sha256").alias("hash")).agg(F.count("*").alias("n"), F.min("path").alias("first_doc")).where("n > 1")


def q07_range_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    have = turns.select("conv_id", F.concat(F.col("conv_id"), F.lit("."), F.col("turn")).alias("ref"))
    asked = turns.groupBy("conv_id").agg(F.concat(F.col("conv_id"), F.lit(".0-"), F.max("turn") + 1).alias("ref"))
    gaps = link.uncovered(asked, have, "conv_id")
    return gaps.select("conv_id", "member", refs.ref_key(F.col("member"))[1].cast("long").alias("turn"))


def q08_header_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.modes(_t(spark, sf_dir, "documents"), ["source"], "lang", F.col("doc_id"))


def _conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as structured text: system turns prefatory, user turns passages, assistant turns commentaries."""
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tagged = F.concat(F.lit("<!-- sanskrit:devanagari -->\n"), F.col("text"), F.lit("\n<!-- /sanskrit:devanagari -->"))
    ref = F.col("turn").cast("string")
    piece = (
        F.when(F.col("role") == "system", F.concat(F.lit("# Prefatory: "), ref, F.lit(' (devanagari: "s")\n'), tagged))
        .when(F.col("role") == "user", F.concat(F.lit("# Mantra "), ref, F.lit("\n"), tagged))
        .otherwise(F.concat(F.lit('<!-- commentary: {"commentary_id": "assistant"} -->\n# Commentary: '), ref, F.lit("\n"), tagged))
    )
    rows = turns.select("conv_id", F.lit(0).alias("section"), F.col("turn").alias("seq"), F.lit(0).alias("sub"), piece.alias("fragment"))
    return render.rendered(rows, "conv_id")


def _parsed_conversations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _conversation_documents(spark, sf_dir)
    levels = docs.select("conv_id", F.lit("Mantra").alias("level"), F.lit(True).alias("is_lowest"))
    declared = docs.select("conv_id", F.lit("assistant").alias("commentary_id"))
    return segment.parse_structured(docs, levels, declared, "conv_id")


def q09_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages, commentaries = _parsed_conversations(spark, sf_dir)
    text = F.element_at("content", F.lit("devanagari")).alias("text")
    turn = F.col("ref").cast("long").alias("turn")
    a = passages.select("conv_id", turn, F.col("passage_type").alias("kind"), text)
    return a.unionByName(commentaries.select("conv_id", turn, F.lit("commentary").alias("kind"), text))


def q10_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("ref"), "text", F.array("turn").alias("ref_key"), F.col("turn").alias("block"))
    answers = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("ref"), F.col("role").alias("commentary_id"), F.lit(0).alias("ord"), F.col("text").alias("content"))
    return link.interleaved(user, answers, "conv_id").select("conv_id", "ref", "text", "commentary")


def q11_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("idx"), "role", F.col("text").alias("content"))
    flagged = segment.with_prefatory(turns, F.col("role") == "user", "conv_id", F.lit(1))
    out = segment.paired(flagged.where("NOT is_prefatory"), F.col("role") == "user", F.col("role") == "assistant", "conv_id")
    return out.select("conv_id", F.col("idx").alias("turn"), "content", "commentary")


def q12_line_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.boundaries(_t(spark, sf_dir, "documents"), "doc_id", "text", [("the", 1, "^The "), ("number", 1, "[0-9]{4}")])
    return found.select("doc_id", "type", F.col("position").cast("long").alias("position"), F.col("line_number").cast("long").alias("line_number"), "marker_text")


def q12_boundary_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.boundary_chunks(_t(spark, sf_dir, "documents"), most=2000, patterns=[("the", 1, "^The "), ("any", 1, "^[A-Z]")])


def q13_plan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = F.array(*[F.struct(F.lit(k).alias("chunk_id"), F.lit("").alias("start_marker"), F.lit(". ").alias("end_marker")) for k in range(3)])
    rows = _t(spark, sf_dir, "documents").withColumn("c", chunk.plan_chunks(F.col("text"), plan))
    return rows.select("doc_id", F.size("c").cast("long").alias("n_chunks"), F.get("c", F.lit(0)).alias("first_chunk"))


def _order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return orders.select(F.col("o_custkey").alias("work_id"), F.row_number().over(w).alias("part_num"), F.col("o_orderstatus").alias("header"))


def q14_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rollup.envelopes(_order_parts(spark, sf_dir))
    return e.select("work_id", "header", "n_parts", "consecutive", F.array_join("files", ",").alias("files"))


def q14_part_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines_ = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.col("l_linenumber").alias("part_num"))
    return rollup.part_problems(lines_)


def q15_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.totals(_t(spark, sf_dir, "documents"), ["lang"], F.octet_length("text"))


def q16_reference_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    return link.reference_gaps(docs, labels, ["doc_id"])


def q16_header_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = [
        rules.Rule("short", "warning", F.length("text") < 200, "short text"),
        rules.Rule("digits", "warning", F.col("text").rlike("[0-9]{4}"), "long number"),
        rules.Rule("length", "error", F.col("n_chars") != F.length("text"), "wrong length"),
        rules.Rule("language", "error", ~F.col("lang").isin("en", "de", "fr"), "unknown language"),
    ]
    return rules.violations(_t(spark, sf_dir, "documents"), ["doc_id"], own).drop("message")


def q18_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.nearest(_t(spark, sf_dir, "benchmark"), _t(spark, sf_dir, "documents"), left_id="item_id", right_id="doc_id")


def q21_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fenced = F.concat(F.lit("Answer:\n```json\n"), F.col("props"), F.lit("\n```\n"))
    value = F.get_json_object(markup.json_block(fenced), "$.k")
    status = markup.parsed_json(markup.json_block(fenced))["status"]
    return _t(spark, sf_dir, "events").select("event_id", status.alias("status"), value.alias("k"))


def q22_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("(?s)<h1>(.*?)</h1>"), F.lit(1))
    return _t(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("idx", "content")).select("page_id", F.col("idx").cast("long").alias("idx"), "content")


def q23_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.concat((F.col("n_nationkey") % 3).cast("string"), F.lit("."), (F.col("n_nationkey") % 5).cast("string"), F.lit(".0"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", v.alias("version"), fingerprint.version_compatible(v, F.lit("1.2.0")).alias("compatible"))


def q24_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("ref"), "source", "doc_id")
    return link.last_by(rows, ["ref"], [F.col("source"), F.col("doc_id")])


def q25_conversation_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("work_id"), F.lit(0).alias("section"), F.col("turn").alias("seq"), "text")
    return fingerprint.work_hash(rows, chars=script.LATIN)


def q26_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the body of a marked text, cleaned."""
    marked = F.concat(F.lit("---\nid: x\n---\n# Heading 1\n**"), F.col("text"), F.lit("** <!-- note\nmore -->\n"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(markup.cleaned(marked), "[\\s\\x{00A0}]+", " ").alias("text"))


def q27_hidden_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("[note "), F.col("n_name"), F.lit("] and [link](x) and <!-- hide -->[old]<!-- /hide -->"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", markup.hide_notes(text).alias("text"))


def q28_ref_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.col("l_orderkey"), F.lit("."), F.col("l_linenumber")).alias("ref"))
    inside = refs.in_range(F.col("ref"), F.lit("100.2"), F.lit("2000.3"))
    side = refs.compare_refs(F.col("ref"), F.lit("1000.1")).cast("long")
    return rows.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), inside.alias("inside"), side.alias("side"))


def q29_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").select((F.col("conv_id") % 10).alias("doc_id"), F.concat(F.col("conv_id"), F.lit("."), F.col("turn")).alias("ref"))
    h = segment.hierarchy(rows)
    return h.select("doc_id", F.array_join("node", ".").alias("node"), F.col("depth").cast("long").alias("depth"), "n_passages")


def q30_directory_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.documents import part_number

    name = F.concat(F.lit("work-"), F.lpad((F.col("p_partkey") % 40).cast("string"), 2, "0"), F.lit(".md"))
    return _t(spark, sf_dir, "part").select("p_partkey", part_number(name).cast("long").alias("part_num"))


def q31_point_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").select((F.col("conv_id") % 7).alias("doc_id"), F.concat(F.col("conv_id"), F.lit("."), F.col("turn")).alias("ref"))
    ranges = turns.select("doc_id").distinct().select("doc_id", F.lit("2.1").alias("start"), F.lit("9.0").alias("end"))
    return link.containing(turns, ranges).select("doc_id", "ref")


def q32_zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _t(spark, sf_dir, "nation").select("n_regionkey", F.col("n_name").alias("name"))
    return link.zipped(a.where("n_nationkey % 2 = 0"), a.where("n_nationkey % 2 = 1"), by=["n_regionkey"]).withColumn("n", F.col("n").cast("long"))


def q33_still_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stem"))
    outputs = _t(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("stem"), F.col("quality").alias("size"))
    return link.still_to_do(inputs, outputs)


def q34_verse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    native = F.translate(F.col("l_linenumber").cast("string"), "0123456789", script.NATIVE_DIGITS)
    text = F.concat(F.lit("x ॥ "), native, F.lit(" ॥"))
    return _t(spark, sf_dir, "lineitem").groupBy(script.verse_number(text).cast("long").alias("number")).agg(F.count("*").alias("n"))


def q35_line_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _conversation_documents(spark, sf_dir)
    found = rules.line_grammar(docs, "conv_id")
    return found.groupBy("conv_id", "rule_id").agg(F.count("*").alias("n"))


def q36_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    cache = docs.where("doc_id % 3 = 0").select("hash", F.col("doc_id").alias("uploaded")).groupBy("hash").agg(F.max("uploaded").alias("uploaded"))
    return link.cache_hits(docs, cache, ["hash"], F.col("uploaded") >= 100)


def q37_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = markup.prompt(F.lit("Convert {name} in region {region}."), F.create_map(F.lit("name"), F.col("n_name"), F.lit("region"), F.col("n_regionkey").cast("string")))
    return _t(spark, sf_dir, "nation").select("n_nationkey", filled.alias("prompt"))


def q38_first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("text"), F.overlay("text", F.lit("#"), F.lit(6))
    p = rules.preservation(a, b)
    return _t(spark, sf_dir, "benchmark").select("item_id", p["same"].alias("same"), p["first_difference"].cast("long").alias("first_difference"))


def queries() -> dict[str, Query]:
    """Every registered query of the structured-text engine."""
    return {k: f for k, f in globals().items() if k.startswith("q") and k[1:3].isdigit()} | operator_queries.queries() | feature_queries.queries()


_WORDS = "regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')"
#: White space as Unicode has it.
_SPACES = "\\x09-\\x0D\\x20\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
ORACLES = {
    "q01_fingerprint": f"SELECT doc_id, CAST(len({_WORDS}) AS BIGINT) AS n_words, sha256(array_to_string({_WORDS}, ' ')) AS hash FROM documents",
    "q02_clean_page": "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', '', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS text FROM pages",
    "q03_smart_sample": """
        SELECT doc_id, CASE WHEN length(text) > 2000 THEN substring(text, 1, 400) || '[...]' || substring(text, (length(text) - 200) // 2 + 1, 200) || '[...]' || substring(text, length(text) - 199, 200) ELSE text END AS text,
               length(text) > 2000 AS sampled FROM documents""",
    "q04_cache_state": """
        SELECT event_id, CASE WHEN age < 46 THEN 'fresh' WHEN age < 48 THEN 'validate' ELSE 'expired' END AS state
        FROM (SELECT event_id, (epoch_us(max(ts) OVER ()) - epoch_us(ts)) / 3.6e9 AS age FROM events)""",
    "q05_normalise_stats": f"""
        SELECT doc_id, CAST(length(t) AS BIGINT) AS n_total, CAST(CASE WHEN t = '' THEN 0 ELSE len(list_distinct(string_split(t, ''))) END AS BIGINT) AS n_distinct
        FROM (SELECT doc_id, array_to_string({_WORDS}, '') AS t FROM documents)""",
    "q06_duplicate_content": "SELECT sha256(text) AS hash, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1",
    "q07_range_cover": """
        SELECT c.conv_id, c.conv_id || '.' || t.turn AS member, t.turn AS turn
        FROM (SELECT conv_id, max(turn) + 1 AS m FROM conversations GROUP BY 1) c, LATERAL (SELECT unnest(range(0, c.m + 1)) AS turn) t
        WHERE NOT EXISTS (SELECT 1 FROM conversations x WHERE x.conv_id = c.conv_id AND x.turn = t.turn)""",
    "q08_header_mode": """
        SELECT source, arg_max(lang, (n, -f)) AS lang, max(n) AS n, CAST(sum(n) - max(n) AS BIGINT) AS deviating
        FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1, 2) GROUP BY 1""",
    "q09_parse_roundtrip": "SELECT conv_id, turn, CASE role WHEN 'system' THEN 'prefatory' WHEN 'user' THEN 'main' ELSE 'commentary' END AS kind, text FROM conversations",
    "q10_interleave": """
        SELECT u.conv_id, u.turn AS ref, u.text, a.text AS commentary FROM conversations u
        LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'""",
    "q11_pairing": """
        SELECT conv_id, turn, content, commentary FROM (
          SELECT conv_id, turn, role, text AS content, CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS commentary
          FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user'""",
    "q12_line_offsets": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_number FROM documents),
             p AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position FROM l)
        SELECT doc_id, 'the' AS type, position, line_number, regexp_extract(line, '^The ') AS marker_text FROM p WHERE regexp_matches(line, '^The ')
        UNION ALL SELECT doc_id, 'number', position, line_number, regexp_extract(line, '[0-9]{4}') FROM p WHERE regexp_matches(line, '[0-9]{4}')""",
    "q12_boundary_chunks": """
        WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM documents),
             p AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM l),
             c AS (SELECT doc_id, list(pos ORDER BY pos) FILTER (WHERE regexp_matches(line, '^The ')) AS a, list(pos ORDER BY pos) FILTER (WHERE regexp_matches(line, '^[A-Z]')) AS b FROM p GROUP BY 1),
             d AS (SELECT doc_id, coalesce(a, b, []) AS cuts FROM documents LEFT JOIN c USING (doc_id)),
             walk AS (SELECT doc_id, 0 AS i, CAST(0 AS BIGINT) AS start, CAST(NULL AS BIGINT) AS since, CAST(NULL AS BIGINT) AS until FROM d
                      UNION ALL SELECT doc_id, i + 1, CASE WHEN cut THEN pos ELSE start END, CASE WHEN cut THEN start END, CASE WHEN cut THEN pos END
                      FROM (SELECT doc_id, i, start, cuts[i + 1] AS pos, cuts[i + 1] > start AND (cuts[i + 1] - start >= 2000 OR i + 1 = len(cuts)) AS cut FROM walk JOIN d USING (doc_id) WHERE i < len(cuts))),
             spans AS (SELECT doc_id, since, until FROM walk WHERE until IS NOT NULL UNION ALL SELECT doc_id, start, NULL FROM walk JOIN d USING (doc_id) WHERE i = len(cuts)),
             raw AS (SELECT doc_id, since, CASE WHEN until IS NULL THEN substring(text, since + 1) ELSE substring(text, since + 1, until - since) END AS t FROM spans JOIN documents USING (doc_id)),
             kept AS (SELECT doc_id, since, CASE WHEN since = 0 THEN t ELSE trim(t, ' ' || chr(9) || chr(10) || chr(13)) END AS content FROM raw WHERE trim(t, ' ' || chr(9) || chr(10) || chr(13)) <> '')
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY since) - 1 AS INTEGER) AS chunk, CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS n_chunks, CAST(length(content) AS INTEGER) AS size, content FROM kept""",
    "q13_plan_split": """
        WITH a AS (SELECT doc_id, text, instr(text, '. ') AS p FROM documents),
             b AS (SELECT *, CASE WHEN p = 0 THEN '' ELSE substring(text, p + 2) END AS r1 FROM a),
             c AS (SELECT *, instr(r1, '. ') AS p1 FROM b),
             d AS (SELECT *, CASE WHEN p1 = 0 THEN '' ELSE substring(r1, p1 + 2) END AS r2 FROM c)
        SELECT doc_id, CAST(CASE WHEN trim(text) = '' THEN 0 WHEN trim(r1, chr(10) || ' ') = '' THEN 1 WHEN trim(r2, chr(10) || ' ') = '' THEN 2 ELSE 3 END AS BIGINT) AS n_chunks,
               CASE WHEN p = 0 THEN text ELSE substring(text, 1, p + 1) END AS first_chunk FROM d""",
    "q14_envelope": """
        WITH p AS (SELECT o_custkey AS work_id, o_orderstatus AS header, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)
        SELECT work_id, arg_min(header, n) AS header, count(*) AS n_parts, true AS consecutive, string_agg('part' || n || '.json', ',' ORDER BY n) AS files FROM p GROUP BY 1""",
    "q14_part_problems": """
        WITH h AS (SELECT l_orderkey AS work_id, CAST(l_linenumber AS BIGINT) AS part_num FROM lineitem),
             w AS (SELECT work_id, unnest(range(1, n + 1)) AS part_num FROM (SELECT work_id, count(*) AS n FROM h GROUP BY 1))
        SELECT work_id, part_num, 'missing' AS problem FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.work_id = w.work_id AND h.part_num = w.part_num)
        UNION ALL SELECT DISTINCT work_id, part_num, 'extra' FROM h WHERE NOT EXISTS (SELECT 1 FROM w WHERE h.work_id = w.work_id AND h.part_num = w.part_num)
        UNION ALL SELECT work_id, part_num, 'duplicate' FROM h GROUP BY 1, 2 HAVING count(*) > 1""",
    "q15_totals": "SELECT lang, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY ROLLUP (lang)",
    "q16_reference_gaps": """
        SELECT doc_id, 'undeclared' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT doc_id, 'unused' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
    "q16_header_rules": """
        SELECT doc_id, 'short' AS rule_id, 'warning' AS severity FROM documents WHERE length(text) < 200
        UNION ALL SELECT doc_id, 'digits', 'warning' FROM documents WHERE regexp_matches(text, '[0-9]{4}')
        UNION ALL SELECT doc_id, 'length', 'error' FROM documents WHERE n_chars <> length(text)
        UNION ALL SELECT doc_id, 'language', 'error' FROM documents WHERE lang NOT IN ('en', 'de', 'fr')""",
    "q21_json_fields": "SELECT event_id, 'ok' AS status, json_extract_string(props, '$.k') AS k FROM events",
    "q22_html_blocks": """
        SELECT page_id, unnest(range(0, len(f))) AS idx, unnest(f) AS content FROM (SELECT page_id, regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1) AS f FROM pages)""",
    "q23_versions": """
        SELECT n_nationkey, v AS version, CAST(split_part(v, '.', 1) AS INT) = 1 AND CAST(split_part(v, '.', 2) AS INT) >= 2 AS compatible
        FROM (SELECT n_nationkey, (n_nationkey % 3) || '.' || (n_nationkey % 5) || '.0' AS v FROM nation)""",
    "q24_routing": """
        SELECT ref, source, doc_id FROM (SELECT sha256(text) AS ref, source, doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY source DESC, doc_id DESC) AS n FROM documents) WHERE n = 1""",
    "q25_conversation_hash": f"""
        SELECT work_id, sha256(array_to_string({_WORDS}, ' ')) AS hash, n_records
        FROM (SELECT conv_id AS work_id, string_agg(text, '' ORDER BY turn) AS text, count(*) AS n_records FROM conversations GROUP BY 1)""",
    "q26_cleaned": f"""
        WITH m AS (SELECT doc_id, chr(10) || '# Heading 1' || chr(10) || '**' || text || '** <!-- note' || chr(10) || 'more -->' AS t FROM documents),
             h AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?m)^#+[{_SPACES}]+.*$', '', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS t FROM m)
        SELECT doc_id, trim(regexp_replace(replace(t, '**', ''), '[{_SPACES}]+', ' ', 'g')) AS text FROM h""",
    "q27_hidden_notes": "SELECT n_nationkey, '<!-- hide -->[note ' || n_name || ']<!-- /hide --> and [link](x) and <!-- hide -->[old]<!-- /hide -->' AS text FROM nation",
    "q28_ref_order": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, (l_orderkey, l_linenumber) >= (100, 2) AND (l_orderkey, l_linenumber) <= (2000, 3) AS inside,
               CAST(CASE WHEN (l_orderkey, l_linenumber) < (1000, 1) THEN -1 WHEN (l_orderkey, l_linenumber) > (1000, 1) THEN 1 ELSE 0 END AS BIGINT) AS side FROM lineitem""",
    "q29_hierarchy": """
        SELECT conv_id % 10 AS doc_id, CAST(conv_id AS VARCHAR) AS node, CAST(1 AS BIGINT) AS depth, CAST(0 AS BIGINT) AS n_passages FROM conversations GROUP BY 1, 2
        UNION ALL SELECT conv_id % 10, conv_id || '.' || turn, 2, count(*) FROM conversations GROUP BY 1, 2""",
    "q30_directory_parts": "SELECT p_partkey, CAST(p_partkey % 40 AS BIGINT) AS part_num FROM part",
    "q31_point_in_range": "SELECT conv_id % 7 AS doc_id, conv_id || '.' || turn AS ref FROM conversations WHERE (conv_id > 2 OR conv_id = 2 AND turn >= 1) AND (conv_id < 9 OR conv_id = 9 AND turn <= 0)",
    "q32_zipped": """
        WITH a AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS n FROM nation WHERE n_nationkey % 2 = 0),
             b AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS n FROM nation WHERE n_nationkey % 2 = 1)
        SELECT a.n_regionkey, a.n, a.n_name AS left_name, b.n_name AS right_name FROM a JOIN b ON a.n_regionkey = b.n_regionkey AND a.n = b.n""",
    "q33_still_to_do": "SELECT CAST(doc_id AS VARCHAR) AS stem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality > 0)",
    "q34_verse_numbers": "SELECT CAST(l_linenumber AS BIGINT) AS number, count(*) AS n FROM lineitem GROUP BY 1",
    "q35_line_grammar": "SELECT conv_id, 'no_passage' AS rule_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1",
    "q36_cached": """
        WITH d AS (SELECT doc_id, sha256(text) AS hash FROM documents)
        SELECT hash, doc_id FROM d WHERE hash IN (SELECT hash FROM d WHERE doc_id % 3 = 0 GROUP BY 1 HAVING max(doc_id) >= 100)""",
    "q37_prompts": "SELECT n_nationkey, 'Convert ' || n_name || ' in region ' || n_regionkey || '.' AS prompt FROM nation",
    "q38_first_difference": "SELECT item_id, text = left(text, 5) || '#' || substring(text, 7) AS same, CASE WHEN substring(text, 6, 1) <> '#' THEN CAST(6 AS BIGINT) END AS first_difference FROM benchmark",
}
ORACLES |= operator_queries.ORACLES | feature_queries.ORACLES
