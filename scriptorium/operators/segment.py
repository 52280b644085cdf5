"""Segmentation: structured text into passages and commentaries, HTML details, boundaries, hierarchies.

Lines come from ``posexplode``; everything after is a window over a document's lines, so one shuffle by
document serves the whole parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markup import script_blocks
from ..functions.refs import ref_key
from ..functions.script import strip, verse_number

#: The line forms of the structured format.
HEADING = "(?U)^#+\\s+([^:]+?)\\s+([\\d.]+)$"
LABELLED = '(?U)(?i)^#\\s+{}:\\s+([\\d.]+)\\s+\\((\\w+):\\s*"(.*?)"\\)$'
COMMENTARY = "(?U)(?i)^#+\\s+Commentary:\\s+([\\d.]+)$"
COMMENTARY_RANGED = "(?U)(?i)^#+\\s+Commentary:\\s+([\\d.]+(?:-[\\d.]+)?)$"
META = "<!--\\s*commentary:\\s*(\\{.*?\\})\\s*-->"


def lines(docs: DataFrame, key: str = "doc_id", text: str = "body") -> DataFrame:
    """(key, pos, line) of every line."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def parse_structured(docs: DataFrame, levels: DataFrame, declared: DataFrame, key: str = "doc_id", body: str = "body", strict_reference: bool = True) -> tuple[DataFrame, DataFrame]:
    """(passages, commentary passages) of structured documents.

    ``levels``: (key, level, is_lowest), the headings each document declares; ``declared``: (key, commentary_id).
    Headings, commentary headings and commentary metadata end a block; a block's text is what stands up to the next,
    stripped.  Only headings of the lowest level make main passages.  A passage without content is
    dropped, a commentary passage is kept.  A commentary heading takes the metadata that stands
    last before it and was not taken; without metadata, or if the metadata names no declared
    commentary, it is dropped.  ``strict_reference=False`` also reads ranged references.
    """
    source = docs.select(key, F.regexp_replace(F.col(body), f"(?s)({META})", "\n$1\n").alias("_text"))
    rows = lines(source, key, "_text")
    line = strip(F.col("line"))
    name = F.lower(F.regexp_extract(line, HEADING, 1))
    marked = rows.withColumn("line_", line).withColumn("level", name)
    known = levels.select(F.col(key), F.lower("level").alias("level"), "is_lowest").groupBy(key, "level").agg(F.max("is_lowest").alias("is_lowest"))
    # the level lists are small, the lines are not: only heading lines need the join
    is_heading = marked.where("level <> ''").join(known, [key, "level"]).select(key, "pos", "is_lowest")
    marked = marked.join(is_heading, [key, "pos"], "left")
    comment = COMMENTARY if strict_reference else COMMENTARY_RANGED
    kind = (
        F.when(F.col("line_").rlike(f"^{META}$"), "meta")
        .when(F.col("line_").rlike(comment), "commentary")
        .when(F.col("line_").rlike(LABELLED.format("Prefatory")), "prefatory")
        .when(F.col("line_").rlike(LABELLED.format("Concluding")), "concluding")
        .when(F.col("is_lowest"), "main")
        .when(F.col("is_lowest").isNotNull(), "higher")
    )
    marked = marked.withColumn("kind", kind)
    order = Window.partitionBy(key).orderBy("pos")
    block = F.sum(F.col("kind").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    blocks = (
        marked.withColumn("block", block)
        .where("block > 0")
        .groupBy(key, "block")
        .agg(
            F.min_by("kind", "pos").alias("kind"),
            F.min_by("line_", "pos").alias("head"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind").isNull(), F.struct("pos", "line")))), lambda x: x["line"]), "\n").alias("text"),
        )
    )
    at = Window.partitionBy(key).orderBy("block")
    # metadata waits for the next commentary heading; headings between leave it waiting
    events = blocks.where("kind IN ('meta', 'commentary')")
    events = events.withColumn("meta", F.when(F.lag("kind").over(at) == "meta", F.regexp_extract(F.lag("head").over(at), META, 1)))
    commentary_id = F.get_json_object("meta", "$.commentary_id")
    taken = events.where("kind = 'commentary'").withColumn("commentary_id", commentary_id)
    commentaries = taken.join(declared.select(key, "commentary_id").distinct(), [key, "commentary_id"]).select(
        key, "commentary_id", F.regexp_extract("head", comment, 1).alias("ref"), "block", script_blocks(strip(F.col("text"))).alias("content")
    )
    label = lambda k, n: F.regexp_extract("head", LABELLED.format(k), n)
    both = lambda n: F.when(F.col("kind") == "prefatory", label("Prefatory", n)).when(F.col("kind") == "concluding", label("Concluding", n))
    passages = (
        blocks.where("kind IN ('main', 'prefatory', 'concluding')")
        .withColumn("body_", strip(F.col("text")))
        .where(strip(F.regexp_replace("body_", "(?s)<!--.*?-->", "")) != "")
        .select(
            key,
            F.col("kind").alias("passage_type"),
            F.coalesce(both(1), F.regexp_extract("head", HEADING, 2)).alias("ref"),
            "block",
            F.when(both(2).isNotNull(), F.create_map(both(2), both(3))).alias("label"),
            script_blocks(F.col("body_")).alias("content"),
        )
        .withColumn("ref_key", ref_key(F.col("ref")))
    )
    return passages, commentaries


DETAILS = "(?s)<details( open)?>\\s*<summary>(.*?)</summary>(.*?)</details>"


def details_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, idx, summary, content, is_open, start_line) of every HTML details block."""
    c = F.col(text)
    found = F.regexp_extract_all(c, F.lit(DETAILS), F.lit(0))
    return (
        docs.select(key, c.alias("_t"), F.posexplode(found).alias("idx", "block"))
        .withColumn("is_open", F.startswith("block", F.lit("<details open>")))
        .withColumn("_gap", F.get(F.split(F.col("_t"), "(?s)<details(?: open)?>\\s*<summary>.*?</details>"), F.col("idx")))
        .withColumn("_lines", F.length(F.regexp_replace("_gap", "[^\\n]", "")))
        .withColumn("_own", F.length(F.regexp_replace("block", "[^\\n]", "")))
        .withColumn("start_line", 1 + F.sum(F.col("_lines")).over(_upto(key)) + F.coalesce(F.sum("_own").over(_upto(key, -1)), F.lit(0)))
        .select(key, "idx", strip(F.regexp_extract("block", DETAILS, 2)).alias("summary"), strip(F.regexp_extract("block", DETAILS, 3)).alias("content"), "is_open", "start_line")
    )


def _upto(key: str, last: int = 0):
    return Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, last)


def with_prefatory(blocks: DataFrame, is_text: Column, key: str = "doc_id", number: Column | None = None) -> DataFrame:
    """Flags blocks before the first text block numbered 1; without such a block none is prefatory."""
    number = verse_number(F.col("content")) if number is None else number
    first = F.min(F.when(is_text & (number == 1), F.col("idx"))).over(Window.partitionBy(key))
    return blocks.withColumn("is_prefatory", F.coalesce(F.col("idx") < first, F.lit(False)))


def paired(blocks: DataFrame, is_text: Column, is_comment: Column, key: str = "doc_id") -> DataFrame:
    """Every text block with the commentary that follows it at once, else null."""
    w = Window.partitionBy(key).orderBy("idx")
    follows = blocks.withColumn("commentary", F.lead(F.when(is_comment, F.col("content"))).over(w))
    return follows.where(is_text)


#: Ordinals and division words, in the order in which they are tried.
ORDINALS = (
    "प्रथम द्वितीय द्वितीया तृतीय तृतीया चतुर्थ चतुर्थी पञ्चम पञ्चमी षष्ठ षष्ठी सप्तम सप्तमी अष्टम अष्टमी नवम नवमी दशम दशमी"
    " एकादश द्वादश त्रयोदश चतुर्दश पञ्चदश षोडश"
).split()
_ANY = "|".join(ORDINALS)
#: Types of boundaries, the order in which their patterns are tried, and the patterns.
BOUNDARIES = [
    ("khanda", 1, f"\\*\\*({_ANY})[ःोम]?\\*\\*\\s+\\*\\*खण्ड[ःम]\\*\\*"),
    ("khanda", 2, f"\\*\\*({_ANY})[ःोम]?\\s*खण्ड[ःम]\\*\\*"),
    ("khanda", 3, "\\*\\*खण्ड[ःम]\\s*\\d+\\*\\*"),
    ("valli", 1, f"\\*\\*({_ANY})[ाी]?\\*\\*\\s+\\*\\*वल्ली\\*\\*"),
    ("valli", 2, f"\\*\\*({_ANY})[ाी]?\\s*वल्ली\\*\\*"),
    ("valli", 3, "\\*\\*वल्ली\\s*\\d+\\*\\*"),
    ("anuvaka", 1, f"\\*\\*({_ANY})ोऽनुवाक[ःम]\\*\\*"),
    ("anuvaka", 2, "\\*\\*अनुवाक[ःम]\\s*\\d+\\*\\*"),
    ("prapathaka", 1, f"\\*\\*({_ANY})[ःोम]?\\*\\*\\s+\\*\\*प्रपाठक[ःम]\\*\\*"),
    ("prapathaka", 2, f"\\*\\*({_ANY})[ःोम]?\\s*प्रपाठक[ःम]\\*\\*"),
    ("prapathaka", 3, "\\*\\*प्रपाठक[ःम]\\s*\\d+\\*\\*"),
]


def boundaries(docs: DataFrame, key: str = "doc_id", text: str = "text", patterns: list[tuple[str, int, str]] = BOUNDARIES) -> DataFrame:
    """(key, type, position, line_number, marker_text, ordinal): for each line and type the first pattern that matches.

    Positions count code points from the start of the text.
    """
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = lines(docs, key, text).withColumn("position", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)))
    kinds = dict.fromkeys(k for k, _, _ in patterns)
    found = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(k).alias("type"), F.coalesce(*[F.when(F.regexp_extract("line", f"(?U){p}", 0) != "", F.regexp_extract("line", f"(?U){p}", 0)) for t, _, p in patterns if t == k]).alias("marker_text"))
        for i, k in enumerate(kinds)
    ])
    hits = rows.select(key, "pos", "position", F.explode(F.filter(found, lambda x: x["marker_text"].isNotNull())).alias("b"))
    ordinal = F.get(F.filter(F.array(*map(F.lit, ORDINALS)), lambda o: F.contains(F.col("b.marker_text"), o)), F.lit(0))
    return hits.select(key, "b.type", "position", (F.col("pos") + 1).alias("line_number"), "b.marker_text", ordinal.alias("ordinal"), F.col("b.rank").alias("rank"))


def hierarchy(passages: DataFrame, key: str = "doc_id", ref: str = "ref") -> DataFrame:
    """(key, node, parent, depth, n_passages): every level above the passages, in the order of ``node``."""
    k = ref_key(F.col(ref))
    nodes = passages.withColumn("_k", k).select(key, "_k", F.explode(F.sequence(F.lit(1), F.size("_k"))).alias("depth"))
    node = F.slice("_k", F.lit(1), F.col("depth"))
    return (
        nodes.select(key, node.alias("node"), F.slice("_k", F.lit(1), F.col("depth") - 1).alias("parent"), "depth", (F.col("depth") == F.size("_k")).cast("int").alias("leaf"))
        .groupBy(key, "node", "parent", "depth")
        .agg(F.sum("leaf").alias("n_passages"))
    )
