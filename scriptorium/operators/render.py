"""Rendering of passage tables to structured text and JSON, and edits of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.refs import ref_key
from ..functions.script import DEVANAGARI
from .fingerprint import HASH_VERSION, text_hash
from .link import last_by

SCRIPTS = ("devanagari", "roman", "kannada")


def content_lines(content: Column, scripts: tuple[str, ...] = SCRIPTS, closed: bool = True) -> Column:
    """A passage's text between script tags, the scripts in their fixed order."""
    one = lambda s: F.when(
        F.try_element_at(content, F.lit(s)).isNotNull(),
        F.concat(F.lit(f"<!-- sanskrit:{s} -->\n"), F.element_at(content, F.lit(s)), F.lit(f"\n<!-- /sanskrit:{s} -->" if closed else "")),
    )
    return F.concat_ws("\n", *[one(s) for s in SCRIPTS if s in scripts])


def passage_text(level: str = "Mantra") -> Column:
    """A passage row (passage_type, ref, label, content) as heading and content."""
    script = F.get(F.map_keys("label"), F.lit(0))
    title = F.concat(script, F.lit(': "'), F.element_at("label", script), F.lit('")'))
    head = F.when(F.col("passage_type") == "main", F.concat(F.lit(f"# {level} "), F.col("ref"))).otherwise(F.concat(F.lit("# "), F.initcap("passage_type"), F.lit(": "), F.col("ref"), F.lit(" ("), title))
    return F.concat(head, F.lit("\n"), content_lines(F.col("content")))


def commentary_text(depth: int = 1) -> Column:
    """A commentary row (commentary_id, ref, content): metadata, heading, content."""
    meta = F.concat(F.lit("<!-- commentary: "), F.to_json(F.struct("commentary_id")), F.lit(" -->\n"))
    return F.concat(meta, F.lit("#" * depth + " Commentary: "), F.col("ref"), F.lit("\n"), content_lines(F.col("content")))


def rendered(fragments: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ("section", "seq", "sub"), text: str = "fragment") -> DataFrame:
    """(key, body): a document's fragments in order with an empty line between."""
    parts = F.array_sort(F.collect_list(F.struct(*order, text)))
    return fragments.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x[text]), "\n\n").alias("body"))


def document_fragments(passages: DataFrame, commentaries: DataFrame, key: str = "doc_id", level: str = "Mantra") -> DataFrame:
    """(key, section, seq, sub, fragment) of passages with their commentaries after them.

    ``passages``: (key, passage_type, ref, label, content, seq); ``commentaries``: (key, ref, commentary_id, content, ord).
    Prefatory passages come first, concluding ones last; commentaries without a passage vanish.
    """
    section = F.when(F.col("passage_type") == "prefatory", 0).when(F.col("passage_type") == "main", 1).otherwise(2)
    rows = passages.select(key, section.alias("section"), "seq", F.lit(0).alias("sub"), "ref", passage_text(level).alias("fragment"))
    notes = commentaries.select(key, "ref", (F.col("ord") + 1).alias("sub"), commentary_text().alias("fragment"))
    placed = notes.join(rows.where("section < 2").groupBy(key, "ref").agg(F.min(F.struct("section", "seq")).alias("at")), [key, "ref"])
    return rows.drop("ref").unionByName(placed.select(key, "at.section", "at.seq", "sub", "fragment"))


def _spaced(content: Column, scripts: tuple[str, ...]) -> Column:
    """A passage's non-empty texts between script tags, an empty line on either side of each."""
    one = lambda s: F.when(F.try_element_at(content, F.lit(s)) != "", F.concat(F.lit(f"<!-- sanskrit:{s} -->\n\n"), F.element_at(content, F.lit(s)), F.lit(f"\n\n<!-- /sanskrit:{s} -->")))
    return F.concat_ws("\n", *[one(s) for s in SCRIPTS if s in scripts])


def nested_body(passages: DataFrame, commentaries: DataFrame, levels: list[str], key: str = "doc_id", scripts: tuple[str, ...] = SCRIPTS) -> DataFrame:
    """(key, body): the nested form, with a heading for every level and closed commentary tags.

    ``passages``: (key, passage_type, ref, label, content, seq); ``commentaries``: (key, ref, commentary_id, content, ord);
    ``levels``: names from the top down.  A heading has as many marks as its level is deep; main passages stand
    at references of the lowest level or deeper, a commentary's heading is one deeper; levels beyond the last have its name.
    """
    names, depth = F.array(*map(F.lit, levels)), F.size("node")
    main = passages.where("passage_type = 'main'").withColumn("path", ref_key(F.col("ref")))
    nodes = main.select(key, F.explode(F.sequence(F.lit(1), F.size("path"))).alias("n"), "path").select(key, F.slice("path", F.lit(1), F.col("n")).alias("node")).distinct()
    name = F.element_at(names, F.least(depth, F.lit(len(levels))))
    place = lambda section, path, sub, seq: (F.lit(section).alias("section"), path.alias("path"), F.lit(sub).alias("sub"), seq.cast("long").alias("seq"))
    headings = nodes.select(key, *place(1, F.col("node"), 0, F.lit(0)), F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), name, F.lit(" "), F.array_join(F.col("node").cast("array<string>"), "."), F.lit("\n")).alias("fragment"))
    deep = main.where(F.size("path") >= len(levels))
    texts = deep.select(key, *place(1, F.col("path"), 1, F.col("seq")), F.concat(_spaced(F.col("content"), scripts), F.lit("\n")).alias("fragment"))
    tag = lambda slash: F.concat(F.lit(f'<!-- {slash}commentary: {{"commentary_id": "'), F.col("commentary_id"), F.lit('"} -->'))
    head = F.concat(tag(""), F.lit("\n\n"), F.repeat(F.lit("#"), F.size("path") + 1), F.lit(" Commentary: "), F.col("ref"), F.lit("\n\n"))
    noted = F.concat(head, F.concat_ws("\n", F.nullif(_spaced(F.col("content"), scripts), F.lit("")), tag("/")), F.lit("\n"))
    notes = commentaries.join(deep.select(key, "ref", "path").distinct(), [key, "ref"]).select(key, *place(1, F.col("path"), 2, F.col("ord")), noted.alias("fragment"))
    title = F.concat(F.lit("# "), F.initcap("passage_type"), F.lit(": "), F.col("ref"), F.lit(' (devanagari: "'), F.coalesce(F.try_element_at("label", F.lit("devanagari")), F.lit("")), F.lit('")\n'))
    around = passages.where("passage_type <> 'main'").select(
        key, F.when(F.col("passage_type") == "prefatory", 0).otherwise(2).alias("section"), F.array().cast("array<int>").alias("path"), F.lit(0).alias("sub"), F.col("seq").cast("long").alias("seq"),
        F.concat(title, _spaced(F.col("content"), scripts), F.lit("\n")).alias("fragment"),
    )
    rows = headings.unionByName(texts).unionByName(notes).unionByName(around)
    parts = F.array_sort(F.collect_list(F.struct("section", "path", "sub", "seq", "fragment")))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["fragment"]), "\n").alias("body"))


def with_header(header: Column, body: Column, chars: str = DEVANAGARI) -> Column:
    """A whole document: header lines with the body's fingerprint, then the body."""
    stamp = F.concat(F.lit(f"\nhash_version: {HASH_VERSION}\nvalidation_hash: "), text_hash(body, chars))
    plain = F.regexp_replace(header, "(?m)^(?:hash_version|validation_hash):.*\\n?", "")
    return F.concat(F.lit("---\n"), F.regexp_replace(plain, "\\n+$", ""), stamp, F.lit("\n---\n"), body)


def work_json(works: DataFrame, passages: DataFrame, key: str = "work_id", scripts: tuple[str, ...] = SCRIPTS) -> DataFrame:
    """(key, json): a work's row with its passages in order; empty sections are left out.

    ``works``: key and header columns; ``passages``: (key, passage_type, seq, ref, content).
    """
    kept = F.map_filter("content", lambda k, _: k.isin(*scripts))

    def section(kind: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("passage_type") == kind, F.struct("seq", "ref", F.map_entries(kept).alias("c")))))
        rows = F.transform(found, lambda x: F.struct(x["ref"].alias("ref"), F.map_from_entries(x["c"]).alias("content")))
        return F.when(F.size(rows) > 0, rows)

    parts = passages.groupBy(key).agg(section("prefatory").alias("prefatory_material"), section("main").alias("passages"), section("concluding").alias("concluding_material"))
    joined = works.join(parts, key, "left")
    return joined.select(key, F.to_json(F.struct(*[c for c in joined.columns if c != key]), {"ignoreNullFields": "true"}).alias("json"))


def upsert(passages: DataFrame, edits: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """Passages with edits applied: a later row replaces an earlier one of the same key, new ones are added."""
    return last_by(passages.withColumn("_v", F.lit(0)).unionByName(edits.withColumn("_v", F.col(version) + 1).drop(version), allowMissingColumns=True), keys, [F.col("_v")]).drop("_v")


def removed(passages: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Passages without those named; names that do not occur change nothing."""
    return passages.join(gone.select(*keys).distinct(), keys, "left_anti")


def updates_without_target(passages: DataFrame, edits: DataFrame, keys: list[str]) -> DataFrame:
    """Edits of passages that do not exist."""
    return edits.join(passages.select(*keys).distinct(), keys, "left_anti")


def details_to_structured(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, body, problems) from paired HTML details blocks (key, idx, number, content, commentary, is_prefatory).

    References are verse numbers, prefatory blocks have "0"; blocks without a number are counted as problems.
    """
    note = F.when(F.col("commentary").isNotNull(), F.concat(F.lit("\n\n# Commentary: "), F.col("number").cast("string"), F.lit("\n"), F.col("commentary"))).otherwise("")
    head = F.when(F.col("is_prefatory"), F.lit('# Prefatory: 0 (devanagari: "")')).otherwise(F.concat(F.lit("# Mantra "), F.col("number").cast("string")))
    rows = blocks.withColumn("fragment", F.concat(head, F.lit("\n"), F.col("content"), note)).withColumn("bad", (~F.col("is_prefatory") & F.col("number").isNull()).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("idx", "fragment")))
    return rows.groupBy(key).agg(F.array_join(F.filter(F.transform(parts, lambda x: x["fragment"]), lambda x: x.isNotNull()), "\n\n").alias("body"), F.sum("bad").alias("problems"))
