"""Whole JSON works as nested rows, both ways: passages, commentaries as a list or a map, and the hash of what a header names.

A work in rows is two tables.  Passages: (key, section 0 to 2, seq, ref, passage_type, label map, content map by script, english).
Commentary passages: (key, commentary_id, ord, title, commentator map, seq, ref, before, content map, english), where ``before`` is the array of
what stands before the comment itself.  ``work_passages`` reads the first, ``commentary_passages`` the second, and ``whole_works``
makes JSON of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.script import DEVANAGARI
from ..operators.fingerprint import text_hash
from .documents import SCRIPT_MAP, commentaries_of, work_passages

#: Fixed value: the scripts of a passage, in the order of their texts.
SCRIPTS = ("devanagari", "roman", "kannada")
BEFORE = "array<struct<type:string,label:string,content:string>>"


def _scripts(content: Column) -> Column:
    """Texts by script, from a ``sanskrit`` object or the content itself."""
    found = F.coalesce(F.from_json(F.get_json_object(content, "$.sanskrit"), SCRIPT_MAP), F.from_json(content, SCRIPT_MAP))
    return F.map_filter(found, lambda k, v: k.isin(*SCRIPTS) & v.isNotNull())


def _english(content: Column) -> Column:
    return F.coalesce(F.get_json_object(content, "$.english_translation"), F.get_json_object(content, "$.english"))


def _parts(items: Column) -> Column:
    """Array of (type, label, content map, english) from an array of ``BEFORE``."""
    return F.transform(items, lambda x: F.struct(x["type"].alias("type"), x["label"].alias("label"), _scripts(x["content"]).alias("content"), _english(x["content"]).alias("english")))


def commentary_passages(works: DataFrame, key: str = "grantha_id", chosen: list[str] | None = None) -> DataFrame:
    """Every commentary passage of JSON works, whose ``commentaries`` are a list, or a map by identifier.

    ``chosen``: identifiers to read.  Of a map's commentary the key is the identifier, whatever stands inside.  Works without
    commentaries, and commentaries without passages, give no rows.
    """
    each = works.select(key, F.inline(commentaries_of(F.col("commentaries"))))
    if chosen is not None:
        each = each.where(F.col("commentary_id").isin(*chosen))
    value = lambda path: F.get_json_object("json", path)
    passages = F.from_json(value("$.passages"), f"array<struct<ref:string,prefatory_material:{BEFORE},content:string>>")
    rows = each.select(key, "commentary_id", "ord", value("$.commentary_title").alias("title"), F.from_json(value("$.commentator"), SCRIPT_MAP).alias("commentator"), F.posexplode(passages).alias("seq", "p"))
    before = F.coalesce(_parts(F.col("p.prefatory_material")), _parts(F.array().cast(BEFORE)))
    return rows.select(key, "commentary_id", "ord", "title", "commentator", "seq", F.col("p.ref").alias("ref"), before.alias("before"), _scripts(F.col("p.content")).alias("content"), _english(F.col("p.content")).alias("english"))


def _content(content: Column, english: Column, scripts: tuple[str, ...], name: str) -> Column:
    kept = F.map_filter(content, lambda k, v: k.isin(*scripts) & (v != ""))
    return F.struct(kept.alias("sanskrit"), english.alias(name))


def whole_works(works: DataFrame, passages: DataFrame, commentaries: DataFrame | None = None, key: str = "grantha_id", scripts: tuple[str, ...] = SCRIPTS, chosen: list[str] | None = None, as_map: bool = False) -> DataFrame:
    """(key, json): each work's columns, its sections in order and its commentaries, with the wanted scripts and commentaries.

    Empty sections are left out, but for ``passages``, which is always there; commentaries are a list in the order of ``ord``, or with ``as_map`` a map
    by identifier; those without passages are left out.  A work is gathered by one aggregation of its passages and one of
    its commentaries, so a work's text must fit a task, as its JSON text must anyway.
    """
    kept = _content(F.col("content"), F.col("english"), scripts, "english_translation")
    label = F.when(F.size(F.coalesce("label", F.create_map().cast("map<string,string>"))) > 0, F.col("label"))
    row = F.struct("section", "seq", F.to_json(F.struct("ref", "passage_type", label.alias("label"), kept.alias("content")), {"ignoreNullFields": "true"}).alias("j"))
    gathered = passages.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    array = lambda items: F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    section = lambda n: F.transform(F.filter("_rows", lambda x: x["section"] == n), lambda x: x["j"])
    named = lambda name, items, always=False: F.when(F.lit(True) if always else F.size(items) > 0, F.concat(F.lit(f'"{name}":'), array(F.coalesce(items, F.array().cast("array<string>")))))
    joined = works.join(gathered, key, "left")
    if commentaries is not None:
        some = commentaries if chosen is None else commentaries.where(F.col("commentary_id").isin(*chosen))
        before = F.transform("before", lambda x: F.struct(x["type"].alias("type"), x["label"].alias("label"), _content(x["content"], x["english"], scripts, "english").alias("content")))
        item = F.struct("ref", F.when(F.size("before") > 0, before).alias("prefatory_material"), _content(F.col("content"), F.col("english"), scripts, "english").alias("content"))
        one = some.groupBy(key, "commentary_id").agg(F.min("ord").alias("ord"), F.min("title").alias("title"), F.min_by("commentator", "seq").alias("commentator"), F.array_sort(F.collect_list(F.struct("seq", F.to_json(item, {"ignoreNullFields": "true"}).alias("j")))).alias("p"))
        head = F.to_json(F.struct("commentary_id", F.col("title").alias("commentary_title"), "commentator"), {"ignoreNullFields": "true"})
        body = F.concat(F.regexp_replace("_head", "\\}$", ""), F.lit(',"passages":'), array(F.transform("p", lambda x: x["j"])), F.lit("}"))
        quoted = F.regexp_extract(F.to_json(F.struct("commentary_id")), "^\\{[^:]*:(.*)\\}$", 1)
        one = one.withColumn("_head", head).select(key, F.struct("ord", "commentary_id", (F.concat(quoted, F.lit(":"), body) if as_map else body).alias("j")).alias("c"))
        joined = joined.join(one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["j"]).alias("_notes")), key, "left")
        around = ("{", "}") if as_map else ("[", "]")
        notes = F.when(F.size("_notes") > 0, F.concat(F.lit(f'"commentaries":{around[0]}'), F.array_join("_notes", ","), F.lit(around[1])))
    else:
        notes = F.lit(None).cast("string")
    plain = F.to_json(F.struct(*[c for c in works.columns if c not in ("passages", "prefatory_material", "concluding_material", "commentaries")]), {"ignoreNullFields": "true"})
    sections = F.concat_ws(",", named("prefatory_material", section(0)), named("passages", section(1), True), named("concluding_material", section(2)), notes)
    return joined.select(key, F.concat(F.regexp_replace(plain, "\\}$", ""), F.when(plain == "{}", F.lit("")).otherwise(F.lit(",")), sections, F.lit("}")).alias("json"))


def work_records(works: DataFrame, headers: DataFrame, key: str = "grantha_id") -> DataFrame:
    """(key, place, text): the texts of a work that its header names, to be read in the order of ``place``.

    ``headers``: (key, scripts array, commentaries array); null scripts mean all, null commentaries none.  The places are arrays of numbers
    that order as the texts follow one another: sections 0 to 2 and their passages, then commentaries in their own order, each passage after
    what stands before it.
    """
    chosen = headers.select(key, F.col("scripts").alias("_scripts"), F.col("commentaries").alias("_chosen"))

    def text(content: Column, english: Column) -> Column:
        wanted = F.filter(F.array(*map(F.lit, SCRIPTS)), lambda s: F.col("_scripts").isNull() | F.array_contains("_scripts", s))
        return F.concat(F.array_join(F.transform(wanted, lambda s: F.coalesce(F.try_element_at(content, s), F.lit(""))), ""), F.coalesce(english, F.lit("")))

    long = lambda *cs: F.array(*[c.cast("long") if isinstance(c, Column) else F.lit(c).cast("long") for c in cs])
    own = work_passages(works, key).join(chosen, key).select(key, long(F.col("section"), F.col("seq")).alias("place"), text(F.col("content"), F.col("english")).alias("text"))
    notes = commentary_passages(works, key).join(chosen, key).where(F.array_contains("_chosen", F.col("commentary_id")))
    before = notes.select(key, "_scripts", "ord", "seq", F.posexplode("before").alias("n", "b")).select(key, long(3, F.col("ord"), F.col("seq"), F.col("n")).alias("place"), text(F.col("b.content"), F.col("b.english")).alias("text"))
    after = notes.select(key, long(3, F.col("ord"), F.col("seq"), 1 << 40).alias("place"), text(F.col("content"), F.col("english")).alias("text"))
    return own.unionByName(before).unionByName(after)


def header_hash(works: DataFrame, headers: DataFrame, key: str = "grantha_id", chars: str = DEVANAGARI) -> DataFrame:
    """(key, hash): the fingerprint of what each work's header names, one sort of a work's records by their place."""
    records = work_records(works, headers, key)
    ordered = F.array_sort(F.collect_list(F.struct("place", "text")))
    found = records.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("t"))
    every = headers.select(key).distinct().join(works.select(key).distinct(), key).join(found, key, "left")
    return every.select(key, text_hash(F.coalesce("t", F.lit("")), chars).alias("hash"))


def verified(works: DataFrame, headers: DataFrame, key: str = "grantha_id", chars: str = DEVANAGARI) -> DataFrame:
    """(key, same): whether the work of each header has the hash that its ``validation_hash`` names.

    ``headers``: (key, scripts, commentaries, validation_hash).  A header without a work, or without a hash, is not the same.
    """
    found = header_hash(works, headers, key, chars)
    want = F.regexp_replace(F.coalesce("validation_hash", F.lit("")), "^sha256:", "")
    return headers.join(found, key, "left").select(key, F.coalesce(F.col("hash") == want, F.lit(False)).alias("same"))


def header_choice(headers: Column) -> Column:
    """Struct (scripts, commentaries, validation_hash) of a header as JSON; without scripts the first of ``SCRIPTS`` alone."""
    listed = lambda path: F.from_json(F.get_json_object(headers, path), "array<string>")
    return F.struct(F.coalesce(listed("$.scripts"), F.array(F.lit(SCRIPTS[0]))).alias("scripts"), listed("$.commentaries").alias("commentaries"), F.get_json_object(headers, "$.validation_hash").alias("validation_hash"))
