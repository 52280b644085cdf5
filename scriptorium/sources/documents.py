"""Readers and writers: structured text, JSON works, directories, part numbers."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.markup import frontmatter

try:  # headers are YAML; without the parser they stay text
    import yaml
except ImportError:
    yaml = None

SCRIPT_MAP = T.MapType(T.StringType(), T.StringType())
WORK = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("grantha_id", T.StringType()),
    T.StructField("part_num", T.IntegerType()),
    T.StructField("canonical_title", T.StringType()),
    T.StructField("text_type", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("structure_levels", T.StringType()),
    T.StructField("structure", T.StructType([T.StructField("levels", T.StringType())])),
    T.StructField("passages", T.StringType()),
    T.StructField("prefatory_material", T.StringType()),
    T.StructField("concluding_material", T.StringType()),
    T.StructField("commentaries", T.StringType()),
])
LEVELS = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("ordinal", T.IntegerType()),
    T.StructField("parent", T.IntegerType()), T.StructField("is_lowest", T.BooleanType()), T.StructField("first_child", T.BooleanType()),
]))
PASSAGE = "array<struct<ref:string,passage_type:string,label:map<string,string>,content:string>>"


def read_texts(spark: SparkSession, path: str, pattern: str = "*.md", exclude: str | None = None) -> DataFrame:
    """(path, name, text) of whole files, recursively; ``exclude`` is a regular expression on the name."""
    rows = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path, wholetext=True)
    out = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return out.where(~F.col("name").rlike(exclude)) if exclude else out


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """JSON works, one a file: either place of the levels, titles as text or map."""
    rows = spark.read.schema(WORK).option("multiLine", "true").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(path)
    title = F.coalesce(F.get_json_object("canonical_title", "$.devanagari"), F.col("canonical_title"))
    return rows.withColumn("structure_levels", F.coalesce("structure_levels", "structure.levels")).withColumn("canonical_title", title).drop("structure")


def work_passages(works: DataFrame, key: str = "grantha_id") -> DataFrame:
    """(key, section, seq, ref, label, content map, english) of all passages of JSON works.

    Scripts may stand in a ``sanskrit`` object or in the content itself.
    """
    section = lambda column, n: F.transform(F.coalesce(F.from_json(column, PASSAGE), F.array().cast(PASSAGE)), lambda x, i: F.struct(F.lit(n).alias("section"), i.alias("seq"), x.alias("p")))
    rows = works.select(key, F.inline(F.concat(section("prefatory_material", 0), section("passages", 1), section("concluding_material", 2))))
    content = F.coalesce(F.from_json(F.get_json_object("p.content", "$.sanskrit"), SCRIPT_MAP), F.from_json("p.content", SCRIPT_MAP))
    scripts = F.map_filter(content, lambda k, v: k.isin("devanagari", "roman", "kannada") & v.isNotNull())
    english = F.coalesce(F.get_json_object("p.content", "$.english_translation"), F.get_json_object("p.content", "$.english"))
    return rows.select(key, "section", "seq", "p.ref", "p.passage_type", "p.label", scripts.alias("content"), english.alias("english"))


def commentaries_of(metadata: Column) -> Column:
    """Array of (commentary_id, json, ord) from JSON that is a list of objects or a map by id."""
    as_list = F.from_json(metadata, "array<string>")
    as_map = F.from_json(metadata, "map<string,string>")
    listed = F.transform(as_list, lambda x, i: F.struct(F.get_json_object(x, "$.commentary_id").alias("commentary_id"), x.alias("json"), i.alias("ord")))
    mapped = F.transform(F.map_entries(as_map), lambda e, i: F.struct(e["key"].alias("commentary_id"), e["value"].alias("json"), i.alias("ord")))
    return F.when(F.startswith(F.ltrim(metadata), F.lit("[")), listed).otherwise(mapped)


@F.pandas_udf(T.StringType())
def yaml_to_json(headers: pd.Series) -> pd.Series:
    """Each YAML header as JSON; null if it cannot be read."""

    def one(text: str | None) -> str | None:
        if text is None or yaml is None:
            return None
        try:
            found = yaml.safe_load(text)
        except yaml.YAMLError:
            return None
        return json.dumps(found, ensure_ascii=False, default=str) if isinstance(found, dict) else None

    return headers.map(one)


@F.pandas_udf(LEVELS)
def flat_levels(levels: pd.Series) -> pd.Series:
    """Level definitions (JSON lists or objects with children) depth first; the lowest follows last siblings."""

    def one(text: str | None) -> list[dict] | None:
        if not text:
            return None
        out: list[dict] = []

        def walk(nodes, depth: int, parent: int) -> None:  # noqa: ANN001
            nodes = nodes if isinstance(nodes, list) else [nodes]
            for k, n in enumerate(x for x in nodes if isinstance(x, dict)):
                at = len(out)
                out.append({"key": n.get("key"), "depth": depth, "ordinal": at, "parent": parent, "is_lowest": False, "first_child": k == 0})
                if n.get("children"):
                    walk(n["children"], depth + 1, at)

        try:
            walk(json.loads(text), 1, -1)
        except ValueError:
            return None
        at = -1
        while below := [x for x in out if x["parent"] == at]:
            at = below[-1]["ordinal"]
        if out:
            out[at]["is_lowest"] = True
        return out

    return levels.map(one)


def level_name(levels: Column, depth: int) -> Column:
    """The key at a depth along first children; the deepest there is if fewer."""
    path = F.filter(levels, lambda x: x["first_child"] & (x["depth"] <= depth))
    return F.get(path, F.size(path) - 1)["key"]


def structured_documents(texts: DataFrame) -> DataFrame:
    """(path, header JSON, body, levels, commentaries) of structured texts."""
    split = texts.withColumn("_f", frontmatter(F.col("text"))).withColumn("header", yaml_to_json(F.col("_f.header"))).withColumn("body", F.col("_f.body"))
    return split.select("path", "header", "body", flat_levels(F.get_json_object("header", "$.structure_levels")).alias("levels"), commentaries_of(F.get_json_object("header", "$.commentaries_metadata")).alias("commentaries"))


#: Ordinal words in file names.
ORDINALS = {
    "prathama": 1, "pratham": 1, "dvitiya": 2, "dviti": 2, "tritiya": 3, "trtiya": 3, "caturtha": 4, "catur": 4, "pancama": 5, "panchama": 5,
    "pajcama": 5, "shashtha": 6, "sastho": 6, "sastha": 6, "saptama": 7, "astama": 8, "ashtama": 8, "navama": 9, "dasama": 10,
}


def part_number(name: Column) -> Column:
    """A part number from a file name: NN-NN, part-N, an ordinal word (longest first), -NN, NN; else 1."""
    stem = F.lower(F.regexp_replace(name, "\\.md", ""))
    number = lambda pattern, g=1: F.when(stem.rlike(pattern), F.regexp_extract(stem, pattern, g).cast("int"))
    words = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n")) for w, n in sorted(ORDINALS.items(), key=lambda x: -len(x[0]))])
    word = F.get(F.filter(words, lambda x: F.contains(stem, x["w"])), F.lit(0))["n"]
    return F.coalesce(number("(\\d{2})-(\\d{2})$", 2), number("part[-_]?(\\d+)$"), word, number("-(\\d{2})$"), number("^(\\d{2})$"), F.lit(1))


def directory_targets(files: DataFrame) -> DataFrame:
    """(dir, files in part order, multipart): one build target a directory."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    rows = files.select(folder.alias("dir"), part_number(F.element_at(F.split("path", "/"), -1)).alias("part"), "path")
    agg = rows.groupBy("dir").agg(F.array_sort(F.collect_list(F.struct("part", "path"))).alias("f"))
    return agg.select("dir", F.transform("f", lambda x: x["path"]).alias("files"), (F.size("f") > 1).alias("multipart"))


def report_lines(df: DataFrame, title: str, columns: list[str]) -> DataFrame:
    """(at, line): a table as the lines of a text report, a heading first, then a row a line in the order of ``columns``."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    rows = df.select(F.lit(2).alias("at"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |")).alias("line"))
    head = [(0, f"# {title}"), (1, "| " + " | ".join(columns) + " |")]
    return df.sparkSession.createDataFrame(head, "at int, line string").unionByName(rows).orderBy("at", "line")


def write_report(df: DataFrame, path: str, title: str, columns: list[str]) -> None:
    """``report_lines`` as a folder of text files that hold the lines in order."""
    report_lines(df, title, columns).select("line").write.mode("errorifexists").text(path)


def write_texts(df: DataFrame, path: str, by: str, text: str = "text") -> None:
    """One text file a row below ``path``/``by``=value; line ends stay as they are."""
    df.select(by, text).write.partitionBy(by).mode("errorifexists").option("lineSep", "\n").text(path)
