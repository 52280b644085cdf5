"""A rule engine: rules are predicates with an identifier and a severity; violations are rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.script import strip
from .align import first_difference
from .ranges import coverage_gaps
from .schemas import against_schema, schema_errors  # noqa: F401
from .segment import lines


@dataclass(frozen=True)
class Rule:
    """``failed`` is true where the rule is broken; null counts as not broken."""

    rule_id: str
    severity: str
    failed: Column
    message: str = ""


def violations(df: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """(keys, rule_id, severity, message): one row for each broken rule, in one pass over the rows."""
    all_rules = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message"), F.coalesce(r.failed, F.lit(False)).alias("failed")) for r in rules])
    return df.select(*keys, F.inline(F.filter(all_rules, lambda x: x["failed"]))).drop("failed")


def header_rules(header: str = "header") -> list[Rule]:
    """Rules of a document header with fields grantha_id, part_num, canonical_title, text_type, language,
    structure_levels (array of struct key, script_names map), commentaries_metadata, hash_version, validation_hash."""
    h = lambda f: F.col(f"{header}.{f}")
    required = ["grantha_id", "part_num", "canonical_title", "text_type", "language", "structure_levels"]
    levels = h("structure_levels")
    return [
        *[Rule(f"required:{f}", "error", h(f).isNull(), "required field is missing") for f in required],
        Rule("id_pattern", "error", ~h("grantha_id").rlike("^[a-z0-9-]+$"), "letters, digits and dashes"),
        Rule("text_type", "error", ~h("text_type").isin("upanishad", "commentary"), "unknown kind of text"),
        Rule("language", "error", ~h("language").isin("sanskrit", "english"), "unknown language"),
        Rule("part_num", "error", h("part_num") < 1, "parts count from 1"),
        Rule("levels_empty", "error", F.size(levels) == 0, "no level"),
        Rule("level_key", "error", F.exists(levels, lambda x: x["key"].isNull() | (x["key"] == "")), "a level without key"),
        Rule("level_script", "error", F.exists(levels, lambda x: F.try_element_at(x["script_names"], F.lit("devanagari")).isNull()), "a level without a name in the main script"),
        Rule("hash_version", "warning", h("hash_version").isNull(), "no fingerprint version"),
        Rule("validation_hash", "warning", h("validation_hash").isNull(), "no fingerprint"),
    ]


def passage_rules() -> list[Rule]:
    """Rules of a passage (ref, passage_type, label, content)."""
    return [
        Rule("ref_missing", "error", F.col("ref").isNull() | (F.col("ref") == ""), "no reference"),
        Rule("ref_form", "error", ~F.col("ref").rlike("^\\d+(\\.\\d+)*$"), "references are numbers with dots"),
        Rule("type", "error", ~F.col("passage_type").isin("prefatory", "main", "concluding"), "unknown type"),
        Rule("label", "error", (F.col("passage_type") != "main") & F.col("label").isNull(), "a label is required"),
        Rule("content", "error", F.try_element_at("content", F.lit("devanagari")).isNull(), "no text in the main script"),
    ]


def schema_rules(kind: str) -> list[Rule]:
    """Typed rules in place of a JSON schema, for a "single", "part" or "envelope" document row."""
    c = F.col
    common = [
        Rule("grantha_id", "error", c("grantha_id").isNull() | ~c("grantha_id").rlike("^[a-z0-9-]+$"), "$.grantha_id: pattern"),
    ]
    if kind == "part":
        return [*common, Rule("part_num", "error", c("part_num").isNull() | (c("part_num") < 1), "$.part_num: at least 1"), Rule("passages", "error", c("passages").isNull(), "$.passages: required")]
    head = [
        *common,
        Rule("schema_version", "error", c("schema_version").isNull() | ~c("schema_version").rlike("^\\d+\\.\\d+\\.\\d+"), "$.schema_version: semantic version"),
        Rule("canonical_title", "error", c("canonical_title").isNull(), "$.canonical_title: required"),
        Rule("text_type", "error", ~c("text_type").isin("upanishad", "commentary"), "$.text_type: enumeration"),
        Rule("language", "error", ~c("language").isin("sanskrit", "english"), "$.language: enumeration"),
    ]
    if kind == "envelope":
        return [*head, Rule("parts", "error", c("parts").isNull() | (F.size("parts") < 1), "$.parts: at least one"), Rule("part_names", "error", F.exists("parts", lambda p: ~p.rlike("^part[0-9]+\\.json$")), "$.parts: pattern")]
    return [*head, Rule("passages", "error", c("passages").isNull(), "$.passages: required")]


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): keys that stand more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


#: The strict line grammar.
GRAMMAR = {
    "main": '(?U)^#\\s+Mantra\\s+([\\d.-]+)$',
    "prefatory": '(?U)^#\\s+Prefatory:\\s+([\\d.]+)\\s+\\((\\w+):\\s*"(.*?)"\\)$',
    "concluding": '(?U)^#\\s+Concluding:\\s+([\\d.]+)\\s+\\((\\w+):\\s*"(.*?)"\\)$',
    "commentary": "(?U)^#\\s+Commentary:\\s+([\\d.-]+)$",
    "open": "(?U)^<!--\\s*sanskrit:(\\w+)\\s*-->$",
    "close": "(?U)^<!--\\s*/sanskrit:(\\w+)\\s*-->$",
    "meta": "(?U)^<!--\\s*commentary:\\s*(.*?)\\s*-->$",
}


#: A reference whose last part is a range: what stands before, and its ends.
RANGE = "^(?:(.*)\\.)?(\\d+)-(\\d+)$"
#: Members of a range that are listed one by one.
MOST_MEMBERS = 10_000


def line_grammar(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """(key, line_num, rule_id, detail) of every breach of the line grammar.

    Rules: duplicate_ref, missing_meta, meta_without_commentary, bad_meta, no_passage, bad_range, mismatched_end,
    unclosed_block, unrecognised.  Lines inside a script block are free, up to any closing tag.  Of a range each member without a
    passage is a row, but where more than ``MOST_MEMBERS`` follow one another these are one row, with their range as its detail.
    """
    rows = lines(docs, key, body).withColumn("t", strip(F.col("line")))
    t = F.col("t")
    opens, closes = t.rlike(GRAMMAR["open"]), t.rlike(GRAMMAR["close"])
    order = Window.partitionBy(key).orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # inside a block: the last tag before the line opened one
    tag = F.when(opens, F.struct(F.lit(True).alias("open"), F.regexp_extract("t", GRAMMAR["open"], 1).alias("script"))).when(closes, F.struct(F.lit(False).alias("open"), F.lit("").alias("script")))
    rows = rows.withColumn("tag", tag).withColumn("last", F.last("tag", ignorenulls=True).over(before))
    rows = rows.withColumn("inside", F.coalesce(F.col("last.open"), F.lit(False)))
    kind = F.coalesce(*[F.when(t.rlike(GRAMMAR[k]), F.lit(k)) for k in ("main", "prefatory", "concluding", "commentary", "open", "meta")])
    rows = rows.withColumn("kind", F.when(~F.col("inside") & (t != ""), F.coalesce(kind, F.lit("other"))))
    rows = rows.withColumn("ref", F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract("t", GRAMMAR[k], 1)) for k in ("main", "prefatory", "concluding", "commentary")]))
    at = (F.col("pos") + 1).alias("line_num")
    is_main = F.col("kind").isin("main", "prefatory", "concluding")
    is_comment, is_meta = F.col("kind") == "commentary", F.col("kind") == "meta"
    near = rows.where("kind IS NOT NULL").withColumn("prev", F.lag("kind").over(order)).withColumn("next", F.lead("kind").over(order))
    near = near.withColumn("main", is_main).withColumn("nth", F.row_number().over(Window.partitionBy(key, "main", "ref").orderBy("pos")))
    lo, hi = (F.regexp_extract("ref", RANGE, k).try_cast("long") for k in (2, 3))
    ranged = is_comment & F.contains("ref", F.lit("-"))
    near = near.withColumn("good", ~ranged | F.coalesce(lo <= hi, F.lit(False)))

    def breaches(**found: tuple[Column, Column]) -> Column:
        each = F.array(*[F.struct(F.lit(k).alias("rule_id"), detail.alias("detail"), F.coalesce(broken, F.lit(False)).alias("broken")) for k, (broken, detail) in found.items()])
        return F.inline(F.transform(F.filter(each, lambda x: x["broken"]), lambda x: F.struct(x["rule_id"].alias("rule_id"), x["detail"].alias("detail"))))

    no_id = F.get_json_object(F.regexp_extract("t", GRAMMAR["meta"], 1), "$.commentary_id").isNull()
    headings = near.select(
        key,
        at,
        breaches(
            duplicate_ref=(is_main & (F.col("nth") > 1), F.col("ref")),
            missing_meta=(is_comment & ~F.col("prev").eqNullSafe("meta"), F.col("ref")),
            meta_without_commentary=(is_meta & (F.col("next") != "commentary"), F.col("t")),
            bad_meta=(is_meta & no_id, F.col("t")),
            bad_range=(is_comment & ~F.col("good"), F.col("ref")),
            unrecognised=(F.col("kind") == "other", F.col("t")),
        ),
    )
    now = F.last("tag", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    tagged = rows.withColumn("now", now).withColumn("ends", F.lead("pos").over(order).isNull())
    blocks = tagged.where(F.col("ends") | closes).select(
        key,
        at,
        breaches(
            mismatched_end=(F.col("inside") & closes & (F.col("last.script") != F.regexp_extract("t", GRAMMAR["close"], 1)), F.col("last.script")),
            unclosed_block=(F.col("ends") & F.col("now.open"), F.col("now.script")),
        ),
    )
    refs = rows.where(is_main).select(key, "ref").distinct()
    missing = near.where(is_comment & ~ranged).select(key, "pos", "ref").join(refs, [key, "ref"], "left_anti").select(key, "pos", F.col("ref").alias("detail"))
    spans = near.where(ranged & F.col("good")).select(key, "pos", "ref")
    name = lambda n: F.concat_ws(".", F.nullif(F.regexp_extract("ref", RANGE, 1), F.lit("")), n.cast("string"))
    each = F.transform(F.sequence(F.col("first"), F.least("last", F.col("first") + MOST_MEMBERS)), name)
    gaps = coverage_gaps(spans, refs, key).select(key, "ref", F.explode(F.when(F.col("n") <= MOST_MEMBERS, each).otherwise(F.array(F.concat(name(F.col("first")), F.lit("-"), F.col("last").cast("string"))))).alias("detail"))
    missing = missing.unionByName(spans.join(gaps, [key, "ref"]).select(key, "pos", "detail"))
    return headings.unionByName(blocks).unionByName(missing.select(key, at, F.lit("no_passage").alias("rule_id"), "detail"))


def preservation(a: Column, b: Column, context: int = 20) -> Column:
    """Struct (same, length_diff, first_difference, left, right): what of ``a`` is not kept in ``b``."""
    at = first_difference(a, b)
    around = lambda c: F.substring(c, F.greatest(F.lit(1), at - context), F.lit(2 * context))
    return F.struct((a == b).alias("same"), F.abs(F.length(a) - F.length(b)).alias("length_diff"), at.alias("first_difference"), around(a).alias("left"), around(b).alias("right"))
