"""Rollups: envelopes, manifests, header profiles, merged headers, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def envelopes(parts: DataFrame, work: str = "work_id", part: str = "part_num", header: str = "header") -> DataFrame:
    """(work, header of the least part, part files in order, n_parts, consecutive)."""
    numbers = F.array_sort(F.collect_set(part))
    agg = parts.groupBy(work).agg(F.min_by(header, part).alias("header"), F.count("*").alias("n_parts"), numbers.alias("part_nums"))
    files = F.transform("part_nums", lambda n: F.concat(F.lit("part"), n.cast("string"), F.lit(".json")))
    return agg.withColumn("consecutive", (F.col("n_parts") == F.size("part_nums")) & (F.get("part_nums", F.lit(0)) == 1) & (F.element_at("part_nums", -1) == F.col("n_parts"))).withColumn("files", files)


def part_problems(parts: DataFrame, work: str = "work_id", part: str = "part_num") -> DataFrame:
    """(work, part, problem): "missing" or "extra" against 1..n, "duplicate", or "no number"."""
    some = parts.where(F.col(part).isNotNull())
    n = parts.groupBy(work).agg(F.count("*").alias("n"))
    want = n.select(work, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias(part))
    have = some.select(work, F.col(part).cast("long").alias(part))
    none = parts.where(F.col(part).isNull()).select(work, F.lit(None).cast("long").alias(part), F.lit("no number").alias("problem"))
    twice = have.groupBy(work, part).agg(F.count("*").alias("k")).where("k > 1").select(work, part, F.lit("duplicate").alias("problem"))
    missing = want.join(have, [work, part], "left_anti").withColumn("problem", F.lit("missing"))
    extra = have.distinct().join(want, [work, part], "left_anti").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra).unionByName(twice).unionByName(none)


def manifest(files: DataFrame, works: DataFrame, version: str, release_date: str) -> DataFrame:
    """One row: the files in order, the works, totals, and a checksum of the document with that field blank.

    ``files``: (path, sha256, size_bytes); ``works``: (work_id, title, is_envelope, path, n_commentaries): of
    each work the first seen entry counts, envelopes first.  Both are lists of files, not of texts.
    """
    w = Window.partitionBy("work_id").orderBy(F.desc("is_envelope"), "path")
    first = works.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    left = files.agg(F.array_sort(F.collect_list(F.struct("path", "sha256", "size_bytes"))).alias("files"), F.count("*").alias("n_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("n_bytes"))
    right = first.agg(F.array_sort(F.collect_list(F.struct("work_id", "title"))).alias("works"), F.count("*").alias("n_works"), F.coalesce(F.sum("n_commentaries"), F.lit(0)).alias("n_commentaries"))
    joined = left.withColumn("_k", F.lit(1)).join(right.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    named = joined.select(F.lit(version).alias("version"), F.lit(release_date).alias("release_date"), *joined.columns)
    return named.withColumn("checksum", F.sha2(F.to_json(F.struct(*named.columns, F.lit("").alias("checksum"))), 256))


def totals(docs: DataFrame, by: list[str], size: Column) -> DataFrame:
    """Counts and bytes by ``by`` with a grand total (nulls)."""
    return docs.rollup(*by).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))


def modes(df: DataFrame, by: list[str], value: str, order: Column) -> DataFrame:
    """(by, value, n, share): each group's most frequent value; of equally frequent ones the first seen."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), "_first")).alias(value), F.max("n").alias("n"), F.sum("n").alias("total"))
    return best.select(*by, value, "n", (F.col("total") - F.col("n")).alias("deviating"))


def header_profile(headers: DataFrame, by: str = "work_id", file: str = "file", header: str = "header", protected: tuple[str, ...] = ("part_num", "part_title", "validation_hash", "hash_version")) -> DataFrame:
    """(by, field, value, n, deviating): fields that all files of a group have, with their mode.

    ``header`` is a map of strings; composite values are expected as canonical JSON.
    """
    files = headers.groupBy(by).agg(F.count_distinct(file).alias("files"))
    cells = headers.select(by, file, F.explode(header).alias("field", "value")).where(~F.col("field").isin(*protected))
    shared = cells.groupBy(by, "field").agg(F.count_distinct(file).alias("k")).join(files, by).where("k = files").select(by, "field")
    return modes(cells.join(shared, [by, "field"]), [by, "field"], "value", F.col(file))


def deviating_files(headers: DataFrame, profile: DataFrame, by: str = "work_id", file: str = "file", header: str = "header") -> DataFrame:
    """(by, field, file, value, expected): files whose value is not the group's mode."""
    cells = headers.select(by, file, F.explode(header).alias("field", "value"))
    return cells.join(profile.select(by, "field", F.col("value").alias("expected")), [by, "field"]).where(~F.col("value").eqNullSafe(F.col("expected")))


def applied_changes(headers: DataFrame, changes: DataFrame, by: list[str]) -> DataFrame:
    """Header maps with a change set (by, field, new) applied; others as they are."""
    new = changes.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("field", "new"))).alias("_new"))
    old = F.map_filter("header", lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    return headers.join(new, by, "left").withColumn("header", F.when(F.col("_new").isNull(), F.col("header")).otherwise(F.map_concat(old, F.col("_new")))).drop("_new")


def merged_headers(chunks: DataFrame, key: str = "doc_id", at: str = "chunk", header: str = "header", commentaries: str = "commentaries") -> DataFrame:
    """(key, header, commentaries): the first chunk's header with defaults; commentaries once by id, first kept."""
    each = chunks.select(key, at, F.posexplode(commentaries).alias("i", "c"))
    w = Window.partitionBy(key, "c.commentary_id").orderBy(at, "i")
    once = each.withColumn("_n", F.row_number().over(w)).where("_n = 1").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(at, "i", "c"))), lambda x: x["c"]).alias("commentaries"))
    first = chunks.groupBy(key).agg(F.min_by(header, at).alias("header"))
    defaults = F.create_map(*[F.lit(x) for x in ("text_type", "upanishad", "language", "sanskrit")])
    full = F.map_concat(F.map_filter(defaults, lambda k, _: ~F.array_contains(F.map_keys("header"), k)), F.col("header"))
    return first.join(once, key, "left").withColumn("header", full)


def diff_report(pairs: DataFrame, records: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, n_chars, n_space, n_text, delta_percent, rank): pairs; the most differences other than white space rank first, equal ones share a rank."""
    # both counts come from the same two, so that the part for the ranks is the part for the rows and differences are made once
    counts = records.groupBy(key).agg(F.count("whitespace_only").alias("_n"), F.count_if("whitespace_only").alias("n_space"))
    counts = counts.select(key, "n_space", (F.col("_n") - F.col("n_space")).alias("n_text"))
    zero = F.lit(0).cast("long")
    out = pairs.join(counts, key, "left").withColumn("n_space", F.coalesce("n_space", zero)).withColumn("n_text", F.coalesce("n_text", zero))
    # ranks from the counts of pairs by n_text: a table of distinct numbers, never all pairs in one window
    equal = out.groupBy("n_text").agg(F.count("*").alias("k"))
    above = F.coalesce(F.sum("k").over(Window.orderBy(F.desc("n_text")).rowsBetween(Window.unboundedPreceding, -1)), zero)
    out = out.join(equal.select("n_text", (above + 1).alias("rank")), "n_text")
    out = out.withColumn("delta_percent", F.when(F.col("n_chars") > 0, 100.0 * (F.col("n_other") - F.col("n_chars")) / F.col("n_chars")))
    return out.select(key, "n_chars", "n_space", "n_text", "delta_percent", "rank")


def diff_totals(report: DataFrame) -> DataFrame:
    """One row of sums, and how many pairs are perfect."""
    return report.agg(F.count("*").alias("n_pairs"), F.sum("n_chars").alias("n_chars"), F.sum("n_space").alias("n_space"), F.sum("n_text").alias("n_text"), F.count_if((F.col("n_space") + F.col("n_text")) == 0).alias("n_perfect"))


def chunk_summary(validations: DataFrame) -> DataFrame:
    """(status, n, char_diff) and their total (null status)."""
    return validations.rollup("status").agg(F.count("*").alias("n"), F.sum("char_diff").alias("char_diff"))
