"""Chunking: at boundaries, by plan, and the estimates before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.script import strip
from .segment import boundaries

#: Fixed value: the order in which boundary types are preferred.
PREFERENCE = ("khanda", "valli", "anuvaka", "prapathaka")
MOST = 200_000


def split_at(text: Column, cuts: Column, most: int = MOST) -> Column:
    """Array of chunks: greedy cuts at sorted positions once a chunk has ``most`` characters, and at the last.

    The first chunk stands as it is, later ones are stripped; blank chunks are dropped; without
    positions the text is one chunk.
    """
    last = F.size(cuts) - 1
    numbered = F.transform(cuts, lambda p, i: F.struct(p.cast("long").alias("p"), i.alias("i")))
    zero = F.struct(F.lit(0).cast("long").alias("start"), F.array().cast("array<long>").alias("ends"))

    def take(state: Column, cut: Column) -> Column:
        full = (cut["p"] > state["start"]) & ((cut["p"] - state["start"] >= most) | (cut["i"] == last))
        return F.when(full, F.struct(cut["p"].alias("start"), F.array_append(state["ends"], cut["p"]).alias("ends"))).otherwise(state)

    ends = F.array_append(F.aggregate(numbered, zero, take, lambda s: s["ends"]), F.length(text).cast("long"))
    chunks = F.transform(_pieces(text, ends), lambda x, i: F.when(i == 0, x).otherwise(strip(x)))
    return F.filter(F.when(F.size(cuts) == 0, F.array(text)).otherwise(chunks), lambda x: strip(x) != "")


def _pieces(text: Column, ends: Column) -> Column:
    """The text cut after each of ``ends``, numbers of characters in ascending order."""
    spans = F.transform(ends, lambda e, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0)).cast("int").alias("a"), e.cast("int").alias("b")))
    return F.transform(spans, lambda x: F.substring(text, x["a"] + 1, x["b"] - x["a"]))


def boundary_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST, preferred: str | None = None, patterns=None) -> DataFrame:  # noqa: ANN001
    """(key, chunk, n_chunks, size, content): split at the preferred type, else the first of ``PREFERENCE`` that occurs."""
    found = boundaries(docs, key, text, **({"patterns": patterns} if patterns else {}))
    if preferred:
        found = found.where(F.col("type") == preferred)
    best = found.groupBy(key, "rank").agg(F.sort_array(F.collect_list("position")).alias("cuts")).groupBy(key).agg(F.min_by("cuts", "rank").alias("cuts"))
    joined = docs.select(key, text).join(best, key, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<long>")))
    chunks = joined.withColumn("chunks", split_at(F.col(text), F.col("cuts"), most))
    return chunks.select(key, F.posexplode("chunks").alias("chunk", "content"), F.size("chunks").alias("n_chunks")).select(key, "chunk", "n_chunks", F.length("content").alias("size"), "content")


def plan_chunks(text: Column, plan: Column) -> Column:
    """Array of chunks by a plan, an array of structs (chunk_id, start_marker, end_marker).

    A chunk begins where the one before ended and ends after the first end marker that follows; with a single
    chunk after the last one; without the marker at the end.  Blank chunks are dropped.
    """
    one = F.size(plan) == 1
    zero = F.struct(F.lit(1).alias("start"), F.array().cast("array<int>").alias("ends"))

    def take(state: Column, step: Column) -> Column:
        marker = step["end_marker"]
        first = F.call_function("locate", marker, text, state["start"])
        reversed_at = F.call_function("locate", F.reverse(marker), F.reverse(text))
        final = F.when(reversed_at > 0, F.length(text) - reversed_at - F.length(marker) + 2).otherwise(0)
        at = F.when(one, final).otherwise(first)
        end = F.when(at > 0, at + F.length(marker)).otherwise(F.length(text) + 1)
        return F.struct(end.alias("start"), F.array_append(state["ends"], end - 1).alias("ends"))

    ends = F.aggregate(plan, zero, take, lambda s: s["ends"])
    return F.filter(_pieces(text, ends), lambda x: strip(x) != "")


def should_chunk(text: Column, threshold: int = MOST) -> Column:
    """Whether the text has ``threshold`` bytes or more."""
    return F.octet_length(text) >= threshold


def chunk_estimate(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """(key, n_chunks): size over ``most`` plus one, between 1 and the count of the commonest boundary type."""
    counts = boundaries(docs, key, text).groupBy(key, "type").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("n"))
    size = docs.select(key, (F.floor(F.length(text) / most) + 1).alias("by_size"))
    return size.join(counts, key, "left").select(key, F.greatest(F.lit(1), F.least("by_size", F.coalesce("n", F.lit(1)))).cast("int").alias("n_chunks"))


def page_ranges(files: DataFrame, size: int, step: int, key: str = "path", pages: str = "n_pages") -> DataFrame:
    """(key, chunk, first, until): page ranges [start, min(start + size, pages)) for every ``step``-th start."""
    starts = F.when(F.col(pages) > 0, F.sequence(F.lit(0), F.col(pages) - 1, F.lit(step)))
    return files.select(key, pages, F.posexplode(starts).alias("chunk", "first")).select(key, "chunk", "first", F.least(F.col("first") + size, pages).alias("until"))


def all_present(expected: DataFrame, found: DataFrame, key: str = "path") -> DataFrame:
    """Keys of which every expected chunk is among the found ones: only then a cache is used."""
    left = expected.join(found.select(key, "chunk").withColumn("_there", F.lit(1)), [key, "chunk"], "left")
    return left.groupBy(key).agg(F.count("*").alias("n"), F.count("_there").alias("there")).where("n = there").select(key)


def ordered_merge(chunks: DataFrame, key: str = "doc_id", at: str = "chunk", content: str = "content", stripped: bool = True) -> DataFrame:
    """(key, body, n_chunks, complete): chunk contents in order, blank ones left out, an empty line between.

    ``complete``: no number is missing up to the largest.  ``stripped=False`` joins them as they are.
    """
    text = strip(F.col(content)) if stripped else F.col(content)
    parts = F.collect_list(F.when(strip(F.col(content)) != "", F.struct(F.col(at).alias("k"), text.alias("t"))))
    body = F.array_join(F.transform(F.array_sort(parts), lambda x: x["t"]), "\n\n")
    return chunks.groupBy(key).agg(body.alias("body"), F.count("*").alias("n_chunks"), (F.count_distinct(at) == F.max(at) - F.min(at) + 1).alias("complete"))


def replayed(chunks: DataFrame, responses: DataFrame, key: str = "doc_id", at: str = "chunk") -> DataFrame:
    """Chunks with their recorded responses, by integer chunk number; null where none is recorded."""
    return chunks.join(responses.select(key, at, "response"), [key, at], "left")


def running_number(df: DataFrame, by: str, order: Column) -> DataFrame:
    """Rows numbered from 1 within ``by``."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy(order)))
