"""Files and their counterparts: the best match by cleaned words, what differs, and hashes kept in headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import cleaned
from ..functions.script import DEVANAGARI, normalised, script_text
from .edits import edit_counts
from .link import best_match


def compared_text(text: Column, chars: str = DEVANAGARI) -> Column:
    """The script's words of a document without header, headings, comments and bold marks, joined by one space."""
    return script_text(cleaned(text), chars)


def best_files(sources: DataFrame, candidates: DataFrame, folder: str = "dir", name: str = "name", text: str = "text", chars: str = DEVANAGARI, skipped: str = "\\.repaired\\.md$") -> DataFrame:
    """(folder, name, match, score, n_different): for each source file the most similar candidate of its folder.

    Both sides are (folder, name, text).  Files are compared by their words (``compared_text``); candidates without a word, and those whose
    name ``skipped`` matches, take no part.  ``n_different``: characters removed and added between the words of the two, tidied.  Of equally
    similar candidates the first by name is taken.  A source without candidates has no row.  Folders are the blocks of the comparison; for matches
    across a whole library above a threshold take ``similar.best_similar``.
    """
    # one element exploded: filters on the words then read them and do not clean the text again
    words = lambda df: df.select(F.col(folder).alias("_dir"), F.col(name).alias("_name"), F.explode(F.array(compared_text(F.col(text), chars))).alias("_words"))
    left = words(sources).withColumn("_id", F.struct("_dir", "_name"))
    right = words(candidates.where(~F.col(name).rlike(skipped))).where("_words <> ''")
    best = best_match(left, right, ["_dir"], "_words", "_words", "_id", "_name", texts=True)
    counted = best.withColumn("_c", edit_counts("_a", "_b"))
    return counted.select(F.col("left_id._dir").alias(folder), F.col("left_id._name").alias(name), F.col("right_id").alias("match"), "score", (F.col("_c.deleted") + F.col("_c.inserted")).cast("long").alias("n_different"))


HEADER = "(?s)^\\s*---(.*?)---(.*)$"


def content_hash(text: Column, chars: str = DEVANAGARI) -> Column:
    """SHA-256 over the normal form of the script's words in header and body; null without a header."""
    joined = F.concat(F.regexp_extract(text, HEADER, 1), F.regexp_extract(text, HEADER, 2))
    return F.when(text.rlike(HEADER), F.sha2(normalised(script_text(joined, chars)), 256))


def with_content_hash(text: Column, field: str = "grantha_hash", chars: str = DEVANAGARI, n_different: Column | None = None, most: int = 0) -> Column:
    """The document with its ``content_hash`` in the header; null where there is nothing to update.

    That is where it has no header, where the hash stands there already, and where ``n_different`` (as ``best_files`` counts it) is above
    ``most``.  Other lines of the header and the body stay as they are; a hash is taken over the document as it was.
    """
    header, body = F.regexp_extract(text, HEADER, 1), F.regexp_extract(text, HEADER, 2)
    line = F.concat(F.lit(f"{field}: "), content_hash(text, chars))
    there = f"(?m)^{field}:.*$"
    plain = F.regexp_replace(header, "^\\s+|\\s+$", "")
    changed = F.when(header.rlike(there), F.regexp_replace(plain, F.lit(there), line)).otherwise(F.concat_ws("\n", F.nullif(plain, F.lit("")), line))
    fits = text.rlike(HEADER) & ~F.contains(F.concat(F.lit("\n"), header, F.lit("\n")), F.concat(F.lit("\n"), line, F.lit("\n")))
    if n_different is not None:
        fits = fits & (n_different <= most)
    return F.when(fits, F.concat(F.lit("---\n"), changed, F.lit("\n---"), body))
