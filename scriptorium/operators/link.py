"""Joins between passages, commentaries, parts, caches and files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.refs import expanded
from .align import Nearest, ratio
from .ranges import containing  # noqa: F401


def lookup(passages: DataFrame, ref: str, key: str = "doc_id") -> DataFrame:
    """The passage with ``ref`` of each document; of repeated ones the last."""
    w = Window.partitionBy(key).orderBy(F.desc("block"))
    return passages.where(F.col("ref") == ref).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def passages_of(passages: DataFrame, passage_type: str | None = None, scripts: tuple[str, ...] | None = None) -> DataFrame:
    """Passages of one type with the wanted scripts; ``doc_id``, ``ref_key`` and ``block`` order them where they are written."""
    out = passages if passage_type is None else passages.where(F.col("passage_type") == passage_type)
    if scripts is not None:
        out = out.withColumn("content", F.map_filter("content", lambda k, _: k.isin(*scripts)))
    return out


def last_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: later rows replace earlier ones."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def interleaved(passages: DataFrame, commentaries: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each passage with each of its commentaries; commentaries without passage vanish.

    ``key``, ``ref_key``, ``block`` and ``comm_ord`` order the rows as they are read; whoever writes them sorts within documents.
    """
    c = commentaries.select(key, "ref", "commentary_id", F.col("ord").alias("comm_ord"), F.col("content").alias("commentary"))
    return passages.join(c, [key, "ref"], "left")


def routed(parts: DataFrame, keys: list[str], part: str = "part_num") -> DataFrame:
    """One row for each reference: that of the last part that has it."""
    return last_by(parts, keys, [F.col(part)])


def uncovered(commentaries: DataFrame, passages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ref, member): members of ranged references without a passage; also of single ones.

    Members are listed one by one, for ranges of ordinary size; ``ranges.coverage_gaps`` tells the gaps of ranges of any size.
    """
    members = commentaries.select(key, "ref", F.explode(expanded(F.col("ref"))).alias("member"))
    return members.join(passages.select(key, F.col("ref").alias("member")).distinct(), [key, "member"], "left_anti").select(key, "ref", "member")


def reference_gaps(used: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem): used but "undeclared", and declared but "unused"."""
    a, b = used.select(*keys).distinct(), declared.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("problem", F.lit("undeclared")).unionByName(b.join(a, keys, "left_anti").withColumn("problem", F.lit("unused")))


def _best_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (_row, left_id, right_id, _a, _b) those that no other of their row in a batch excels, with ``score``.

    The nearest lengths come first; what the lengths show to be worse than a pair already scored is passed over.
    """
    last, most = None, -1.0  # a row's pairs may go on in the next batch
    for batch in batches:
        rows = batch.column("_row").to_numpy()
        texts = [batch.column(c) for c in ("_a", "_b")]
        m, n = (pc.utf8_length(t).to_numpy(zero_copy_only=False).astype(float) for t in texts)
        bound = np.where(m + n == 0, 100.0, 100.0 * 2 * np.minimum(m, n) / np.maximum(m + n, 1))
        best = {last: most}
        kept, scores = [], []
        for k in np.lexsort((-bound, rows)).tolist():
            row = rows[k]
            if bound[k] < best.get(row, -1.0):
                continue
            score = ratio(texts[0][k].as_py(), texts[1][k].as_py())
            if score >= best.get(row, -1.0):
                best[row] = score
                kept.append(k)
                scores.append(score)
        some = [i for i, k in enumerate(kept) if scores[i] == best[rows[k]]]
        if len(rows):
            last, most = rows[-1], best[rows[-1]]
        out = batch.take(pa.array([kept[i] for i in some], pa.int64()))
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array([scores[i] for i in some], pa.float64())], names=[*out.schema.names, "score"])


def best_match(left: DataFrame, right: DataFrame, block: list[str], left_text: str = "text", right_text: str = "text", left_id: str = "id", right_id: str = "id", least: float = 0.0, texts: bool = False) -> DataFrame:
    """(left id, right id, score): for every left row the most similar right row of its block; ``texts``: also both texts.

    ``block``: columns both sides share; only rows of one block are compared, so keep blocks small
    (a directory, a rare shared word).  Of equal scores the smallest identifier wins.  Rows without a text take no part.
    """
    a = left.where(F.col(left_text).isNotNull()).select(*block, F.col(left_id).alias("left_id"), F.col(left_text).alias("_a")).withColumn("_row", F.monotonically_increasing_id())
    b = right.where(F.col(right_text).isNotNull()).select(*block, F.col(right_id).alias("right_id"), F.col(right_text).alias("_b"))
    pairs = a.join(b, block).select("_row", "left_id", "right_id", "_a", "_b")
    scored = pairs.mapInArrow(_best_of_rows, T.StructType([*pairs.schema.fields, T.StructField("score", T.DoubleType())]))
    carried = ["right_id", "_a", "_b"] if texts else ["right_id"]
    best = scored.groupBy("left_id").agg(F.min(F.struct((-F.col("score")).alias("s"), *carried)).alias("r"))
    return best.select("left_id", *[f"r.{c}" for c in carried], (-F.col("r.s")).alias("score")).where(F.col("score") >= least)


def nearest(left: DataFrame, right: DataFrame, left_text: str = "text", right_text: str = "text", left_id: str = "id", right_id: str = "id", block_chars: int = 1_000_000) -> DataFrame:
    """(left id, right id, score): for every left row the most similar of all right rows.

    As ``best_match`` with one block: nothing is left out but what the lengths show to be worse than a row already
    seen.  The left side is meant to be small; its texts go to every task, ``block_chars`` at a time, the right
    side is read once for each such block, and only each task's best rows are shuffled.
    """

    def scan(items: list[tuple[int, str]]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            packs = Nearest(items)
            for batch in batches:
                packs.add(batch["_id"].tolist(), batch["_text"].tolist())
            yield pd.DataFrame(packs.best(), columns=["left_id", "right_id", "score"])

        return run

    rows = right.where(F.col(right_id).isNotNull() & F.col(right_text).isNotNull()).select(F.col(right_id).cast("long").alias("_id"), F.col(right_text).alias("_text"))
    found = left.sparkSession.createDataFrame([], "left_id long, right_id long, score double")
    items: list[tuple[int, str]] = []
    size = 0
    for r in left.where(F.col(left_id).isNotNull() & F.col(left_text).isNotNull()).select(left_id, left_text).toLocalIterator():
        if items and size + len(r[1]) > block_chars:
            found = found.unionByName(rows.mapInPandas(scan(items), found.schema))
            items, size = [], 0
        items.append((r[0], r[1]))
        size += len(r[1])
    if items:
        found = found.unionByName(rows.mapInPandas(scan(items), found.schema))
    return found.groupBy("left_id").agg(F.max_by("right_id", F.struct("score", -F.col("right_id"))).alias("right_id"), F.max("score").alias("score"))


def zipped(left: DataFrame, right: DataFrame, name: str = "name", by: list[str] | None = None) -> DataFrame:
    """Both sides in order of name, first with first; as many as the shorter side has.

    ``by``: columns within which to number; without them a side is one group, meant for file lists.
    """
    by = by or []

    def numbered(df: DataFrame, side: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(name)
        return df.select(*by, F.row_number().over(w).alias("n"), F.col(name).alias(f"{side}_{name}"))

    return numbered(left, "left").join(numbered(right, "right"), [*by, "n"])


def cache_hits(inputs: DataFrame, cache: DataFrame, on: list[str], fresh: Column) -> DataFrame:
    """Inputs whose key stands in the cache with a fresh entry."""
    return inputs.join(cache.where(fresh), on, "left_semi")


def still_to_do(inputs: DataFrame, outputs: DataFrame, stem: str = "stem", out_stem: str = "stem", size: str = "size") -> DataFrame:
    """Inputs without an output of the same stem that has any bytes."""
    done = outputs.where(F.col(size) > 0).select(F.col(out_stem).alias(stem)).distinct()
    return inputs.join(done, stem, "left_anti")


def stem_of(path: Column) -> Column:
    """A file name without folders and last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), "\\.[^.]*$", "")


def commentary_at(commentaries: DataFrame, commentary_id: str, ref: str, key: str = "doc_id") -> DataFrame:
    """The commentary with an identifier on a reference; of repeated ones the last."""
    return last_by(commentaries.where((F.col("commentary_id") == commentary_id) & (F.col("ref") == ref)), [key], [F.col("block")])


def renamed_commentaries(commentaries: DataFrame, names: DataFrame, key: str = "doc_id") -> DataFrame:
    """Commentary rows with new identifiers.

    ``names``: (key, old, new), arrays; the identifier at a place of ``old`` becomes the one at that place of ``new``.
    """
    pairs = F.filter(F.arrays_zip("old", "new"), lambda p: p["old"].isNotNull() & p["new"].isNotNull() & (p["old"] != p["new"]))
    changes = names.select(key, F.inline(pairs)).withColumnRenamed("old", "commentary_id")
    return commentaries.join(changes, [key, "commentary_id"], "left").withColumn("commentary_id", F.coalesce("new", "commentary_id")).drop("new")


def round_trip(left: DataFrame, right: DataFrame, key: str = "doc_id", value: str = "hash") -> DataFrame:
    """(key, same): whether both sides have a document with the same fingerprint."""
    joined = left.select(key, F.col(value).alias("_a")).join(right.select(key, F.col(value).alias("_b")), key, "full")
    return joined.select(key, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("same"))
