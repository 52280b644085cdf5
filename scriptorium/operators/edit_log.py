"""A work built from a log of edits, folded in order, and checked.

An edit is (key, version, seq, action, ref, passage_type, label, commentary_id, content, value).  Actions:

* ``add``: a passage; a main one takes the place of what stands at its reference, a prefatory or concluding one follows those before it;
* ``update``: new content for a main passage that stands there, with its label; anything else is a problem;
* ``remove``: a main passage goes; one that is not there changes nothing;
* ``comment``: a commentary's text on a reference follows that commentary's earlier ones;
* ``set``: the value of a field of the work, named by ``ref``.

Edits are ordered by version and sequence number, and one that stands in the log twice counts once, so a batch may be written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fields that a work must have when it is built.
NEEDED = ("grantha_id", "canonical_title")


def _ordered(edits: DataFrame, key: str) -> DataFrame:
    """The log, each place in it once."""
    once = Window.partitionBy(key, "version", "seq").orderBy(F.xxhash64("action", "ref"))
    return edits.withColumn("_once", F.row_number().over(once)).where("_once = 1").drop("_once").withColumn("_at", F.struct("version", "seq"))


def _main(edits: DataFrame, key: str) -> DataFrame:
    """Edits of main passages, with ``there``: whether one stood at the reference before."""
    order = Window.partitionBy(key, "ref").orderBy("_at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    main = edits.where("action IN ('update', 'remove') OR action = 'add' AND coalesce(passage_type, 'main') = 'main'")
    last = F.last(F.when(F.col("action").isin("add", "remove"), F.col("action")), ignorenulls=True).over(before)
    return main.withColumn("there", F.coalesce(last == "add", F.lit(False)))


def folded(edits: DataFrame, key: str = "work_id") -> tuple[DataFrame, DataFrame]:
    """(passages, commentaries) after all edits.

    Passages: (key, section, n, ref, passage_type, label, content), numbered from 0 within their section; a main passage keeps the place of its
    first addition since it was last removed.  Commentaries: (key, commentary_id, n, ref, content).
    """
    log = _ordered(edits, key)
    order = Window.partitionBy(key, "ref").orderBy("_at")
    main = _main(log, key)
    # what one addition, and the edits on top of it, make is a life; a removal ends it
    main = main.withColumn("_life", F.sum(F.when((F.col("action") == "add") & ~F.col("there"), 1).otherwise(0)).over(order)).where("there OR action = 'add'")
    first_of = main.groupBy(key, "ref", "_life").agg(
        F.min("_at").alias("_at"), F.max_by("content", F.when(F.col("action").isin("add", "update"), F.col("_at"))).alias("content"),
        F.max_by("label", F.when(F.col("action") == "add", F.col("_at"))).alias("label"), F.max(F.col("action") == "remove").alias("gone"),
    )
    standing = first_of.where("NOT gone").select(key, F.lit(1).alias("section"), "_at", "ref", F.lit("main").alias("passage_type"), "label", "content")
    around = log.where("action = 'add' AND passage_type IN ('prefatory', 'concluding')")
    around = around.select(key, F.when(F.col("passage_type") == "prefatory", 0).otherwise(2).alias("section"), "_at", "ref", "passage_type", "label", "content")
    number = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("_at")) - 1
    passages = standing.unionByName(around).withColumn("n", number(key, "section")).select(key, "section", "n", "ref", "passage_type", "label", "content")
    notes = log.where("action = 'comment'").withColumn("n", number(key, "commentary_id")).select(key, "commentary_id", "n", "ref", "content")
    return passages, notes


def fields(edits: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, name, value): the last value set of each field."""
    sets = _ordered(edits, key).where("action = 'set'")
    return sets.groupBy(key, F.col("ref").alias("name")).agg(F.max_by("value", "_at").alias("value"))


def problems(edits: DataFrame, key: str = "work_id", needed: tuple[str, ...] = NEEDED) -> DataFrame:
    """(key, version, seq, problem, detail) of a log: updates without a passage, unknown actions; and what forbids a build (null version and seq).

    A build needs every field of ``needed``, not empty, and at least one main passage.
    """
    log = _ordered(edits, key)
    missing = _main(log, key).where("action = 'update' AND NOT there").select(key, "version", "seq", F.lit("update_without_passage").alias("problem"), F.col("ref").alias("detail"))
    known = ("add", "update", "remove", "comment", "set")
    odd = log.where(F.col("action").isNull() | ~F.col("action").isin(*known)).select(key, "version", "seq", F.lit("unknown_action").alias("problem"), F.col("action").alias("detail"))
    every = log.select(key).distinct()
    none = F.lit(None).cast("long")
    wanted = every.select(key, F.explode(F.array(*map(F.lit, needed))).alias("name"))
    unset = wanted.join(fields(edits, key).where("value <> ''"), [key, "name"], "left_anti").select(key, none.alias("version"), none.alias("seq"), F.lit("missing_field").alias("problem"), F.col("name").alias("detail"))
    empty = every.join(folded(edits, key)[0].where("section = 1"), key, "left_anti").select(key, none.alias("version"), none.alias("seq"), F.lit("no_passage").alias("problem"), F.lit(None).cast("string").alias("detail"))
    long = lambda df: df.select(key, F.col("version").cast("long").alias("version"), F.col("seq").cast("long").alias("seq"), "problem", "detail")
    return long(missing).unionByName(long(odd)).unionByName(unset).unionByName(empty)
