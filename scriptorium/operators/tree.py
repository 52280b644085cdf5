"""Nested trees of passages, folded from the leaves up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _quoted(text: Column) -> Column:
    """A text as JSON."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("t"))), "^\\{\"t\":(.*)\\}$", 1)


def hierarchy_trees(passages: DataFrame, value: Column, key: str = "doc_id", ref: str = "ref", seq: str = "seq") -> DataFrame:
    """(key, tree): each document's passages as one JSON object, a level for each part of their references.

    A node is ``{"_passages": [...], "_children": {...}}`` under its part; ``value`` is a passage as JSON text.  Children stand in the order of their
    numbers, then those that are no numbers in theirs; a node's passages in the order of ``seq``.  The fold goes up one
    level at a time: nodes of the deepest level are gathered into their parents, whose own passages join them.  So each step is an
    aggregation by parent, and only the last holds a whole document.

    Defined cases: passages may stand on any level, also above others; parts are compared as texts ("01" is not "1") and ordered as numbers, equal
    numbers by text; a null reference is left out; repeated references share a node; a document without passages gives no row.
    """
    rows = passages.where(F.col(ref).isNotNull()).select(key, F.split(ref, "[.]").alias("node"), F.col(seq).alias("seq"), value.alias("value"))
    own = rows.groupBy(key, "node").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda x: x["value"]), ",").alias("own"))
    deepest = own.agg(F.max(F.size("node")).alias("d")).first()["d"]  # one number: the levels of the fold
    if deepest is None:
        return own.select(key, F.lit("{}").alias("tree"))
    below = own.select(key, "node", F.lit(None).cast("string").alias("own"), F.lit(None).cast("string").alias("children")).limit(0)
    for depth in range(deepest, 0, -1):
        level = own.where(F.size("node") == depth).select(key, "node", "own", F.lit(None).cast("string").alias("children")).unionByName(below)
        nodes = level.groupBy(key, "node").agg(F.max("own").alias("own"), F.max("children").alias("children"))
        part = F.element_at("node", -1)
        text = F.concat(_quoted(part), F.lit(':{"_passages":['), F.coalesce("own", F.lit("")), F.lit('],"_children":{'), F.coalesce("children", F.lit("")), F.lit("}}"))
        number = F.when(part.rlike("^[0-9]+$"), part.cast("decimal(38,0)"))
        placed = nodes.select(key, F.slice("node", F.lit(1), F.size("node") - 1).alias("node"), F.struct(number.isNull().alias("word"), number.alias("number"), part.alias("part"), text.alias("text")).alias("c"))
        gathered = placed.groupBy(key, "node").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["text"]), ",").alias("children"))
        below = gathered.select(key, "node", F.lit(None).cast("string").alias("own"), "children")
    return below.select(key, F.concat(F.lit("{"), F.col("children"), F.lit("}")).alias("tree"))
