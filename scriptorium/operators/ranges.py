"""Range joins over hierarchical references, without one row for each member of a range.

References order part by part, and a reference stands before those below it.  A range is put into bins: of its two ends, the parts they share are the
bin's prefix, and the first part in which they differ is cut into bins of 16^level, of which a range meets at most 17 whatever
its size.  The least bins are 16 wide: narrower ones would cost small ranges a row for each part, and every point a look more.  A point is
looked up once for each pair of prefix length and level that any range uses (at most eight levels for each length).  The exact
order is a filter on top, so prefixes are joined by a hash alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.refs import ref_parts

#: Bits in a step of levels, and the levels: bins are 16, 256, ... parts wide.
STEP, LEVELS = 4, range(1, 9)


def _part(key: Column, at: Column) -> Column:
    """The part after the first ``at`` ones, from 1 on; 0 where the reference ends there."""
    return F.coalesce(F.get(key, at).cast("long") + 1, F.lit(0).cast("long"))


def _shared(a: Column, b: Column) -> Column:
    """How many first parts two keys share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(a)).cast("int")


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with columns that are worked out once a row, however often they are used: a filter on a generated column is not moved
    below it, where the column would be put in again as often as the filter names it."""
    return rows.drop(*columns).select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _levelled(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Ranges in order with the number of parts their ends share, the parts after these, and the level of their bins."""
    a, b = F.col(start), F.col(end)
    known = _once(ranges.where(a <= b), _length=_shared(a, b))
    known = _once(known, _lowest=_part(a, F.col("_length")), _highest=_part(b, F.col("_length")))
    level = F.coalesce(*[F.when(F.shiftright("_highest", STEP * n) - F.shiftright("_lowest", STEP * n) <= 16, F.lit(n)) for n in LEVELS])
    return _once(known, _level=level)


def _shifted(part: Column) -> Column:
    return F.call_function("shiftright", part, F.col("_level") * STEP)


def in_bins(ranges: DataFrame, start: str = "_a", end: str = "_b") -> DataFrame:
    """Ranges with their bins: (_length, _level, _prefix, _bin) each; the prefix as a hash."""
    known = _levelled(ranges, start, end).withColumn("_prefix", F.xxhash64(F.slice(F.col(start), F.lit(1), F.col("_length"))))
    return known.withColumn("_bin", F.explode(F.sequence(_shifted(F.col("_lowest")), _shifted(F.col("_highest"))))).drop("_lowest", "_highest")


def _placed(rows: DataFrame, key: str) -> DataFrame:
    """Bins as two numbers: ``_look``, length and level; ``_at``, one number a bin, which bins of one range do not share.

    Rows are sorted by ``_at`` first, where few are alike.  Bins that share it by chance only cost a look: the order of references decides.
    """
    at = F.xxhash64(key, "_length", "_level", "_prefix").bitwiseXOR(F.col("_bin"))
    return rows.withColumn("_at", at).withColumn("_look", F.col("_length") * 16 + F.col("_level")).drop("_length", "_level", "_prefix", "_bin")


def containing(points: DataFrame, ranges: DataFrame, key: str = "doc_id") -> DataFrame:
    """Points (key, ref) with the ranges (key, start, end) they lie in, ends included.

    Defined cases: a malformed reference, or a range whose end stands before its start, meets nothing; a point in several ranges, and
    repeated ranges, have a row each.
    """
    formed = lambda c: F.forall(c, lambda x: x.isNotNull())
    keyed = _once(ranges, _a=ref_parts(F.col("start")), _b=ref_parts(F.col("end"))).where(formed("_a") & formed("_b"))
    used = _levelled(keyed.select("_a", "_b"), "_a", "_b").select("_length", "_level").distinct().collect()  # at most eight levels for each length that a reference has
    p = _once(points, _k=ref_parts(F.col("ref"))).where(formed("_k"))
    looks = F.array(*[F.struct(F.lit(r["_length"]).alias("_length"), F.lit(r["_level"]).alias("_level")) for r in used]) if used else F.array().cast("array<struct<_length:int,_level:int>>")
    p = p.select("*", F.inline(looks)).where(F.col("_length") <= F.size("_k"))
    p = p.withColumn("_prefix", F.xxhash64(F.slice("_k", F.lit(1), F.col("_length")))).withColumn("_bin", _shifted(_part(F.col("_k"), F.col("_length"))))
    joined = _placed(p, key).join(_placed(in_bins(keyed), key), ["_at", key, "_look"])
    return joined.where(F.col("_k").between(F.col("_a"), F.col("_b"))).drop("_k", "_a", "_b", "_at", "_look")


def coverage_gaps(commentaries: DataFrame, passages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ref, first, last, n): stretches of members of "a.b-c" references that have no passage, as numbers of the last part.

    A single reference is a range of one.  Members are never listed: passages below the range's prefix are ordered, and what lies between
    neighbours is a gap, so a range of a thousand million members costs as many rows as it has gaps.
    """
    pattern = "^(?:(.*)\\.)?(\\d+)(?:-(\\d+))?$"
    part = lambda k: F.regexp_extract("ref", pattern, k)
    wanted = commentaries.select(key, "ref").distinct().withColumn("_top", part(1)).withColumn("_lo", part(2).try_cast("long"))
    wanted = wanted.withColumn("_hi", F.when(part(3) == "", F.col("_lo")).otherwise(part(3).try_cast("long"))).where("_lo <= _hi")
    there = passages.select(key, "ref").distinct().withColumn("_top", part(1)).withColumn("n", part(2).try_cast("long")).where(~F.contains("ref", F.lit("-")) & F.col("n").isNotNull())
    points = there.select(key, F.array("n").alias("_k"), "_top", F.col("n").cast("string").alias("ref"), "n")
    # one number a member: the prefix is part of the key
    a = wanted.select(F.struct(F.col(key).alias("k"), F.col("_top").alias("top")).alias("_of"), F.col("_lo").cast("string").alias("start"), F.col("_hi").cast("string").alias("end"), F.col("ref").alias("range_ref"), "_lo", "_hi")
    b = points.select(F.struct(F.col(key).alias("k"), F.col("_top").alias("top")).alias("_of"), "ref", "n")
    inside = containing(b, a, "_of").select("_of", "range_ref", "_lo", "_hi", "n")
    ends = a.select("_of", "range_ref", "_lo", "_hi", F.explode(F.array(F.col("_lo") - 1, F.col("_hi") + 1)).alias("n"))
    w = Window.partitionBy("_of", "range_ref").orderBy("n")
    steps = inside.unionByName(ends).withColumn("_next", F.lead("n").over(w)).where("_next > n + 1")
    return steps.select(F.col("_of.k").alias(key), F.col("range_ref").alias("ref"), (F.col("n") + 1).alias("first"), (F.col("_next") - 1).alias("last"), (F.col("_next") - F.col("n") - 1).alias("n"))
