"""Hierarchical references such as 3.1.2, and ranges of them, as integer arrays that order as they should."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref_parts(ref: Column) -> Column:
    """[3, 1, 2] of "3.1.2"; null stands for a part that is no integer."""
    return F.split(ref, "\\.").try_cast("array<int>")


def ref_key(ref: Column) -> Column:
    """[3, 1, 2] of "3.1.2"; null if any part is no integer.  Arrays compare part by part."""
    return F.when(~F.exists(ref_parts(ref), lambda x: x.isNull()), ref_parts(ref))


def compare_refs(a: Column, b: Column) -> Column:
    """-1, 0 or 1; null if one is malformed."""
    x, y = ref_key(a), ref_key(b)
    return F.when(x < y, -1).when(x > y, 1).when(x == y, 0)


def ref_range(ref: Column) -> Column:
    """Struct (start, end) of "a-b"; (x, x) of "x"; null with more than one dash."""
    parts = F.split(ref, "-")
    return F.when(F.size(parts) == 1, F.struct(ref.alias("start"), ref.alias("end"))).when(F.size(parts) == 2, F.struct(F.get(parts, F.lit(0)).alias("start"), F.get(parts, F.lit(1)).alias("end")))


def expanded(ref: Column) -> Column:
    """Members of "1.1.2-4" (its last part counts up); [ref] without a dash; null if malformed."""
    tail = F.regexp_extract(ref, "^(?:(.*)\\.)?(\\d+)-(\\d+)$", 1)
    lo, hi = (F.regexp_extract(ref, "^(?:(.*)\\.)?(\\d+)-(\\d+)$", k).try_cast("int") for k in (2, 3))
    prefix = F.when(tail == "", F.lit("")).otherwise(F.concat(tail, F.lit(".")))
    return F.when(~F.contains(ref, F.lit("-")), F.array(ref)).when(lo <= hi, F.transform(F.sequence(lo, hi), lambda k: F.concat(prefix, k.cast("string"))))


def in_range(ref: Column, start: Column, end: Column) -> Column:
    """Whether start <= ref <= end, part by part."""
    return ref_key(ref).between(ref_key(start), ref_key(end))


def ancestors(ref: Column) -> Column:
    """Keys of all levels from the top to the reference itself."""
    key = ref_key(ref)
    return F.transform(F.sequence(F.lit(1), F.size(key)), lambda n: F.slice(key, F.lit(1), n))
