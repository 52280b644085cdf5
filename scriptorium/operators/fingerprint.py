"""Fingerprints of texts, passages, works, files and directories, and the gates that compare them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.script import DEVANAGARI, script_text
from .digest import directory_digests

#: Fixed value: the version of the fingerprint's definition.
HASH_VERSION = 3


def text_hash(c: Column, chars: str = DEVANAGARI) -> Column:
    """SHA-256 of the script's words joined by one space, lower-case hex."""
    return F.sha2(script_text(c, chars), 256)


def work_hash(records: DataFrame, key: str = "work_id", chars: str = DEVANAGARI) -> DataFrame:
    """(key, hash, n_records) from records (key, section int, seq, text): in order, nothing between."""
    ordered = F.array_sort(F.collect_list(F.struct("section", "seq", F.coalesce("text", F.lit("")).alias("text"))))
    text = F.array_join(F.transform(ordered, lambda x: x["text"]), "")
    return records.groupBy(key).agg(text.alias("_t"), F.count("*").alias("n_records")).select(key, text_hash(F.col("_t"), chars).alias("hash"), "n_records")


def file_hashes(files: DataFrame) -> DataFrame:
    """(path, sha256, size_bytes) of rows of the ``binaryFile`` source."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def directory_hash(files: DataFrame, by: str = "dir", path: str = "path", content: str = "content") -> DataFrame:
    """(by, hash): SHA-256 over the path and content bytes of a directory's files in order of path."""
    return directory_digests(files, by, path, content).select(by, "hash")


def hash_gate(body: Column, version: Column, expected: Column, chars: str = DEVANAGARI, current: int = HASH_VERSION) -> Column:
    """The first of: version_missing, version_mismatch, hash_missing, hash_mismatch; else ok."""
    plain = F.regexp_replace(expected, "^sha256:", "")
    return (
        F.when(version.isNull(), "version_missing")
        .when(version != current, "version_mismatch")
        .when(expected.isNull(), "hash_missing")
        .when(plain != text_hash(body, chars), "hash_mismatch")
        .otherwise("ok")
    )


def version_compatible(data: Column, required: Column) -> Column:
    """Same major version, and a minor version not below the required one."""
    d, r = F.split(data, "[.]"), F.split(required, "[.]")
    part = lambda a, k: F.get(a, F.lit(k)).try_cast("int")
    return (part(d, 0) == part(r, 0)) & (part(d, 1) >= part(r, 1))
