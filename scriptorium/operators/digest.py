"""Digests of whole directories as streams: blocks in order, a running hash, no directory in memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a block.
BLOCK = 64 << 10


def blocks(files: DataFrame, by: str = "dir", path: str = "path", content: str = "content", size: int = BLOCK) -> DataFrame:
    """(by, path, n, block): the bytes of each file, cut; an empty file has one empty block."""
    data = F.coalesce(F.col(content).cast("binary"), F.lit("").cast("binary"))
    cuts = F.sequence(F.lit(0).cast("int"), F.greatest(F.lit(0), F.ceil(F.octet_length(data) / size) - 1).cast("int"))
    rows = files.select(F.col(by).alias("by"), F.encode(F.col(path).cast("string"), "UTF-8").alias("path"), data.alias("data"), F.explode(cuts).alias("n"))
    return rows.select("by", "path", "n", F.substring("data", F.col("n") * size + 1, F.lit(size)).alias("block"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each directory; a directory may span batches."""
    now, running, n_files, n_bytes = None, None, 0, 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([running.hexdigest()]), pa.array([n_files], pa.int64()), pa.array([n_bytes], pa.int64())], names=["by", "hash", "n_files", "n_bytes"])

    for batch in batches:
        for by, path, n, block in zip(*(batch.column(c) for c in range(4))):
            if running is None or by.as_py() != now:
                if running is not None:
                    yield row()
                now, running, n_files, n_bytes = by.as_py(), hashlib.sha256(), 0, 0
            if n.as_py() == 0:  # a file begins
                running.update(path.as_buffer() or b"")
                n_files += 1
            running.update(block.as_buffer() or b"")
            n_bytes += len(block.as_buffer() or b"")
    if running is not None:
        yield row()


def directory_digests(files: DataFrame, by: str = "dir", path: str = "path", content: str = "content", size: int = BLOCK) -> DataFrame:
    """(by, hash, n_files, n_bytes): SHA-256 over path and content bytes of each directory's files, in order of their paths' bytes.

    Blocks are dealt by directory and sorted within partitions, where Spark spills what does not fit; each task
    hashes its blocks as they come, so it holds some blocks at a time, however large the directory.  A directory is one chain of
    hashes and thus one task; ``fingerprint.work_hash`` of files' own hashes is the form to choose where that is too slow.

    Defined cases: a null content is an empty file; a null directory is one of its own; paths are taken to be distinct within a directory; an empty table
    gives no rows.
    """
    pieces = blocks(files, by, path, content, size)
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.withColumn("by", F.col("by").cast("string")).repartition(parts, "by").sortWithinPartitions("by", "path", "n")
    found = ordered.mapInArrow(_digests, "by string, hash string, n_files long, n_bytes long")
    return found.select(F.col("by").cast(files.schema[by].dataType).alias(by), "hash", "n_files", "n_bytes")
