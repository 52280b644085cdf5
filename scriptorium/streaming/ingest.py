"""Streaming forms: a folder of documents into passages, and content seen once within an age."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.markup import frontmatter
from ..operators.fingerprint import text_hash


def document_stream(spark: SparkSession, path: str, pattern: str = "*.md", files_per_batch: int = 1000) -> DataFrame:
    """(path, modified, text) of files as they appear."""
    rows = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).format("text").option("wholetext", "true").load(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("text"))


def fingerprinted(stream: DataFrame) -> DataFrame:
    """A document stream with bodies and their fingerprints."""
    return stream.withColumn("body", F.coalesce(frontmatter(F.col("text"))["body"], F.col("text"))).withColumn("hash", text_hash(F.col("body")))


def once_within(stream: DataFrame, key: str, time: str, age: str = "48 hours") -> DataFrame:
    """The first row of each key; a key counts as new again once the watermark has passed ``age``."""
    return stream.withWatermark(time, age).dropDuplicatesWithinWatermark([key])


def upserted(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]):  # noqa: ANN201
    """Start the stream; ``apply`` gets each batch and its number, and must be idempotent for a number."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
