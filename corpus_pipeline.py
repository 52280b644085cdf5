"""The corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the
columns of ``documents``.  Decisions are joined back by rows (identifier and
text), so a null or repeated ``doc_id`` takes no other row along.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.decontaminate import decontaminate
from scriptorium.llm.exact_dedup import exact_dedup
from scriptorium.llm.minhash_dedup import near_duplicates
from scriptorium.llm.packing import pack_documents
from scriptorium.llm.queries import tokenizer_path
from scriptorium.llm.shared import dropped, row_key, written
from scriptorium.llm.toxicity import score_toxicity


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go.

    Defined cases: null and empty texts have the score of a text without words and stay; a very long text is scored
    whole; repeated rows share their decision, as do no others; a null ``doc_id`` is a row like any other; without
    usable labels the hand-written lexicons decide; other columns, whatever their names, stay; an empty table stays empty.
    """
    row = _free(docs, "_row")
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), with_key=True)
    toxic = scored.where("predicted = 1").select(F.col("row_key").alias(row)).distinct()
    return docs.withColumn(row, row_key()).join(toxic, row, "left_anti").select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; of rows that repeat it, one.

    Defined cases: null and empty texts are equal; texts of any length are compared whole, after A-Z became a-z; of
    rows with a null ``doc_id`` one stays where no other row has the text; other columns, whatever their names, stay
    (of repeated rows those of any one); an empty table stays empty.
    """
    folded = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    sha, number, none = (_free(docs, x) for x in ("_sha", "_number", "_none"))
    key = [sha, number, none]  # never null, so one exchange serves the join and the choice among repeated rows
    keyed = docs.withColumns({sha: F.sha2(folded, 256), number: F.coalesce("doc_id", F.lit(0)), none: F.col("doc_id").isNull()})
    kept = exact_dedup(docs.select("doc_id", "text"), keep="last").where("kept")
    kept = kept.select(F.col("text_sha256").alias(sha), F.coalesce("doc_id", F.lit(0)).alias(number), F.col("doc_id").isNull().alias(none))
    return keyed.join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component (five words, 0.8) the smallest doc_id stays.

    Defined cases: null, empty and blank texts are linked with nothing and stay; texts of any length are compared whole;
    rows that repeat identifier and text stay or go together; a null ``doc_id`` counts as larger than any other; rows of one
    ``doc_id`` with different texts are different documents; other columns, whatever their names, stay; an empty table stays empty.
    """
    row = _free(docs, "_row")
    keyed = docs.withColumn(row, row_key())
    texts = keyed.select(F.col(row).alias("_row"), "doc_id", "text")
    found = near_duplicates(texts, id_col="_row", shingle_words=5, threshold=0.8).select("_row", "component_id").distinct()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = texts.select("doc_id", "_row").join(found, "_row").groupBy("component_id").agg(least.alias("least")).select(F.col("least._row").alias(row))
    return keyed.join(kept, row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, also an edited one, go.

    Defined cases: null and empty texts hold nothing and stay; all passages of a very long text are searched; repeated
    rows share their decision, as do no others; a null ``doc_id`` is a row like any other; null, empty and repeated
    items do nothing more; other columns, whatever their names, stay; an empty table on either side changes nothing.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, each with its sequence and offset.

    Defined cases: a null or empty text has its end token alone; a text longer than a sequence is cut, and no other;
    repeated rows are packed once each; a null ``doc_id`` stays null; other columns are ignored; an empty table gives
    an empty result.
    """
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: SQL can express neither the scores nor the packing; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again, over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
