"""The queries over whole tables that apply the training-data operators, and their SQL.

Three queries (q17, q19, q20) compare near-duplicate documents with the engine's alignment.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import script
from ..operators import align, rollup
from .centroids import cluster_vectors
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .html_extract import extract_main_text
from .license_scan import scan_licenses
from .lm_score import lm_scores
from .minhash_dedup import near_duplicates
from .packing import pack_documents
from .periodic_runs import listed, periodic_runs, strongest
from .shared import row_key, written
from .simhash_dedup import simhash_duplicates
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import score_toxicity


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, threshold=0.85)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(_table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("detections")


def q71_license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of the licence scan: the base phrases."""
    return op4_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="last")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"), width=64, scale=64, k=16, rounds=3, seed=1)


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, threshold=4)


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Texts of which every tenth (by the checksum of its doc_id) repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).alias("words"))
    sized = words.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    sized = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    a, p, rest = F.col("a").cast("int"), F.col("p").cast("int"), (F.col("n") - F.col("a")).cast("int")
    unit = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    text = F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")).otherwise(F.col("text"))
    return sized.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_periodic_tails(_table(spark, sf_dir, "documents")), least=24, times=3).withColumn("best", strongest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of a near-duplicate class but the class's representative, with that one; whole texts.

    Documents are rows: those with a null or a repeated identifier take part each with its own text; a row that repeats counts once.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", row_key().alias("row"))
    found = written(near_duplicates(docs, id_col="row", shingle_words=3, threshold=0.85).select("row", F.col("component_id").alias("class")).distinct(), "near-classes")
    placed = docs.select("doc_id", "row").distinct().join(found, "row")
    least = placed.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"), F.count("*").alias("n")).where("n > 1").select("class", F.col("least.row").alias("other_row"))
    # only texts of classes with several rows are shuffled further, and repeated rows go after that
    texts = written(docs.join(found.join(least, "class").select("row", "other_row"), "row").dropDuplicates(["row"]), "near-texts")
    others = texts.where("row = other_row").select("other_row", F.col("doc_id").alias("other_id"), F.col("text").alias("other"))
    rows = texts.where("row <> other_row").join(others, "other_row")
    return rows.select(F.col("doc_id").alias("pair_id"), F.col("text").alias("source_text"), F.col("other").alias("output_text"), "other_id")


def q17_diff_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.diff_records(_near_pairs(spark, sf_dir), "pair_id", "source_text", "output_text")


def q19_word_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda c: script.script_words(c, script.LATIN)
    rows = _near_pairs(spark, sf_dir).withColumn("r", align.word_repair("A-Za-zÀ-ÿ")("source_text", "output_text"))
    return rows.select("pair_id", "r.success", (words(F.col("r.text")) == words(F.col("source_text"))).alias("restored"))


def q20_diff_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each pair, and their totals (null pair_id and rank)."""
    pairs = _near_pairs(spark, sf_dir)
    # the alignment once, for counts, ranks and totals
    records = written(align.diff_records(pairs, "pair_id", "source_text", "output_text").select("pair_id", "whitespace_only"), "diff-records")
    sized = written(pairs.select("pair_id", F.length("source_text").alias("n_chars"), F.length("output_text").alias("n_other")), "diff-sizes")
    report = rollup.diff_report(sized, records)
    return report.unionByName(rollup.diff_totals(report), allowMissingColumns=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query of this subpackage."""
    return {k: f for k, f in globals().items() if re.match(r"op\d+_|q\d+_", k) and callable(f)}


def _clusters_sql(k: int, rounds: int) -> str:
    """Lloyd's rounds over components as rows, one after the other."""
    parts = [
        """v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "long AS (SELECT n, unnest(range(64)) AS j, unnest(e) AS x FROM v)",
        f"""c0 AS (SELECT c - 1 AS c, unnest(range(64)) AS j, unnest(e) AS y FROM
                   (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) AS c, e FROM v) WHERE c <= {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"d{i} AS (SELECT n, c, sum((x - y) * (x - y)) AS d FROM long JOIN c{i} USING (j) GROUP BY 1, 2)")
        parts.append(f"a{i} AS (SELECT n, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM d{i} GROUP BY 1)")
        if i < rounds:
            parts.append(f"s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS m FROM long JOIN a{i} USING (n) GROUP BY 1, 2)")
            parts.append(f"c{i + 1} AS (SELECT c{i}.c, c{i}.j, CASE WHEN m > 0 THEN CAST((s - ((s % m) + m) % m) // m AS BIGINT) ELSE y END AS y FROM c{i} LEFT JOIN s{i} USING (c, j))")
    parts.append(f"names AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY 1)")
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM a{rounds} JOIN v USING (n) JOIN names USING (c)"""


ORACLES = {
    "op11_centroid_clusters": _clusters_sql(16, 3),
    "op1_minhash_near_dedup": """
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
             s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[k : k + 2], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS k FROM w WHERE len(ws) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
             links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
             reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT a, y FROM reach JOIN links ON b = x),
             least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op3_substring_dedup": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
             starts AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS k, ws FROM w WHERE len(ws) >= 35),
             keyed AS (SELECT doc_id, k, md5(array_to_string(ws[k : k + 34], ' ')) AS h FROM starts),
             hit AS (SELECT doc_id, k FROM keyed WHERE h IN (SELECT h FROM keyed GROUP BY h HAVING count(*) > 1)),
             gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM hit),
             lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
             words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
             kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "q71_license_base": """
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
             p(phrase, label) AS (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
             hits AS (SELECT doc_id, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1] = phrase[1] AND ws[i + 1 : i + len(phrase)] = phrase)) AS place FROM w, p),
             sums AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY 1)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels FROM w LEFT JOIN sums USING (doc_id)""",
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)""",
}
