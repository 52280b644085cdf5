"""Small tables are written in few files, however many shuffle partitions there are."""

from __future__ import annotations

from scriptorium.llm import components, minhash_dedup, shared


def test_few_files_for_small_tables(spark, monkeypatch):
    made = []

    def written(df, label):
        out = shared.written(df, label)
        made.append((label, len(out.inputFiles())))
        return out

    for module in (components, minhash_dedup):
        monkeypatch.setattr(module, "written", written)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        base = [f"w{i * 7919 % 1009}" for i in range(120)]
        rows = [(g * 100 + k, " ".join([f"g{g}x{w}" for w in base[k:]])) for g in range(60) for k in range(4)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {i: i // 100 * 100 for i, _ in rows}
    small = {"stars", "classes", "representatives", "buckets", "members", "confirmed", "sets", "mixed-buckets"}
    assert {label for label, _ in made} >= {"stars", "classes", "buckets", "members", "confirmed", "sets"}
    assert all(n == 1 for label, n in made if label in small), made
