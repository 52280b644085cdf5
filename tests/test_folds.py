"""Directory digests, trees and edit logs against plain folds."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import digest, edit_log, fingerprint, tree


@pytest.mark.parametrize("size", [1, 7, 64 << 10])
def test_directory_digests(spark, size):
    rng = random.Random(size)
    rows = [(f"d{k % 5}", f"{rng.randrange(10**6)}é{k}.md", bytes(rng.randrange(256) for _ in range(rng.choice((0, 1, 6, 7, 8, 50))))) for k in range(80)]
    rows += [("d9", "one", None), ("", "x", b"y"), (None, "n", b"z")]
    files = spark.createDataFrame(rows, "dir string, path string, content binary").repartition(3)
    got = {r["dir"]: (r["hash"], r["n_files"], r["n_bytes"]) for r in digest.directory_digests(files, size=size).collect()}
    want = {}
    for d in {r[0] for r in rows}:
        h, mine = hashlib.sha256(), sorted((p.encode(), c or b"") for e, p, c in rows if e == d)
        for p, c in mine:
            h.update(p + c)
        want[d] = (h.hexdigest(), len(mine), sum(len(c) for _, c in mine))
    assert got == want
    other = {r["dir"]: r["hash"] for r in fingerprint.directory_hash(files.where("content IS NOT NULL")).collect()}
    assert all(want[d][0] == h for d, h in other.items())
    assert digest.directory_digests(files.limit(0)).count() == 0


def test_a_directory_spans_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        files = spark.createDataFrame([("d", f"{k:03d}", b"ab" * k) for k in range(40)], "dir string, path string, content binary")
        want = hashlib.sha256(b"".join(f"{k:03d}".encode() + b"ab" * k for k in range(40))).hexdigest()
        assert [r["hash"] for r in digest.directory_digests(files, size=5).collect()] == [want]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def plain_tree(passages):
    top = {}
    for ref, value in passages:
        at, parts = top, ref.split(".")
        for i, part in enumerate(parts):
            node = at.setdefault(part, {"_passages": [], "_children": {}})
            if i + 1 == len(parts):
                node["_passages"].append(value)
            at = node["_children"]
    order = lambda t: {k: {"_passages": t[k]["_passages"], "_children": order(t[k]["_children"])} for k in sorted(t, key=lambda x: (not x.isdigit(), int(x) if x.isdigit() else 0, x))}
    return order(top)


def test_hierarchy_trees(spark):
    rng = random.Random(7)
    rows = [(d, ".".join(str(rng.choice([1, 2, 9, 10, 11])) for _ in range(rng.randrange(1, 5))), k, f'p"{k}') for k in range(200) for d in [rng.randrange(4)]]
    rows += [(0, "x.1", 300, "word"), (0, "01", 301, "zero"), (0, None, 302, "none"), (5, "3", 1, "alone"), (6, "1.2.3.4.5", 1, "deep")]
    df = spark.createDataFrame(rows, "doc_id int, ref string, seq int, text string")
    value = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), '^\\{"t":(.*)\\}$', 1)
    got = {r["doc_id"]: r["tree"] for r in tree.hierarchy_trees(df, value).collect()}
    want = {d: plain_tree([(r, t) for e, r, _, t in sorted((x for x in rows if x[0] == d and x[1] is not None), key=lambda x: x[2])]) for d in got}
    assert set(got) == {0, 1, 2, 3, 5, 6} and {d: json.loads(t) for d, t in got.items()} == want
    assert all(json.dumps(json.loads(got[d])) == json.dumps(want[d]) for d in got)  # also in order
    assert tree.hierarchy_trees(df.limit(0), value).count() == 0


def plain_fold(edits):
    main, around, notes, wrong = {}, {0: [], 2: []}, {}, []
    for v, s, action, ref, kind, label, cid, content in edits:
        if action == "add" and kind in ("prefatory", "concluding"):
            around[0 if kind == "prefatory" else 2].append((ref, kind, label, content))
        elif action == "add":
            main[ref] = (ref, "main", label, content)
        elif action == "update":
            if ref in main:
                main[ref] = (*main[ref][:3], content)
            else:
                wrong.append((v, s, ref))
        elif action == "remove":
            main.pop(ref, None)
        elif action == "comment":
            notes.setdefault(cid, []).append((ref, content))
    return [*around[0]], list(main.values()), [*around[2]], notes, wrong


@pytest.mark.parametrize("seed", range(6))
def test_edit_log(spark, seed):
    rng = random.Random(seed)
    data, plain = [], {}
    for w in range(4):
        edits = []
        for k in range(rng.choice((0, 5, 60))):
            action = rng.choice(["add", "add", "update", "update", "remove", "comment"])
            edits.append((k // 7, k % 7, action, str(rng.randrange(5)), rng.choice(["main", "main", "prefatory", "concluding"]) if action == "add" else None, rng.choice([None, f"l{k}"]), rng.choice("ab") if action == "comment" else None, f"text {k}"))
        plain[w] = plain_fold(edits)
        data += [(w, *e, None) for e in edits]
        data += [(w, *e, None) for e in edits if e[0] == 1]  # a batch that was written twice
    schema = "work_id int, version int, seq int, action string, ref string, passage_type string, label string, commentary_id string, content string, value string"
    df = spark.createDataFrame(data, schema).repartition(3)
    passages, notes = edit_log.folded(df)
    got = {w: {0: [], 1: [], 2: []} for w in range(4)}
    for r in sorted(passages.collect(), key=lambda r: r["n"]):
        got[r["work_id"]][r["section"]].append((r["ref"], r["passage_type"], r["label"], r["content"]))
    assert all(got[w] == {0: p[0], 1: p[1], 2: p[2]} for w, p in plain.items())
    said = {}
    for r in sorted(notes.collect(), key=lambda r: r["n"]):
        said.setdefault((r["work_id"], r["commentary_id"]), []).append((r["ref"], r["content"]))
    assert said == {(w, c): v for w, p in plain.items() for c, v in p[3].items()}
    wrong = edit_log.problems(df, needed=()).where("problem = 'update_without_passage'").collect()
    assert sorted((r["work_id"], r["version"], r["seq"], r["detail"]) for r in wrong) == sorted((w, *x) for w, p in plain.items() for x in p[4])


def test_build_checks(spark):
    schema = "work_id int, version int, seq int, action string, ref string, passage_type string, label string, commentary_id string, content string, value string"
    row = lambda w, s, action, ref, value=None: (w, 0, s, action, ref, None, None, None, "t", value)
    data = [row(1, 0, "set", "grantha_id", "g"), row(1, 1, "set", "canonical_title", "old"), row(1, 2, "set", "canonical_title", "new"), row(1, 3, "add", "1"),
            row(2, 0, "set", "grantha_id", ""), row(2, 1, "add", "1"), row(2, 2, "remove", "1"), row(2, 3, "fly", "1")]
    df = spark.createDataFrame(data, schema)
    assert {(r["work_id"], r["name"], r["value"]) for r in edit_log.fields(df).collect()} == {(1, "grantha_id", "g"), (1, "canonical_title", "new"), (2, "grantha_id", "")}
    assert sorted((r["work_id"], r["problem"], r["detail"] or "") for r in edit_log.problems(df).collect()) == [(2, "missing_field", "canonical_title"), (2, "missing_field", "grantha_id"), (2, "no_passage", ""), (2, "unknown_action", "fly")]
