"""Best matches in blocks: the nearest lengths first, what cannot gain passed over; headers cleaned off in one step."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.functions.markup import cleaned
from scriptorium.operators import align, link


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = ["".join(rng.choice("abc ") for _ in range(rng.randrange(40))) for _ in range(30)]
    return [*made, made[0], made[1] + "zz", "", ""]


def test_every_batching_gives_the_best(rows, monkeypatch):
    tried = []
    monkeypatch.setattr(link, "ratio", lambda a, b: tried.append(1) or align.ratio(a, b))
    pairs = [(i, i, j, a, b) for i, a in enumerate(rows) for j, b in enumerate(rows) if i != j]
    want = {}
    for i, _, j, a, b in pairs:
        want.setdefault(i, []).append((-align.ratio(a, b), j))
    for size in (7, 100, len(pairs)):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs[k : k + size])], names=["_row", "left_id", "right_id", "_a", "_b"]) for k in range(0, len(pairs), size)]
        got = {}
        for batch in link._best_of_rows(iter(batches)):
            for r in batch.to_pylist():
                got.setdefault(r["left_id"], []).append((-r["score"], r["right_id"]))
        assert {i: min(x) for i, x in got.items()} == {i: min(x) for i, x in want.items()}
    assert len(tried) < 2 * len(pairs)  # of three times all pairs


def test_missing_texts_take_no_part(spark, rows):
    left = spark.createDataFrame([("d", 1, "one two"), ("d", 2, None), ("e", 3, "x")], "dir string, id long, text string")
    right = spark.createDataFrame([("d", 10, None), ("d", 12, "one twö"), ("d", 11, "one twö"), ("e", 13, None)], "dir string, id long, text string")
    got = link.best_match(left, right, ["dir"], texts=True).collect()
    assert [(r["left_id"], r["right_id"], r["_a"], r["_b"]) for r in got] == [(1, 11, "one two", "one twö")]


def test_headers_as_by_parts(spark):
    texts = ["---\na: b\n---\nbody --- more", "--- open only", "------x", "-----", "+++\na\n+++ b", "---x---+++y+++z", "no --- header --- here", "  ---\nq\n---  ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def by_parts(t):
        for mark in ("---", "+++"):
            parts = t.split(mark, 2)
            t = parts[2] if t.startswith(mark) and len(parts) == 3 else t
        return " ".join(t.split())

    plan = df.select(cleaned(F.col("t")).alias("c"))
    assert [r["c"] for r in plan.collect()] == [None if t is None else by_parts(t.strip()) for t in texts]
    assert plan._jdf.queryExecution().analyzed().toString().count("t#") <= 4  # named once, not at each step
