"""Findings of round 4."""

import random
from difflib import SequenceMatcher


def test_references_are_parsed_once(spark):
    """parts and levels were put into each other and into filters, so a range was parsed dozens of times."""
    from scriptorium.operators import ranges

    points = spark.createDataFrame([(1, "3.2", 7), (1, "3.x", 8), (1, None, 9)], "doc_id int, ref string, _a int")
    spans = spark.createDataFrame([(1, "3.1", "3.4", 5), (1, "2", "40.1", 6)], "doc_id int, start string, end string, _lo int")
    found = ranges.containing(points.drop("_a"), spans)
    assert sorted((r["ref"], r["_lo"]) for r in found.collect()) == [("3.2", 5), ("3.2", 6)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 3


def test_a_report_makes_differences_once(spark):
    """the part for the ranks read other columns of the differences than the part for the rows, so both made them."""
    from pyspark.sql import functions as F

    from scriptorium.operators import rollup

    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(k):
        made.add(1)
        return k % 3 == 0

    pairs = spark.range(20).select(F.col("id").alias("pair_id"), F.lit(10).alias("n_chars"), F.lit(12).alias("n_other"))
    records = spark.range(200).select((F.col("id") % 10).alias("pair_id"), seen("id").alias("whitespace_only"))
    found = rollup.diff_report(pairs, records).collect()
    assert len(found) == 20 and sum(r["n_space"] + r["n_text"] for r in found) == 200
    assert made.value == 200


def test_runs_by_hash_are_those_of_difflib(monkeypatch):
    """Moved and repeated runs, also with a hash that takes permutations for equal."""
    from scriptorium.operators import align

    rng = random.Random(4)
    for k in range(200):
        a = "".join(rng.choice("abcdefgh\n") for _ in range(rng.choice([80, 300]))) * rng.choice([1, 1, 3])
        cut = [a[x : x + 40] for x in range(0, len(a), 40)]
        rng.shuffle(cut)
        b = "".join(x.replace("\n", "¶¶") if rng.random() < 0.5 else "".join(sorted(x)) if rng.random() < 0.3 else x for x in cut)
        want = SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        with monkeypatch.context() as m:
            if k % 2:
                m.setattr(align, "MIX", 1)
                m.setattr(align, "PAIRS", 1 << 20)
            assert align.Matcher(a, b).get_opcodes() == want


def _addresses(rng, n):
    hosts = ["tionsh.example.net", "blog.thther.example.org", "m.free-bets.example.com", "naïf.example.net"]
    tails = ["", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"]
    return [f"http{rng.choice(['', 's'])}://{rng.choice(hosts[: rng.randrange(1, 5)])}/{rng.choice(['en', 'fr'])}/{rng.randrange(4 * n)}{rng.choice(tails)}" for _ in range(n)]


def test_best_partners_by_a_tree(monkeypatch):
    """the same partners as by all pairs, first of equal ones, whatever the room for bits."""
    import numpy as np

    from scriptorium.operators import align, similar

    rng = random.Random(1)
    odd = ["a", "b", "ab", "ba" * 32, "é" * 9, "x" * 190, "ab" * 31 + "c"] + ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 70))) for _ in range(80)]
    right = list(dict.fromkeys(_addresses(rng, 150) + odd))
    left = [t for t in dict.fromkeys([x.split("://")[-1].split("?")[0] for x in right[::2]] + [x[: rng.randrange(1, 20)] for x in odd]) if len(t) <= 64]
    for least, room in ((70.0, 1 << 23), (51.0, 1), (85.5, 1), (100.0, 1 << 23)):
        monkeypatch.setattr(similar, "MASKS", room)
        score, owner = similar.best_of(left, right, least)
        for k, a in enumerate(left):
            want = [100.0 * 2 * align.lcs_length(a, b) / (len(a) + len(b)) if a != b else 0.0 for b in right]
            best = max(want)
            assert (score[k], owner[k]) == ((best, want.index(best)) if best >= least else (0.0, -1)), (a, least)
        assert (owner >= 0).any() or least == 100
    assert np.isfinite(score).all()


def test_best_partners_are_not_sought_in_all_pairs():
    """a block of like addresses takes the time of a few hundred alignments with all of it, not of thousands."""
    import time

    import pyarrow as pa

    from scriptorium.operators import similar

    right = sorted(set(_addresses(random.Random(2), 6000)))
    left = sorted({x.split("://")[-1].split("?")[0] for x in right})
    table = pa.table({"side": [0] * len(left) + [1] * len(right), "name": pa.array([None] * len(left) + list(range(len(right))), pa.int64()), "text": left + right})
    padded, numbers = similar._padded(right)
    start = time.process_time()
    for a in left[:100]:
        similar.common_with_all(a, padded, numbers)
    plain = time.process_time() - start
    start = time.process_time()
    assert similar._short_best(70.0)(table).num_rows == len(left)
    assert time.process_time() - start < 20 * plain
