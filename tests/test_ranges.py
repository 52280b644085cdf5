"""Range joins and gaps against plain comparisons."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import link, ranges


def ref(rng, big):
    return ".".join(str(rng.choice([0, 1, 2, 15, 16, 17, 300, 4095, 70_000, 2_000_000_000]) if big else rng.randrange(6)) for _ in range(rng.randrange(1, 4)))


@pytest.mark.parametrize("seed", range(4))
def test_containing(spark, seed):
    rng = random.Random(seed)
    points = [(rng.randrange(3), ref(rng, seed % 2)) for _ in range(250)] + [(0, "x.1"), (0, None), (0, "")]
    spans = [(rng.randrange(3), ref(rng, seed % 2), ref(rng, seed % 2), k) for k in range(120)] + [(0, "1", "x", 900), (0, "0", "2000000000", 901), (0, "2", "1", 902), (1, "1.2", "1.2", 903), (1, None, "3", 904)]
    key = lambda t: [int(x) for x in t.split(".")] if t and all(x.isdigit() for x in t.split(".")) else None
    want = sorted((d, p, n) for d, p in points for e, a, b, n in spans if d == e and None not in (key(p), key(a), key(b)) and key(a) <= key(p) <= key(b))
    p = spark.createDataFrame(points, "doc_id int, ref string")
    r = spark.createDataFrame(spans, "doc_id int, start string, end string, n int")
    assert sorted((x["doc_id"], x["ref"], x["n"]) for x in link.containing(p, r).collect()) == want and want
    assert link.containing(p, r.limit(0)).count() == link.containing(p.limit(0), r).count() == 0


def test_a_large_range_costs_few_rows(spark):
    r = spark.createDataFrame([(1, [5, 1], [5, 1_000_000_000]), (1, [0], [2_000_000_000]), (1, [7, 3], [7, 3])], "doc_id int, _a array<int>, _b array<int>")
    found = ranges.in_bins(r).groupBy("_a").count().collect()
    assert len(found) == 3 and all(x["count"] <= 17 for x in found)


def test_coverage_gaps(spark):
    notes = [(1, "1.1-1000000000"), (1, "2.3"), (1, "2.4"), (2, "5-9"), (2, "9-5"), (2, "x"), (3, "1-3"), (3, "1-3")]
    there = [(1, "1.1"), (1, "1.2"), (1, "1.500"), (1, "2.3"), (2, "5"), (2, "6"), (2, "6"), (2, "9"), (2, "2.7"), (4, "1")]
    df = ranges.coverage_gaps(spark.createDataFrame(notes, "doc_id int, ref string"), spark.createDataFrame(there, "doc_id int, ref string"))
    assert sorted(map(tuple, df.collect())) == [
        (1, "1.1-1000000000", 3, 499, 497), (1, "1.1-1000000000", 501, 1_000_000_000, 999_999_500), (1, "2.4", 4, 4, 1), (2, "5-9", 7, 8, 2), (3, "1-3", 1, 3, 3)]


def test_gaps_are_the_uncovered_members(spark):
    rng = random.Random(8)
    notes = [(rng.randrange(3), f"{rng.randrange(3)}.{(a := rng.randrange(1, 30))}-{a + rng.randrange(12)}") for _ in range(60)]
    there = [(rng.randrange(3), f"{rng.randrange(3)}.{rng.randrange(1, 40)}") for _ in range(120)]
    a, b = spark.createDataFrame(notes, "doc_id int, ref string").distinct(), spark.createDataFrame(there, "doc_id int, ref string")
    gaps = ranges.coverage_gaps(a, b).select("doc_id", "ref", F.explode(F.sequence("first", "last")).alias("m"))
    got = {(r["doc_id"], r["ref"], f"{r['ref'].split('.')[0]}.{r['m']}") for r in gaps.collect()}
    assert got == {(r["doc_id"], r["ref"], r["member"]) for r in link.uncovered(a, b).collect()}


def test_grammar_names_large_gaps_once(spark):
    from scriptorium.operators import rules

    note = '<!-- commentary: {"commentary_id": "c"} -->\n# Commentary: '
    body = f"# Mantra 1.1\n# Mantra 1.5\n{note}1.1-2000000000\n{note}1.4-6\n{note}2-1\n{note}7\n{note}1.4-6"
    df = spark.createDataFrame([(1, body)], "doc_id int, body string")
    got = sorted((r["line_num"], r["rule_id"], r["detail"]) for r in rules.line_grammar(df).collect())
    assert got == [(4, "no_passage", "1.2"), (4, "no_passage", "1.3"), (4, "no_passage", "1.4"), (4, "no_passage", "1.6-2000000000"), (6, "no_passage", "1.4"), (6, "no_passage", "1.6"),
                   (8, "bad_range", "2-1"), (10, "no_passage", "7"), (12, "no_passage", "1.4"), (12, "no_passage", "1.6")]
