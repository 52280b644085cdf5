"""Decontamination against the alignment of every document with every item."""

import random

from scriptorium.llm import decontaminate

VOWELS, CONSONANTS = "aeiou", "bdfgklmnprst"


def vocabulary(rng, n):
    return ["".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def best(item, passage):
    """The plain local alignment: match 2, mismatch and gap -1."""
    top, row = 0, [0] * (len(passage) + 1)
    for a in item:
        new = [0]
        for k, b in enumerate(passage):
            new.append(max(0, row[k] + (2 if a == b else -1), row[k + 1] - 1, new[k] - 1))
        row = new
        top = max(top, *row)
    return top


def edited(rng, words, some, share):
    out = []
    for w in words:
        kind = rng.random()
        if kind < share / 3:
            out.append(rng.choice(some))
        elif kind < share * 2 / 3:
            out += [w, rng.choice(some)]
        elif kind >= share:
            out.append(w)
    return out


def test_every_alignment_is_found(spark):
    rng = random.Random(31)
    some = vocabulary(rng, 300)
    text = lambda n: [rng.choice(some) for _ in range(n)]
    items = [(k, text(rng.randrange(12, 50))) for k in range(12)]
    docs = [(k, text(rng.randrange(0, 120))) for k in range(30)]
    for k in range(60):
        item = items[k % 12][1]
        docs.append((100 + k, text(rng.randrange(0, 40)) + edited(rng, item, some, rng.choice([0, 0.1, 0.2, 0.3])) + text(rng.randrange(0, 40))))
    docs += [(500, text(3000) + items[3][1] + text(3000)), (None, items[4][1]), (501, items[5][1]), (501, items[5][1]), (501, text(20))]
    want = {(i, j): s / (2 * len(w)) for i, d in docs for j, w in items if (s := best(w, d)) >= 0.4 * 2 * len(w)}
    rows = [(i, " ".join(d), 7, "x") for i, d in docs] + [(600, None, 7, "x"), (601, "", 7, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id int, id string")
    bench = spark.createDataFrame([(j, " ".join(w).upper(), 1.0) for j, w in items] + [(90, None, 1.0), (91, "", 1.0), (items[0][0], " ".join(items[0][1]), 1.0)], "item_id long, text string, score double")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contamination(frame, bench).collect()}
    assert all(abs(want[p] - got[p]) < 1e-9 for p in got)  # nothing that plain alignment refuses, and the same scores
    recall = len(got) / len(want)
    print(f"recall {recall:.3f} of {len(want)} pairs")
    assert recall >= 0.97
    left = decontaminate.decontaminate(frame, bench)
    assert left.columns == frame.columns
    hit = {i for i, _ in want}
    assert {r["doc_id"] for r in left.collect()} >= ({i for i, _ in docs} | {600, 601}) - hit
    assert left.where("doc_id = 501").count() == 1  # the other text of a repeated identifier
