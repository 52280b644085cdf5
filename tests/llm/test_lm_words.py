"""Scores of single words, and which words teach."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from scriptorium.llm import lm_score


def test_junk_with_the_same_last_letters_scores_less(spark):
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    junk = " ".join(f"zz{k}{w[-1]}" for k, w in enumerate(rows[0][1].split()))
    docs = spark.createDataFrame([*rows, (900, junk), (901, junk), (902, None)], "doc_id long, text string")
    raw = [(i, (t or "").encode()) for i, t in docs.collect()]
    frame = spark.createDataFrame(raw, "id long, text binary")
    p, vocabulary = lm_score.train_model(frame)
    counts = Counter(w for _, t in raw for w in t.decode().split())

    def classed(text):
        buf = np.frombuffer(text.encode(), np.uint8)
        classes, first = lm_score.word_classes(buf, np.array([0, len(buf)]), vocabulary)
        around, target = lm_score.contexts(classes, first)
        z = lm_score.forward(lm_score.unpacked(p), around)[2]
        return classes, np.log(z[np.arange(len(z)), target]).sum()

    shares = {c: 0 for c in range(lm_score.CLASSES)}
    klass = {w: int(classed(w)[0][0]) for w in counts}
    for w, n in counts.items():
        shares[klass[w]] += n
    got = {r["doc_id"]: r for r in lm_score.lm_scores(docs).collect()}
    for i, text in (rows[0], rows[1], (900, junk)):
        want = classed(text)[1] + sum(math.log(counts[w] / shares[klass[w]]) for w in text.split() if klass[w] > lm_score.OWN)
        assert abs(got[i]["sum_logp"] - want) < 1e-2
    assert got[900]["sum_logp"] == got[901]["sum_logp"] < got[0]["sum_logp"] - 10


def test_every_word_teaches_once(monkeypatch):
    seen = Counter()
    monkeypatch.setattr(lm_score, "gradient", lambda params, around, target: seen.update(target.tolist()) or np.zeros(sum(lm_score.SIZES), np.float32))
    monkeypatch.setattr(lm_score, "word_classes", lambda buf, offsets, v: (np.arange(1, 101), np.array([0, 37, 100])))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([b"a b", b"c"])], names=["id", "text"])
    rounds, stride = lm_score.train_model.__defaults__[:2]
    for turn in range(rounds):
        list(lm_score._train(lm_score.initial(), np.zeros(0, np.uint64), stride, 0.01, turn)(iter([batch])))
    assert seen == Counter(range(1, 101))


def test_natural_order_scores_above_shuffled(spark):
    rng = random.Random(14)
    words = [f"{a}{b}{c}" for a in "bdkt" for b in "aeiou" for c in "lmnr"]
    follows = {w: rng.sample(words, 4) for w in words}

    def natural(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(follows[out[-1]]))
        return out

    rows = [(k, " ".join(natural(80))) for k in range(400)]
    pairs = []
    for k in range(40):  # unseen texts, and the same words in another order
        w = natural(80)
        mixed = w[:]
        rng.shuffle(mixed)
        pairs.append((1000 + k, 2000 + k))
        rows += [(1000 + k, " ".join(w)), (2000 + k, " ".join(mixed))]
    got = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[a] > got[b] for a, b in pairs) >= 38


def test_scores_do_not_depend_on_batches():
    """One text among others of all sizes, in batches of all sizes, and under batches that BLAS cuts elsewhere: equal to the last bit."""
    rng = random.Random(15)
    params = lm_score.initial() * np.float32(3)
    one = " ".join(f"w{rng.randrange(50)}{rng.choice('abc')}" for _ in range(137)).encode()
    others = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(1, 400))).encode() for _ in range(60)]

    class Model:
        value = (params, np.sort(np.array([5, 9], np.uint64)))

    found = set()
    for k in range(40):
        texts = rng.sample(others, rng.randrange(len(others)))
        texts.insert(rng.randrange(len(texts) + 1), one)
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
        sizes = lm_score.BATCH
        lm_score.BATCH = rng.choice([7, 64, 1000, sizes])
        try:
            rows = [r for out in lm_score._score(Model)(iter([batch])) for r in out.to_pylist()]
        finally:
            lm_score.BATCH = sizes
        found.add(rows[texts.index(one)]["class_logp"])
    assert len(found) == 1


def test_network_against_a_plain_loop():
    rng = np.random.default_rng(16)
    params = [p.astype(np.float64) for p in lm_score.unpacked(lm_score.initial() * np.float32(2))]
    embed, w1, b1, w2, b2 = params
    around, target = rng.integers(0, lm_score.CLASSES, (30, 4)), rng.integers(0, lm_score.CLASSES, 30)
    got = lm_score.Rounded(lm_score.unpacked(lm_score.initial() * np.float32(2))).logp(around, target) / lm_score.FINE
    for i in range(30):
        x = [v for c in around[i].tolist() for v in embed[c].tolist()]
        h = [math.tanh(sum(x[k] * w1[k][j] for k in range(len(x))) + b1[j]) for j in range(len(b1))]
        z = [sum(h[k] * w2[k][j] for k in range(len(h))) + b2[j] for j in range(len(b2))]
        assert abs(z[target[i]] - math.log(sum(map(math.exp, z))) - got[i]) < 1e-4
