"""The most frequent words take their shares along; a context is worked out once, however often it stands there."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from scriptorium.llm import kernels as K
from scriptorium.llm import lm_score


def test_each_context_once(monkeypatch):
    network = lm_score.Rounded(lm_score.unpacked(lm_score.initial() * np.float32(3)))
    rng = np.random.default_rng(3)
    distinct = np.unique(rng.integers(0, lm_score.CLASSES, (900, 2 * lm_score.SIDE)), axis=0)
    around, target = distinct[rng.integers(0, len(distinct), 5000)], rng.integers(1, lm_score.CLASSES, 5000)
    seen, layers = [], network._layers
    monkeypatch.setattr(network, "_layers", lambda a: seen.extend(map(tuple, a.tolist())) or layers(a))
    monkeypatch.setattr(lm_score, "SCORED", 64)
    got = network.logp(around, target)
    assert len(seen) == len(set(seen)) == len(np.unique(around, axis=0))
    assert got.tolist() == [int(network.logp(a[None], t[None])[0]) for a, t in zip(around, target)]
    assert len(network.logp(around[:0], target[:0])) == 0


def test_common_words_are_not_joined():
    class Model:
        value = (lm_score.initial(), np.zeros(0, np.uint64))

    def hashes(text: bytes) -> np.ndarray:
        buf = np.frombuffer(text, np.uint8)
        starts, ends, _ = K.words(buf, np.array([0, len(buf)]))
        return K.word_hashes(buf, starts, ends, fold=True)

    class Shares:
        value = (np.sort(hashes(b"one two")), np.array([-5, -7]))

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([b"one three ONE two", b"", b"four"])], names=["id", "text"])
    plain = next(lm_score._score(Model)(iter([batch]))).to_pylist()
    short = next(lm_score._score(Model, Shares)(iter([batch]))).to_pylist()
    share = dict(zip(Shares.value[0].tolist(), Shares.value[1].tolist()))
    assert [len(r["words"]) for r in plain] == [3, 0, 1] and [len(r["words"]) for r in short] == [1, 0, 1]
    for p, q in zip(plain, short):
        gone = {w: n for w, n in zip(p["words"], p["counts"]) if np.int64(w).view(np.uint64).item() in share}
        assert q["class_logp"] == p["class_logp"] + sum(n * share[np.int64(w).view(np.uint64).item()] for w, n in gone.items())
        assert dict(zip(q["words"], q["counts"])) == {w: n for w, n in zip(p["words"], p["counts"]) if w not in gone}


def test_scores_do_not_depend_on_the_number_of_common_words(spark, monkeypatch):
    text = " ".join(f"w{i * i % 397}" for i in range(1500))
    docs = spark.createDataFrame([(1, text), (2, " ".join(text.split()[::-1])), (3, "w1 w4 w9 once"), (4, None)], "doc_id long, text string").coalesce(1)
    found = []
    for common in (0, 300, 1 << 18):
        monkeypatch.setattr(lm_score, "COMMON", common)
        found.append(sorted(map(tuple, lm_score.lm_scores(docs).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 4
