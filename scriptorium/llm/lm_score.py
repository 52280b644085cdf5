"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts the class of every word from the two words on either side: embeddings, a
tanh layer, a softmax over ``CLASSES`` classes.  The most frequent words of the corpus are classes
of their own, all others share classes by their last letter.  A word's probability is that of its class
times its share of the class's occurrences in the whole corpus, so the vocabulary is that of the corpus.
A document's score is the sum of the logarithms of the conditional probabilities of all its words.

Training.  Word counts cover all documents.  Then every task trains on its own documents, in numpy,
from the same parameters; the tasks' parameters are averaged, weighted by the words they saw, and the
next round starts from the average.  Every document takes part in each round, with every ``stride``-th
word as a target, each round with others, so that ``stride`` rounds make a target of every word, and the
evidence grows with the corpus while no text leaves its task.

Scores are exact in the following sense: weights and hidden values are rounded to a millionth of the largest, so both matrix products add
whole numbers below 2^53, which float64 holds without rounding in whatever order a library adds them; what remains is done element by
element or along one row.  A word's logarithm is then a whole number of 2^-32, and sums of these are exact.  So equal texts score equally in any
batch, beside any others.  Training is not: tasks train on their own documents, so other partitions give other weights, and scores
that differ in the second or third digit.

Scale.  Shuffled are partial word counts, the distinct words of each document but the most frequent of the corpus (as hashes, to meet their
counts, which stay a table) and, for each task and round, one number for each
parameter (about 8,400), summed before and after the shuffle; the driver gets the averages and the
own-class words and the most frequent others, whose sizes do not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .kernels import U
from .shared import written

OWN, SHARED = 95, 32
#: Class 0 stands beyond the ends of a document.
CLASSES = 1 + OWN + SHARED
SIDE, EMBED, HIDDEN, BATCH = 2, 16, 32, 8192
#: Words that share classes and make up this part or more of what does, which so many can at most, take their shares along to the tasks; all others are joined.
COMMON = 1 << 18
#: Contexts scored at once: their last layer stays in a core's cache.
SCORED = 1024
PIECE = 1 << 20
#: Logarithms of words' shares are summed in such parts, so that equal texts get equal sums in any order.
FINE = float(1 << 32)
#: Steps on either side of zero for weights and hidden values: 64 products of two such numbers stay below 2^53.
STEPS = 1 << 20
SHAPES = ((CLASSES, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))
SIZES = [int(np.prod(s)) for s in SHAPES]


def initial(seed: int = 7) -> np.ndarray:
    """All parameters in one vector."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 0.3 if len(s) > 1 and k == 0 else 1 / np.sqrt(s[0]), s).ravel() if len(s) > 1 else np.zeros(s) for k, s in enumerate(SHAPES)]).astype(np.float32)


def unpacked(p: np.ndarray) -> list[np.ndarray]:
    return [part.reshape(s) for part, s in zip(np.split(p, np.cumsum(SIZES)[:-1]), SHAPES)]


def contexts(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context classes, classes) of each word; class 0 beyond a row's ends.

    ``first``: the first word of each row, and the end.
    """
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(classes)) + 2 * SIDE * rows + SIDE  # a gap of class 0 before, between and after rows
    padded = np.zeros(len(classes) + 2 * SIDE * len(first), np.int64)
    padded[at] = classes
    offsets = [o for o in range(-SIDE, SIDE + 1) if o]
    return np.stack([padded[at + o] for o in offsets], axis=1), classes


def forward(params: list[np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, hidden layer, class probabilities)."""
    x, h, z = exponentials(params, around)
    z /= z.sum(axis=1, keepdims=True)
    return x, h, z


def exponentials(params: list[np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``forward``, before the probabilities of a row are made to sum to one."""
    embed, w1, b1, w2, b2 = params
    x = embed.take(around, axis=0).reshape(len(around), -1)
    h = x @ w1
    h += b1
    np.tanh(h, out=h)
    z = h @ w2
    z += b2
    if _beyond(w2, b2):
        np.clip(z, -40, 40, out=z)
    np.exp(z, out=z)
    return x, h, z


def _beyond(w2: np.ndarray, b2: np.ndarray) -> bool:
    """Whether any hidden values, which are at most 1, could need the limits of 40."""
    return not float((np.abs(w2).sum(axis=0) + np.abs(b2)).max()) < 39.9


class Rounded:
    """The network with weights in whole steps, for scores that do not depend on the order of additions."""

    def __init__(self, params: list[np.ndarray]):
        embed, w1, self.b1, w2, self.b2 = (np.asarray(p, np.float32) for p in params)
        (self.embed, e), (self.w1, s1), (self.w2, s2) = map(self._steps, (embed, w1, w2))
        self.inner, self.outer = e * s1, s2 / STEPS
        self.beyond = _beyond(w2, self.b2)
        # what each class adds to the hidden layer from each side, in whole steps
        self.adds = [self.embed @ part for part in np.split(self.w1, 2 * SIDE)]

    @staticmethod
    def _steps(w: np.ndarray) -> tuple[np.ndarray, float]:
        size = float(np.abs(w).max(initial=0)) / STEPS or 1.0
        return np.rint(w.astype(np.float64) / size), size

    def logp(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The logarithm of each target's probability, in whole numbers of 1 / FINE; each distinct context is worked out once."""
        key = around[:, 0].copy()
        for k in range(1, 2 * SIDE):
            key *= CLASSES
            key += around[:, k]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        ends = np.append(first[1:], len(key))
        out = np.empty(len(key), np.int64)
        for k in range(0, len(first), SCORED):
            some = first[k : k + SCORED]
            words = order[some[0] : ends[min(k + SCORED, len(first)) - 1]]
            of = np.repeat(np.arange(len(some)), ends[k : k + SCORED] - some)
            z, norm = self._layers(around[order[some]])
            out[words] = np.rint((z[of, target[words]].astype(np.float64) - norm[of]) * FINE).astype(np.int64)
        return out

    def _layers(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the last layer, the logarithm of the sum of its exponentials)."""
        x = self.adds[0].take(around[:, 0], axis=0)
        for k in range(1, 2 * SIDE):
            x += self.adds[k].take(around[:, k], axis=0)
        x *= self.inner
        h = np.tanh(x.astype(np.float32) + self.b1).astype(np.float64)
        h *= STEPS
        steps = np.rint(h, out=h) @ self.w2
        z = np.multiply(steps, self.outer, out=np.empty(steps.shape, np.float32), casting="same_kind")
        z += self.b2
        if self.beyond:
            np.clip(z, -40, 40, out=z)
        return z, np.log(np.exp(z).sum(axis=1).astype(np.float64))


class Adam:
    def __init__(self, p: np.ndarray, rate: float):
        self.p, self.rate, self.m, self.v, self.t = p, rate, np.zeros_like(p), np.zeros_like(p), 0

    def step(self, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        self.p -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-6)


def gradient(params: list[np.ndarray], around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of the mean negative log-probability of ``target``."""
    embed, w1, _, w2, _ = params
    x, h, z = exponentials(params, around)
    z *= 1 / (z.sum(axis=1, keepdims=True) * np.float32(len(target)))
    z[np.arange(len(target)), target] -= np.float32(1 / len(target))
    dh = z @ w2.T
    dh *= 1 - h * h
    dx = dh @ w1.T
    cell = (around * EMBED)[:, :, None] + np.arange(EMBED)
    de = np.bincount(cell.ravel(), dx.ravel(), CLASSES * EMBED)
    return np.concatenate([de, (x.T @ dh).ravel(), dh.sum(axis=0), (h.T @ z).ravel(), z.sum(axis=0)]).astype(np.float32)


def word_classes(buf: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each word, first word of each row); ``vocabulary``: sorted hashes of the own-class words."""
    return hashed_classes(buf, offsets, vocabulary)[:2]


def hashed_classes(buf: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_classes``, and the hash of each word."""
    starts, ends, first = K.words(buf, offsets)
    h = K.word_hashes(buf, starts, ends, fold=True)
    out = 1 + OWN + (buf[ends - 1] & 31).astype(np.int64)
    if len(vocabulary):
        k = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        own = vocabulary[k] == h
        out[own] = 1 + k[own]
    return out, first, h


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, n, c = (np.concatenate(x) for x in zip(*kept))
        u, at, place = np.unique(h, return_index=True, return_inverse=True)
        return u, np.bincount(place, n, len(u)).astype(np.int64), c[at]

    def out() -> pa.RecordBatch:
        u, n, c = merged()
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n), pa.array(c)], names=["word", "n", "class"])

    for batch in batches:
        buf, offsets = K.buffers(batch.column(1))
        for i, j in K.pieces(offsets, PIECE):
            at = offsets[i : j + 1]
            part = buf[at[0] : at[-1]]
            starts, ends, _ = K.words(part, at - at[0])
            u, k, n = np.unique(K.word_hashes(part, starts, ends, fold=True), return_index=True, return_counts=True)
            kept.append((u, n, (part[ends[k] - 1] & 31).astype(np.int32)))
        if sum(len(u) for u, _, _ in kept) > 4_000_000:
            one = merged()
            kept[:] = [one]
            if len(one[0]) > 2_000_000:
                yield out()
                kept.clear()
    if kept:
        yield out()


def _train(p: np.ndarray, vocabulary: np.ndarray, stride: int, rate: float, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Adam(p.copy(), rate)
        params = unpacked(own.p)
        seen, waiting = 0, []
        for batch in batches:
            buf, offsets = K.buffers(batch.column(1))
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                classes, first = word_classes(buf[at[0] : at[-1]], at - at[0], vocabulary)
                around, target = contexts(classes, first)
                some = np.arange((turn + i) % stride, len(target), stride)
                waiting.append((around[some], target[some]))
                seen += len(some)
                if sum(len(t) for _, t in waiting) >= BATCH:
                    a, t = np.concatenate([x for x, _ in waiting]), np.concatenate([x for _, x in waiting])
                    order = np.random.default_rng(seen).permutation(len(t))
                    for k in range(0, len(t), 1024):
                        own.step(gradient(params, a[order[k : k + 1024]], t[order[k : k + 1024]]))
                    waiting = []
        a = np.concatenate([x for x, _ in waiting]) if waiting else np.zeros((0, 2 * SIDE), np.int64)
        t = np.concatenate([x for _, x in waiting]) if waiting else np.zeros(0, np.int64)
        for k in range(0, len(t), 256):
            own.step(gradient(params, a[k : k + 256], t[k : k + 256]))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(p), dtype=np.int32)), pa.array(own.p.astype(np.float64) * seen), pa.array(np.full(len(p), seen, np.int64))], names=["k", "v", "n"])

    return run


_OUT_DDL = "id long, n_words long, class_logp long, words array<long>, counts array<int>"


def _score(model, shares=None):
    """``model``: a broadcast of (parameters, own-class words); ``shares``: one of the common words, sorted, and the logarithms of their shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, vocabulary = model.value
        common, common_logp = shares.value if shares else (np.zeros(0, U), np.zeros(0, np.int64))
        network = Rounded(unpacked(p))
        for batch in batches:
            buf, offsets = K.buffers(batch.column(1))
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                classes, first, hashes = hashed_classes(buf[at[0] : at[-1]], at - at[0], vocabulary)
                around, target = contexts(classes, first)
                total = np.zeros(len(target) + 1, np.int64)
                total[1:] = network.logp(around, target)
                shared = np.flatnonzero(classes > OWN)
                if len(common) and len(shared):
                    k = np.minimum(np.searchsorted(common, hashes[shared]), len(common) - 1)
                    known = common[k] == hashes[shared]
                    total[shared[known] + 1] += common_logp[k[known]]
                    shared = shared[~known]
                np.cumsum(total, out=total)
                # the distinct words of each row that share a class and are not common
                rows = np.repeat(np.arange(j - i), np.diff(first))[shared]
                h = hashes[shared].view(np.int64)
                order = np.lexsort((h, rows))
                rows, h = rows[order], h[order]
                new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
                ends = pa.array(np.searchsorted(rows[new], np.arange(j - i + 1)).astype(np.int32))
                words = pa.ListArray.from_arrays(ends, pa.array(h[new]))
                counts = pa.ListArray.from_arrays(ends, pa.array(np.diff(np.append(new, len(h))).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)), pa.array(total[first[1:]] - total[first[:-1]]), words, counts],
                    names=["id", "n_words", "class_logp", "words", "counts"],
                )

    return run


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n, class): every word of the corpus by hash, its occurrences, and the class it shares."""
    counts = rows.mapInArrow(_count, "word long, n long, class int").groupBy("word").agg(F.sum("n").alias("n"), F.min("class").alias("class"))
    return written(counts, "word-counts")


def train_model(rows: DataFrame, rounds: int = 2, stride: int = 2, rate: float = 0.01, counts: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(parameters, own-class words) from rows of (id, text as bytes)."""
    counts = word_counts(rows) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(OWN).collect()
    vocabulary = np.sort(np.array([r["word"] for r in top], np.int64).view(U))
    p = initial()
    for turn in range(rounds):
        trained = rows.mapInArrow(_train(p, vocabulary, stride, rate / (1 + 2 * turn), turn), "k int, v double, n long")
        found = trained.groupBy("k").agg((F.sum("v") / F.sum("n")).alias("v")).collect()  # one row for each parameter
        for r in found:
            p[r["k"]] = r["v"]
    return p, vocabulary


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2, stride: int = 2) -> DataFrame:
    """Masked pseudo-likelihood of every document under a network trained on all of them.

    Returns ``id_col``, ``n_words``, ``sum_logp`` (the sum of the words' conditional log-probabilities) and ``score``
    (its mean; 0 without words).

    Defined cases: a null, empty or blank text has no words, sum and score 0; a text of one word is
    predicted from its ends alone; repeated rows get equal scores; a null identifier stays null; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    counts = word_counts(rows)
    p, vocabulary = train_model(rows, rounds, stride, counts=counts)
    shared = counts.where(~F.col("word").isin(vocabulary.view(np.int64).tolist()))
    sizes = shared.groupBy("class").agg(F.sum("n").alias("all"))  # at most SHARED rows
    share = shared.join(F.broadcast(sizes), "class").select("word", "n", F.round(F.log(F.col("n") / F.col("all")) * FINE).cast("long").alias("logp"))
    least = (sizes.agg(F.sum("all")).first()[0] or 0) / max(COMMON, 1)
    top = share.where(F.col("n") >= least).collect() if COMMON else []
    common, common_logp = (np.array([r[c] for r in top], np.int64) for c in ("word", "logp"))
    order = np.argsort(common.view(U))
    model, shares = map(docs.sparkSession.sparkContext.broadcast, ((p, vocabulary), (common.view(U)[order], common_logp[order])))
    scored = written(rows.mapInArrow(_score(model, shares), _OUT_DDL).withColumn("row", F.monotonically_increasing_id()), "class-scores")
    each = scored.select("row", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.counts").alias("k"))
    within = each.join(share.select("word", "logp"), "word").groupBy("row").agg(F.sum(F.col("k") * F.col("logp")).alias("word_logp"))
    out = scored.select("row", "id", "n_words", "class_logp").join(within, "row", "left")
    out = out.withColumn("sum_logp", (F.col("class_logp") + F.coalesce("word_logp", F.lit(0).cast("long"))) / FINE)
    return out.select(F.col("id").alias(id_col), "n_words", "sum_logp", F.when(F.col("n_words") > 0, F.col("sum_logp") / F.col("n_words")).otherwise(0.0).alias("score"))
