"""Toxicity by weak supervision.

Voters.  Lexicons written by hand, lexicons and word stems learned from labelled rows, and patterns
(address, shouting, repetition, absence of any sign) each vote toxic, clean or abstain.  What is learned is
cross-fitted: labelled rows are dealt into ``FOLDS`` folds by text, and a row's voters know only the labels of
other folds; all other documents get the voters learned from all folds.  A
generative label model, fitted by expectation maximisation on the counts of vote patterns over all
documents, estimates each voter's accuracy in either class and the correlation of voters within a
class; a voter's log-odds is divided by one plus its correlations, so that voters that repeat one another count
once.  In these counts labelled rows stand with their labels, all others with their posteriors.  A logistic
classifier is then trained on the posterior labels of a bounded sample of labelled rows, and
scores every document; a row's target is the posterior of its votes, which its own label has no part in but as one row of the counts.

Scale.  Texts are read once for the labelled sample and once for all documents; the second pass
leaves a few numbers for each document in the shared folder, from which the vote patterns are counted
(at most 3**voters rows reach the driver) and the scores computed.  The model is bounded: at most
``max_features`` words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import row_key, written

#: Hand-written lexicons.
LEXICONS = {
    "insult": "idiot idiots idiotic moron morons moronic stupid dumb fool fools imbecile imbeciles jerk jerks loser losers clown clowns retard retarded dimwit halfwit dunce blockhead scumbag",
    "contempt": "worthless pathetic disgusting trash garbage scum filth filthy vermin vile disgrace repulsive revolting despicable contemptible degenerate parasite",
    "profanity": "shit shitty bullshit fuck fucking fucked fucker asshole assholes bastard bastards bitch bitches damn crap dick piss cunt whore slut",
    "threat": "kill die murder hurt beat strangle burn destroy hang shoot rape",
    "deutsch": "idiot idioten dumm dummkopf blöd arschloch scheiße dreck abschaum schwein trottel versager ekelhaft wertlos",
    "français": "idiot idiote imbécile stupide crétin connard salaud merde ordure minable dégoûtant pourriture raclure",
    "español": "idiota imbécil estúpido estúpida tonto mierda basura escoria asqueroso patético inútil payaso",
}
_SETS = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
_HAND = frozenset().union(*_SETS.values()) - _SETS["threat"]
_ADDRESS = re.compile(r"\b(?:you(?:'re| are)?|your|du bist|ihr seid|tu es|vous êtes|eres|sois)(?: \S+){0,3}? (?:" + "|".join(sorted(_HAND)) + r")\b")
_WORD = re.compile(r"[^\W_]+")
VOTERS = ("hand", "hand_dense", "contempt", "rude", "threat", "address", "learned", "learned_two", "learned_dense", "stem", "stem_dense", "shout", "nothing")
FOLDS = 4
#: Letters of a stem.
STEM = 5
#: Numbers of the classifier besides words: see ``_measure``.
DENSE = ("log_hand", "hand_share", "log_learned", "learned_share", "log_stem", "stem_share", "log_words", "shout")


@dataclass
class Signs:
    """Words and stems that mark toxic texts in the labelled sample, with their place among features."""

    words: dict[str, int]
    stems: dict[str, int]
    strong: frozenset[str]


def _measure(text: str, signs: Signs) -> tuple[list[int], list[float], list[int], list[float]]:
    """(votes in -1, 0, 1; dense numbers; word features; their values)."""
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words)
    hand = sum(w in _HAND for w in words)
    contempt = sum(w in _SETS["contempt"] for w in words)
    rude = sum(w in _SETS["profanity"] for w in words)
    threat = sum(w in _SETS["threat"] for w in words)
    hits: dict[int, int] = {}
    learned = distinct = stems = 0
    seen: set[str] = set()
    get, stem = signs.words.get, signs.stems.get
    for w in words:
        k = get(w)
        if k is not None:
            hits[k] = hits.get(k, 0) + 1
            if w in signs.strong:
                learned += 1
                if w not in seen:
                    seen.add(w)
                    distinct += 1
        k = stem(w[:STEM])
        if k is not None:
            hits[k] = hits.get(k, 0) + 1
            stems += 1
    caps = sum(map(str.isupper, text))
    letters = sum(map(str.isalpha, text)) or 1
    shout = caps / letters if n >= 5 else 0.0
    address = 1 if hand and _ADDRESS.search(" ".join(words)) else 0
    any_sign = hand or rude or threat or learned or stems
    votes = [
        1 if hand else 0, 1 if hand >= 3 or hand > 0.02 * n else 0, 1 if contempt else 0, 1 if rude else 0, 1 if threat else 0, address,
        1 if learned else (-1 if n >= 30 and signs.strong else 0), 1 if distinct >= 2 else 0, 1 if learned > 0.01 * n and learned else 0, 1 if stems >= 2 else (-1 if n >= 30 and not stems and signs.stems else 0), 1 if stems and stems > 0.02 * n else 0,
        1 if shout > 0.6 else 0, 0 if any_sign else -1,
    ]
    dense = [np.log1p(hand), hand / max(n, 10), np.log1p(learned), learned / max(n, 10), np.log1p(stems), stems / max(n, 10), np.log1p(n) / 10, shout]
    return votes, dense, list(hits), [float(np.log1p(c)) for c in hits.values()]


_FEATURES = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("votes", pa.string()), ("dense", pa.list_(pa.float32())), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
_FEATURES_DDL = "id long, key long, votes string, dense array<float>, at array<int>, value array<float>"


def _features(signs: Signs, by_fold: list[Signs]):
    """Votes and numbers of rows (id, key, text, fold): by the fold's signs, or all signs where the fold is null; words are of all signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for i, key, t, fold in zip(*(part.column(c).to_pylist() for c in range(4))):
                    votes, dense, ks, vs = _measure(t, signs)
                    if fold is not None:
                        votes, dense, _, _ = _measure(t, by_fold[fold])
                    rows.append((i, key, "".join("-0+"[v + 1] for v in votes), dense, ks, vs))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FEATURES)], schema=_FEATURES)

    return K.lean(run)


# ---------------------------------------------------------------- label model


@dataclass
class LabelModel:
    """Class prior, vote probabilities (class, voter, vote) and the correlation discount of each voter."""

    prior: float
    table: np.ndarray
    discount: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of toxic against clean, for rows of votes in 0, 1, 2 (clean, abstain, toxic)."""
        k = np.arange(votes.shape[1])
        each = np.log(self.table[1][k, votes]) - np.log(self.table[0][k, votes])
        return np.log(self.prior / (1 - self.prior)) + (each * self.discount).sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))


def fit_label_model(votes: np.ndarray, count: np.ndarray, start: np.ndarray, prior: float, steps: int = 60, known: tuple[np.ndarray, np.ndarray] | None = None) -> LabelModel:
    """Expectation maximisation on distinct vote rows, ``count`` documents each.

    ``start``: first posteriors; ``known``: of each row, how many of its documents are labelled toxic, and how many are
    labelled at all; these keep their labels in the counts of votes, all others have their posteriors.  Correlations are those of votes about their class means,
    weighted by the posterior; a voter's discount is one over one plus the sum of its positive ones.
    """
    m = votes.shape[1]
    q, discount = start.astype(float), np.ones(m)
    one_hot = np.eye(3)[votes]  # (rows, voters, votes)
    model = LabelModel(prior, np.full((2, m, 3), 1 / 3), discount)
    toxic, labelled = (np.zeros(len(count)), np.zeros(len(count))) if known is None else known
    for step in range(steps):
        q = (toxic + (count - labelled) * q) / np.maximum(count, 1)
        for c, w in ((0, (1 - q) * count), (1, q * count)):
            model.table[c] = (np.einsum("r,rmv->mv", w, one_hot) + 0.5) / (w.sum() + 1.5)
        model.prior = float(np.clip((q * count).sum() / count.sum(), 0.005, 0.5))
        if step in (0, 5, 15, 30):
            shared = np.zeros((m, m))
            value = votes - 1.0
            for w in ((1 - q) * count, q * count):
                total = w.sum() + 1e-9
                centred = value - (w @ value) / total
                cov = (centred * w[:, None]).T @ centred / total
                sd = np.sqrt(np.diag(cov)) + 1e-6
                shared += np.maximum(cov / np.outer(sd, sd) - 0.1, 0) / 2  # less is taken for chance
            np.fill_diagonal(shared, 0)
            model.discount = 1 / (1 + shared.sum(axis=1))
        q = model.posterior(votes)
    return model


# ---------------------------------------------------------------- classifier


def fit_classifier(dense: np.ndarray, at: list, value: list, target: np.ndarray, width: int, steps: int = 400, decay: float = 3e-4) -> np.ndarray:
    """Weights (words, dense, bias) of a logistic regression on soft targets, by Adam on all rows."""
    rows = np.repeat(np.arange(len(at)), [len(a) for a in at])
    cols = np.concatenate([np.asarray(a, np.int64) for a in at]) if len(at) else np.zeros(0, np.int64)
    vals = np.concatenate([np.asarray(v, np.float64) for v in value]) if len(at) else np.zeros(0)
    n, d = len(target), dense.shape[1]
    w, m, v = np.zeros(width + d + 1), np.zeros(width + d + 1), np.zeros(width + d + 1)
    for step in range(1, steps + 1):
        z = dense @ w[width : width + d] + w[-1] + np.bincount(rows, vals * w[cols], n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        e = (p - target) / max(n, 1)
        grad = np.concatenate([np.bincount(cols, vals * e[rows], width), dense.T @ e, [e.sum()]])
        grad[:-1] += decay * w[:-1] / np.sqrt(max(n, 1) / 1000 + 1)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _codes(votes: list[str]) -> np.ndarray:
    """Votes as 0, 1, 2."""
    if not votes:
        return np.zeros((0, len(VOTERS)), np.int64)
    raw = np.frombuffer("".join(votes).encode(), np.uint8).reshape(len(votes), -1)
    return np.select([raw == ord("-"), raw == ord("0")], [0, 1], 2)


@dataclass
class ToxicityModel:
    """What scoring needs; of bounded size."""

    signs: Signs
    weights: np.ndarray
    label_model: LabelModel


def _held_out(column: str):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 0


def learn_signs(sample: DataFrame, max_features: int) -> tuple[Signs, list[Signs]]:
    """Words and stems of five letters whose share of toxic texts stands out (z over 3): of all folds, and of all but each."""
    words = F.array_distinct(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+"))
    tokens = F.filter(words, lambda w: F.length(w) > 1)
    both = F.array_union(F.transform(tokens, lambda w: F.concat(F.lit("w:"), w)), F.transform(F.filter(tokens, lambda w: F.length(w) >= STEM), lambda w: F.concat(F.lit("s:"), F.left(w, F.lit(STEM)))))
    groups = [None, *range(FOLDS)]

    def of(k: int | None, toxic: int) -> Column:
        hit = F.col("toxic") == toxic
        return F.count_if(hit if k is None else hit & (F.col("fold") != k)).cast("double")

    sums = [of(k, toxic).alias(f"{c}{'' if k is None else k}") for k in groups for c, toxic in (("a", 1), ("b", 0))]
    counts = sample.select("toxic", "fold", F.explode(both).alias("token")).groupBy("token").agg(*sums)
    sizes = sample.agg(*sums).first()
    scored = []
    for k in groups:
        a, b = (F.col(f"{c}{'' if k is None else k}") for c in "ab")
        na, nb = (sizes[f"{c}{'' if k is None else k}"] for c in "ab")
        odds = F.log((a + 0.5) / (F.lit(na + 0.5) - a + 0.5)) - F.log((b + 0.5) / (F.lit(nb + 0.5) - b + 0.5))
        z = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        scored.append(F.when((a >= 3) & (z > 3), F.struct(z.alias("z"), odds.alias("odds"))).alias("all" if k is None else f"fold{k}"))
    found = counts.select("token", *scored)
    some = [c for c in found.columns if c != "token"]
    found = written(found.where(F.coalesce(*some).isNotNull()), "signs")  # counted once for all folds
    signs = []
    for k in groups:
        c = "all" if k is None else f"fold{k}"
        best = found.where(F.col(c).isNotNull()).select("token", f"{c}.z", f"{c}.odds").orderBy(F.desc("z"), "token").limit(max_features).collect()
        own, stems = [r for r in best if r["token"][0] == "w"], [r for r in best if r["token"][0] == "s"]
        signs.append(
            Signs(
                {r["token"][2:]: i for i, r in enumerate(own)},
                {r["token"][2:]: len(own) + i for i, r in enumerate(stems)},
                frozenset(r["token"][2:] for r in own if r["odds"] > 3 and r["z"] > 4),
            )
        )
    return signs[0], signs[1:]


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = 20_000, max_features: int = 4_000) -> tuple[ToxicityModel, DataFrame]:
    """A model, and the features of all rows of ``documents`` (``id``, ``key``, ``votes``, ``dense``, ``at``, ``value``).

    ``max_sample`` bounds the labelled rows used, taken by a hash of their identifier among those with crc32 of the
    identifier's digits not divisible by five.  Rows without a label, with a label other than 0 and 1,
    or with conflicting labels teach nothing.
    """
    known = labels.where(~_held_out("doc_id")).where("toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    known = written(known.orderBy(F.xxhash64("id"), "id").limit(max_sample).select("id", "toxic"), "labelled")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # which rows teach: copies once, and no more than max_sample, also where one identifier has many texts
    matched = rows.join(F.broadcast(known), "id").select("id", "toxic", "key", F.xxhash64("text").alias("copy"))  # known: at most max_sample rows of two numbers
    first = Window.partitionBy("copy").orderBy("id", "key")
    matched = matched.withColumn("nth", F.row_number().over(first)).where("nth = 1").orderBy(F.xxhash64("key"), "key").limit(max_sample)
    chosen = written(matched.select("key", "toxic"), "teaching")
    sample = rows.join(F.broadcast(chosen), "key")  # again at most max_sample rows of two numbers
    sample = sample.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where("nth = 1").drop("nth")
    sample = written(sample.withColumn("fold", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(FOLDS)).cast("int")), "labelled-texts")
    signs, by_fold = learn_signs(sample, max_features)
    columns = ["id", "key", "text", "fold"]
    features = written(rows.withColumn("fold", F.lit(None).cast("int")).select(*columns).mapInArrow(_features(signs, by_fold), _FEATURES_DDL), "toxicity-features")
    fitted = written(sample.select(*columns).mapInArrow(_features(signs, by_fold), _FEATURES_DDL), "toxicity-sample")
    of_sample = sample.select("key", "toxic").join(fitted, "key").orderBy("id", "key").toPandas()
    # labelled rows count with the votes that don't know their labels
    others = features.join(F.broadcast(sample.select("key").distinct()), "key", "left_anti").select("votes")
    patterns = others.unionByName(fitted.select("votes")).groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toPandas()
    votes, count = _codes(patterns["votes"].tolist()), patterns["n"].to_numpy(float)
    share = float(of_sample["toxic"].mean()) if len(of_sample) else 0.1
    start, told = 1 / (1 + np.exp(-(votes - 1).sum(axis=1) + 0.5)), None
    if len(of_sample):
        seen = of_sample.groupby("votes")["toxic"].agg(["sum", "count"])
        told = patterns["votes"].map(seen["sum"]).fillna(0).to_numpy(), patterns["votes"].map(seen["count"]).fillna(0).to_numpy()
        start = (told[0] + 2 * start) / (told[1] + 2)
    model = fit_label_model(votes, count, start, share, known=told) if len(votes) else LabelModel(0.1, np.full((2, len(VOTERS), 3), 1 / 3), np.ones(len(VOTERS)))
    width = len(signs.words) + len(signs.stems)
    if len(of_sample):
        target = model.posterior(_codes(of_sample["votes"].tolist()))
        weights = fit_classifier(np.stack(of_sample["dense"].to_numpy()).astype(float), list(of_sample["at"]), list(of_sample["value"]), target, width)
    else:
        weights = np.zeros(width + len(DENSE) + 1)
        weights[width], weights[-1] = 3.0, -2.0
    return ToxicityModel(signs, weights, model), features


def score_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = 20_000, max_features: int = 4_000, with_key: bool = False) -> DataFrame:
    """Score every document: ``id_col``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``label_posterior``;
    ``with_key``: also ``row_key``, the row's key by identifier and text.

    The text alone is scored.  ``held_out`` rows (crc32 of the identifier's digits divisible by five) never
    teach.  Defined cases: null and empty texts get the score of a text without words; a null
    identifier is not held out; repeated rows get equal scores; without any usable label the hand-written
    lexicons score alone; other columns are ignored; an empty table gives an empty result.
    """
    model, features = train(documents, labels, id_col, text_col, max_sample, max_features)
    width, weights, label_model = len(model.signs.words) + len(model.signs.stems), model.weights, model.label_model

    @F.pandas_udf("score double, posterior double")
    def score(votes: pd.Series, dense: pd.Series, at: pd.Series, value: pd.Series) -> pd.DataFrame:
        x = np.stack(dense.to_numpy()).astype(float) if len(dense) else np.zeros((0, len(DENSE)))
        z = x @ weights[width:-1] + weights[-1]
        z += np.array([float(np.dot(weights[np.asarray(a, np.int64)], v)) if len(a) else 0.0 for a, v in zip(at, value)])
        return pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "posterior": label_model.posterior(_codes(votes.tolist()))})

    out = features.withColumn("s", score("votes", "dense", "at", "value"))
    return out.select(
        F.col("id").alias(id_col),
        *([F.col("key").alias("row_key")] if with_key else []),
        F.coalesce(_held_out("id"), F.lit(False)).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
        F.col("s.posterior").alias("label_posterior"),
    )
