"""No row's own label decides its target."""

import random

import numpy as np
import pytest

from scriptorium.llm import toxicity

WORDS = [a + b for a in "ka ta ma na ra la sa va".split() for b in "rim lun tos ver dal pon".split()]


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(500):
        w = [rng.choice(WORDS) for _ in range(40)]
        bad = k % 4 == 0
        for _ in range(5 if bad else 0):
            w[rng.randrange(40)] = rng.choice(["idiot", "moron", "worthless", "schmurzel", "schmurzig"])
        wrong = k in (4, 8, 12, 5, 9, 13)  # three of either kind have the other label
        rows.append((k, " ".join(w)))
        labels.append((k, int(bad != wrong)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    return {r["doc_id"]: r for r in out.collect()}


def test_wrong_labels_do_not_win(scored):
    for k in (4, 8, 12):
        assert scored[k]["label_posterior"] > 0.5 and scored[k]["predicted"] == 1
    for k in (5, 9, 13):
        assert scored[k]["label_posterior"] < 0.5 and scored[k]["predicted"] == 0


def test_folds_do_not_know_their_own_words(spark):
    rows = [(k, f"plain words here {'schmurzel' if k < 12 else 'gentle'}", int(k < 12), k, 0 if k < 12 else k % toxicity.FOLDS) for k in range(60)]
    sample = spark.createDataFrame(rows, "id long, text string, toxic int, key long, fold int")
    signs, by_fold = toxicity.learn_signs(sample, 100)
    assert "schmurzel" in signs.words
    assert "schmurzel" not in by_fold[0].words and all("schmurzel" in s.words for s in by_fold[1:])
    votes, *_ = toxicity._measure("schmurzel " * 5, by_fold[0])
    assert np.max(votes) <= 0


def test_many_texts_of_one_identifier_stay_within_the_sample(spark):
    """``max_sample`` bounds texts, not identifiers: the labelled identifier has hundreds of texts."""
    docs = [(k, f"plain text number {k}") for k in range(1, 40)] + [(1, f"another text of the first identifier {k}") for k in range(400)] + [(1, "repeated row")] * 5
    labels = spark.createDataFrame([(k, 0) for k in range(1, 40)], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    sizes = []
    real = toxicity.learn_signs

    def seen(sample, most):
        sizes.append((sample.count(), sample.select("key").distinct().count()))
        return real(sample, most)

    toxicity.learn_signs = seen
    try:
        got = toxicity.score_toxicity(df, labels, max_sample=50)
        assert got.count() == len(docs)
    finally:
        toxicity.learn_signs = real
    assert sizes == [(50, 50)]
