import random

import numpy as np
import pytest

from cubeloom.llm import toxicity as tx
from pyspark.sql import functions as F


def corpus(n=1_200):
    rng = random.Random(4)
    words = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 9))) for _ in range(800)]
    texts, labels = [], []
    for i in range(n):
        own = rng.choices(words, k=rng.randint(5, 120))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(1 + len(own) // 15):
                bad = rng.choice(["idiot", "scum", "grubbel" + rng.choice(words), "sc" + "u" + "m!"])
                own.insert(rng.randrange(len(own)), bad)
        texts.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return texts, labels


@pytest.fixture(scope="module")
def scored(spark):
    texts, labels = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    plan = tx.ToxicityPlan(sample=900)
    rows = tx.score_toxicity(docs, marks, F.col("doc_id") % 3 != 1, plan).collect()
    return {r.doc_id: r for r in rows}, dict(labels)


def test_held_out_accuracy_and_calibration(scored):
    rows, labels = scored
    held = [i for i in rows if i % 3 == 1]
    y = np.array([labels[i] for i in held])
    score = np.array([rows[i].score for i in held])
    assert ((score >= 0) & (score <= 1)).all()
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(y))
    ranks[order] = np.arange(len(y))
    auc = (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.97
    assert abs(score.mean() - y.mean()) < 0.05
    predicted = np.array([rows[i].predicted for i in held])
    assert (predicted == (score >= 0.7)).all()
    assert predicted[y == 1].mean() > 0.9 and predicted[y == 0].mean() < 0.03


def test_messy_rows_and_labels(spark, messy, empty):
    marks = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (3, None), (None, 1), (4, 7), (999, 1)], "doc_id long, toxic int"
    )
    got = tx.score_toxicity(messy, marks)
    assert set(got.columns) == set(messy.columns) | {"predicted"}
    rows = got.collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert tx.score_toxicity(empty, marks).collect() == []
    one_kind = tx.score_toxicity(messy, marks.where("toxic = 0"))
    assert len({r.score for r in one_kind.collect()}) == 1
    assert {r.score for r in tx.score_toxicity(messy, marks.where("false")).collect()} == {0.5}


def test_features_see_obfuscation_address_and_length():
    lexicon = tx.Lexicon.of({"^grubb": 4.0})
    at = {n: i for i, n in enumerate(tx.FEATURES)}
    row = tx.features("You are an 1d10t and grubbelling SCUM!!!", lexicon)
    assert row[at["obfuscated_hits"]] > 0 and row[at["near_second_person"]] > 0
    assert row[at["lexicon_kinds"]] == pytest.approx(np.log1p(3)) and row[at["capital_words"]] > 0
    assert len(tx.features("", lexicon)) == len(tx.features("x" * 500_000, lexicon)) == len(tx.FEATURES)


def test_isotonic_calibration_rises():
    rng = np.random.default_rng(0)
    m = rng.normal(size=2_000)
    y = (rng.random(2_000) < 1 / (1 + np.exp(-2 * m))).astype(float)
    xs, ys = tx.isotonic(m, y)
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all()
    assert np.abs(np.interp(m, xs, ys) - 1 / (1 + np.exp(-2 * m))).mean() < 0.05
    xs, ys = tx.isotonic(np.zeros(4), np.array([0.0, 1, 0, 1]))
    assert set(ys) == {0.5}
