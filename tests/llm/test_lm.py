import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from cubeloom.llm import lm
from pyspark.sql import functions as F


def plain(rows, trains):
    counts, tokens, own = Counter(), 0, []
    for r in rows:
        words = (r.text or "").encode().lower().split() + [None]
        own.append((r.doc_id, words))
        if trains(r.doc_id):
            counts.update(words)
            tokens += len(words)
    v = len(counts)
    return sorted(
        (
            (str(d), len(w), sum(counts[t] > 0 for t in w), tokens,
             round(sum(math.log10((counts[t] + 1) / (tokens + v + 1)) for t in w), 6))
            for d, w in own
        ),
        key=str,
    )


@pytest.mark.parametrize("keep", [lambda d: d is not None and d % 2 == 1, lambda d: False])
def test_base_scores_of_messy_rows(messy, keep):
    ids = [r.doc_id for r in messy.select("doc_id").distinct().collect() if keep(r.doc_id)]
    trains = F.col("doc_id").isin(ids) if ids else F.lit(False)
    rows = lm.score_texts(messy, trains).collect()
    got = sorted(
        ((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str
    )
    assert got == plain(messy.collect(), keep)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_empty_table(empty):
    assert lm.score_texts(empty, F.lit(True)).collect() == []


def test_model_beats_the_base_on_unseen_texts(spark):
    rng = np.random.default_rng(3)
    # two languages without common words: the word before tells which one goes on
    lists = [[f"a{i}e" for i in range(60)], [f"o{i}u" for i in range(60)]]
    texts = [" ".join(rng.choice(lists[d % 2], 80)) for d in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in lm.score_texts(df, F.col("doc_id") < 150).collect() if not r.trained]
    gain = (sum(r.score for r in rows) - sum(r.base_score for r in rows)) / sum(r.n_tokens for r in rows)
    assert gain > 0.15  # log10(2) = 0.30 is what knowing the language is worth


def brute_scores(texts, trains, how):
    """The whole model over one list of texts: dictionaries, dense counts, no blocks."""
    words = [t.encode().lower().split() for t in texts]
    held = Counter(w for own, t in zip(words, trains) if t for w in own)
    ends = sum(trains)
    tokens = sum(held.values()) + ends
    frequent = {w for w, n in held.items() if lm.OWN_SHARE * n * n >= tokens}
    shards = sorted(frequent, key=lambda w: (xxhash.xxh3_64_intdigest(w) % 32, w))
    number = {w: lm.FIRST_WORD + i for i, w in enumerate(shards)}
    size = lm.FIRST_WORD + len(number)
    room, totals = Counter(), np.zeros(size)
    for w, n in held.items():
        totals[number.get(w, lm.shape_of(w))] += n
        if w not in number:
            room[lm.shape_of(w)] += n + 1
    totals[lm.END] = ends
    unigram = (totals + 1) / (totals.sum() + size)

    def steps(own):
        classes = [number.get(w, lm.shape_of(w)) for w in own] + [lm.END]
        before = [lm.END, lm.END, *classes]
        return [(before[i + 1], before[i], c) for i, c in enumerate(classes)]

    counts = np.zeros((2, size, size))
    for own, t in zip(words, trains):
        for one, two, c in steps(own) if t else []:
            counts[0, one, c] += 1
            counts[1, two, c] += 1
    rng = np.random.default_rng(how.seed)
    tables = []
    for lag in range(2):
        r, q = rng.normal(0, 0.1, (size, how.width)), rng.normal(0, 0.1, (size, how.width))
        c, b = np.eye(how.width), np.log(unigram)
        memory = [np.full_like(x, 1e-20) for x in (r, c, q, b)]
        shares, expected = counts[lag] / tokens, how.noise * unigram
        for _ in range(how.rounds):
            odds = np.exp(r @ c @ q.T + b) / expected
            wrong = shares.sum(1)[:, None] * expected * odds / (1 + odds) - shares / (1 + odds)
            gradients = (wrong @ q @ c.T, r.T @ wrong @ q, wrong.T @ (r @ c), wrong.sum(0))
            for x, g, m in zip((r, c, q, b), gradients, memory):
                g = np.rint(g * lm.FIXED) / lm.FIXED
                m += g**2
                x -= how.rate * g / np.sqrt(m)
        table = np.exp(r @ c @ q.T + b)
        tables.append(table / table.sum(1, keepdims=True))
    assert np.allclose(sum(m * t[3] for m, t in zip(how.mix, [*tables, [unigram] * 4])).sum(), 1)
    scores = []
    for own in words:
        score = 0.0
        for (one, two, c), w in zip(steps(own), [*own, None]):
            score += math.log10(
                how.mix[0] * tables[0][one, c] + how.mix[1] * tables[1][two, c] + how.mix[2] * unigram[c]
            )
            if w is not None and w not in number:
                score += math.log10((held[w] + 1) / (room[lm.shape_of(w)] + 1))
        scores.append(score)
    return scores, size


def test_scores_equal_a_brute_force_model(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i:03d}{'.' if i % 9 == 0 else ''}" for i in range(150)]
    chances = np.arange(1, 151) ** -0.7
    texts = [
        " ".join(rng.choice(words, rng.integers(0, 60), p=chances / chances.sum())) for _ in range(240)
    ]
    trains = [d % 3 != 0 for d in range(240)]
    how = lm.Training(width=8, rounds=4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = lm.score_texts(df, F.col("doc_id") % 3 != 0, how).collect()
    expected, size = brute_scores(texts, trains, how)
    assert size > lm.HISTORIES  # more than one block
    assert [r.score for r in sorted(rows)] == pytest.approx(expected, abs=1e-5)


def test_counts_beyond_32_bits():
    many = np.array([0, 1, -1, 5_000_000_000, 1 << 62], np.int64)
    assert (lm.unpack_longs(lm.pack_longs(many)) == many).all()
    pairs = lm.PairCounts()
    for _ in range(3):
        pairs.add(np.array([2, 9]), np.array([4_000_000_000, 1]))
    pairs.settle()
    assert pairs.pairs.tolist() == [2, 9] and pairs.counts.tolist() == [12_000_000_000, 3]


def test_noise_contrast_finds_the_conditional_distribution():
    rng = np.random.default_rng(1)
    n = 24
    chances = rng.dirichlet(np.full(n, 0.3), n)
    counts = (chances * 50_000).astype(np.int64)
    own = counts / counts.sum()
    how = lm.Training(width=16, rounds=200)
    unigram = lm.unigram_of(counts.sum(0))
    model = lm.LogBilinear(unigram, how, rng)
    for _ in range(how.rounds):
        model.step(np.concatenate(model.gradient(0, own, np.log(how.noise * unigram))))
    r, c, q, b = model.views(model.numbers)
    got = r @ c @ q.T + b - model.normalisers(0, n)[:, None]
    assert np.exp(got).sum(1) == pytest.approx(1)
    true = (own * np.log(np.maximum(chances, 1e-9))).sum()
    least = (own * np.log(unigram)).sum()
    assert (own * got).sum() > least + 0.75 * (true - least)


def test_histories_stop_at_text_starts():
    one, two = lm.histories(np.array([1, 2, lm.END, 4, lm.END, lm.END]), np.array([0, 3, 5]))
    assert one.tolist() == [lm.END, 1, 2, lm.END, 4, lm.END]
    assert two.tolist() == [lm.END, lm.END, 1, lm.END, lm.END, lm.END]
