import math
import random
from collections import Counter

import numpy as np
import pytest

from cubeloom.llm import lexical as lx
from test_decontam import plain_words


def plain(docs, items, k):
    texts = [(d, plain_words(t)) for d, t in docs]
    texts = [(d, w, Counter(w)) for d, w in texts if w]
    total, words = len(texts), sum(len(w) for _, w, _ in texts)
    df = Counter(t for _, _, c in texts for t in c)
    asked = {}
    for i, text in items:
        if i is not None:
            asked[i] = min(asked.get(i, text or ""), text or "", key=lambda t: t.encode())
    out = []
    for i, text in asked.items():
        scores = []
        for d, own, counts in texts:
            m = 100 - 25 + (25 * len(own) * total) // words
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in plain_words(text)
                if counts[t]
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é漢", "Ab9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([0, 1, 3, 20, 200, 900]))) for i in range(400)]
    docs += [docs[5], docs[30], (30, "w250 w251"), (None, "w250 w251"), (None, None), (500, ""), (501, " ,")]
    docs += [(i, "w299 tie") for i in range(600, 640)]
    items = [(i, text(rng.randint(1, 60))) for i in range(30)]
    items += [(3, text(4)), (None, text(4)), (50, ""), (51, None), (52, "nowhere"), (53, "tie"), (54, "W250, w251 w250")]
    return docs, items


@pytest.mark.parametrize("block_words, query_bytes", [(1 << 20, 1 << 20), (200, 1 << 20), (2_000, 300)])
@pytest.mark.parametrize("k", [20, 3])
def test_equals_brute_force(spark, k, block_words, query_bytes):
    docs, items = corpus(k)
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, docs string").repartition(3)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, rank string")
    got = lx.search(lx.lexical_index(d, block_words), q, k, query_bytes).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(docs, items, k), key=str)


def test_accumulators_are_limited_and_scores_exact():
    """A common term creates no accumulator once the rare ones have filled the list."""
    rng = np.random.default_rng(1)
    rows = next(iter(lx._index(1 << 20)(_batches(
        [(i, "rare " * 30 + "common " * 2 if i < 30 else "common " + "x " * int(rng.integers(1, 40))) for i in range(5_000)]
    )))).to_pylist()[0]
    own = lx.Queries.of([(0, b"common rare")])
    order = [own.vocabulary.index(b"rare"), own.vocabulary.index(b"common")]
    weights = [lx.term_weight(5_000, {b"rare": 30, b"common": 5_000}[w]) or 1 for w in own.vocabulary]
    plan = lx.Plan(own, weights, [order], 5_000, sum(rows["lengths"]), 20)
    limited, every = lx.Best(20), lx.Best(5_001)
    block = lx.Block(rows, plan)
    assert block.score(order, own.terms[0], limited) == 30
    assert block.score(order, own.terms[0], every) == 5_000
    assert (limited.scores == every.scores[:20]).all() and (limited.ids == every.ids[:20]).all()


def _batches(rows):
    import pyarrow as pa

    yield pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])


def test_messy_and_empty_tables(spark, messy, empty):
    items = spark.createDataFrame([(1, "line word tie tie"), (2, "漢字")], "item_id long, text string")
    want = plain([(r.doc_id, r.text) for r in messy.collect()], [tuple(r) for r in items.collect()], 20)
    got = lx.search(lx.lexical_index(messy), items).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert lx.search(lx.lexical_index(empty), items).collect() == []
    assert lx.search(lx.lexical_index(messy), items.where("false")).collect() == []
