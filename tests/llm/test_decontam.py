import random
import re

import numpy as np
import pytest

from cubeloom.llm import decontam as dc


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, window):
    texts = {}
    for item_id, text in items:
        words = plain_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            texts.setdefault(tuple(words[i : i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(t) for t in texts}:
            for i in range(len(words) - n + 1):
                if (own := tuple(words[i : i + n])) in texts:
                    hit |= set(range(i, i + n))
                    found |= texts[own]
        starts = sorted(p for p in hit if p - 1 not in hit)
        stops = sorted(p + 1 for p in hit if p + 1 not in hit)
        out.append((doc_id, len(words), len(hit), starts, stops, sorted(i for i in found if i is not None)))
    return out


def told(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.starts, r.stops, r.items) for r in df.collect()]


def corpus(rng, vocabulary=40):
    words = [f"w{i}" for i in range(vocabulary)] + ["é漢", "Ab9"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(rng.randint(1, 30))) for i in range(25)] + [(3, text(15)), (None, text(20)), (50, ""), (51, None)]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 300]))) for i in range(60)]
    for i in range(30):
        parts = [text(rng.randint(0, 20)), rng.choice(items)[1] or "", text(rng.randint(0, 9))]
        docs.append((100 + i, rng.choice([" ", ", ", "\n"]).join(parts).replace(" ", rng.choice([" ", "-", "; "]))))
    docs += [docs[-1], (7, docs[-1][1]), (None, items[2][1]), (None, None), (200, ""), (201, " \n.")]
    return docs, items


@pytest.mark.parametrize("shard_words, block_bytes", [(1 << 20, 1 << 20), (50, 1 << 20), (37, 200), (1 << 20, 500)])
@pytest.mark.parametrize("window", [10, 3])
def test_equals_brute_force(spark, window, shard_words, block_bytes):
    docs, items = corpus(random.Random(window))
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, mark string").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, row string")
    got = told(dc.contamination(d, b, window, shard_words, block_bytes))
    assert sorted(got, key=str) == sorted(plain(docs, items, window), key=str)
    kept = dc.remove_contaminated(d, b, window=window, shard_words=shard_words, block_bytes=block_bytes)
    assert kept.columns == d.columns
    clean = [r[:2] for r, p in zip(docs, plain(docs, items, window)) if not p[2]]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(clean, key=str)


@pytest.mark.parametrize("shard_words, block_bytes", [(1 << 20, 1 << 20), (37, 200)])
def test_longest_matches_equal_brute_force(spark, shard_words, block_bytes):
    docs, items = corpus(random.Random(5), 12)
    items = [i for i in items if i[0] != 3]
    want = {}
    texts = [(d, plain_words(t)) for d, t in docs]
    for item_id, text in items:
        words = plain_words(text)
        for s in range(len(words) if item_id is not None else 0):
            best, places = 0, []
            for doc_id, own in texts:
                for at in range(len(own)):
                    n = 0
                    while s + n < len(words) and at + n < len(own) and words[s + n] == own[at + n]:
                        n += 1
                    if n > best:
                        best, places = n, []
                    if n == best:
                        places.append((doc_id is None, doc_id, at))
            if best >= 4:
                first = min(places, key=lambda p: (p[0], p[1] or 0, p[2]))
                want[item_id, s] = (best, len(places), *first[1:])
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.longest_matches(d, b, 4, shard_words, block_bytes).collect()
    assert {(r.item_id, r.position): (r.length, r.locations, r.doc_id, r.start) for r in got} == want


@pytest.mark.parametrize("depth", [1, 3, 10, 64])
@pytest.mark.parametrize("top", [1, 3, 2**21])
def test_suffix_order(depth, top):
    rng = np.random.default_rng(depth)
    tokens = rng.integers(1, top + 1, 500).astype(np.int32)
    tokens[rng.integers(0, 500, 12)] = 0
    tokens[-1] = 0
    tokens[200:280] = tokens[300:380]

    def suffix(i):
        own = tokens[i : i + depth].tolist()
        return own[: own.index(0)] if 0 in own else own

    order = dc.suffix_order(tokens, depth).tolist()
    assert sorted(order) == np.flatnonzero(tokens).tolist()
    assert all(suffix(a) <= suffix(b) for a, b in zip(order, order[1:]))


def test_messy_and_empty_tables(spark, messy, empty):
    items = spark.createDataFrame([(1, "a shared LINE of enough length. own line one is"), (2, "tie")], "item_id long, text string")
    want = plain([(r.doc_id, r.text) for r in messy.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert sorted(told(dc.contamination(messy, items)), key=str) == sorted(want, key=str)
    assert sum(w[2] > 0 for w in want) >= 4
    assert told(dc.contamination(empty, items)) == []
    assert all(r[2] == 0 for r in told(dc.contamination(messy, items.where("false"))))
    assert dc.remove_contaminated(messy, items.where("false")).count() == messy.count()
    assert dc.longest_matches(empty, items).collect() == []
