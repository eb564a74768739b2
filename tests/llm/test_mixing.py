import re

import pytest

from cubeloom.llm.mixing import MixPlan, mix, mixed_texts, sainte_lague, source_targets
from pyspark.sql import functions as F


def targets(sizes, plan):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    cap = {s: plan.max_repeats * sizes[s] for s in names}
    open_, rest, out = set(names), plan.total_share * sum(sizes.values()), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > cap[s]]
        if not over:
            return out | {s: rest * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap[s]
            rest -= cap[s]
            open_.remove(s)


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1000, "b": 10, "c": 500, None: 70, "é": 3},
        {"a": 0, "b": 0},
        {"a": 7},
        {"b": 5, "a": 100_000, "Z": 1, "c": 0},
    ],
)
def test_targets_reach_the_same_water_level(spark, sizes):
    df = spark.createDataFrame([(s, float(n)) for s, n in sizes.items()], "source string, source_size double")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = targets(sizes, MixPlan())
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_apportionment_by_highest_quotients(spark):
    claims = [("g", "a", 53_000.0, 7), ("g", "b", 24_000.0, 7), ("g", "c", 23_000.0, 7)]
    claims += [("h", s, w, 100) for s, w in zip("abcdef", (1.0, 2.0, 3.5, 0.0, 90.0, 3.5))]
    claims += [("i", "a", 0.0, 0), ("j", "a", 1.0, 0), (None, "a", 1.0, 5)]
    df = spark.createDataFrame(claims, "g string, s string, w double, seats long")
    got = {(r.g, r.s): r.quota for r in sainte_lague(df, ["g"], "w", "seats", [F.col("s")]).collect()}
    for group in {c[0] for c in claims}:
        own = [c for c in claims if c[0] == group]
        seats = {c[1]: 0 for c in own}
        for _ in range(own[0][3]):
            best = max(own, key=lambda c: (c[2] / (2 * seats[c[1]] + 1), [-ord(x) for x in c[1]]))
            seats[best[1]] += 1
        assert {s: got[group, s] for s in seats} == seats


def test_messy_rows(messy):
    plan = MixPlan(block_words=8, shard_words=20_000)
    rows = mix(messy, plan).collect()
    assert len(rows) == messy.count()
    size = {}
    for r in messy.collect():
        size[r.source] = size.get(r.source, 0) + len((r.text or "").encode().split())
    want = targets(size, plan)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.passes * r.size + sum(b.words for b in r.blocks)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 4 + plan.block_words for s in want)
    again = mix(messy.repartition(5), plan).select("doc_id", "source", "size", "taken")
    first = sorted(map(str, [(r.doc_id, r.source, r.size, r.taken) for r in rows]))
    assert first == sorted(map(str, [tuple(r) for r in again.collect()]))


def test_texts_of_the_mix_hold_the_words_taken(messy):
    plan = MixPlan(block_words=8)
    texts = mixed_texts(messy, plan)
    assert texts.columns == messy.columns
    got = sum(len((r.text or "").encode().split()) for r in texts.collect())
    assert got == sum(r.taken for r in mix(messy, plan).collect())


def test_texts_of_the_mix_keep_their_spacing(spark):
    rows = [(i, f" \n{i}" + "".join(f" \t\nw{j}" + " " * (j % 3) for j in range(17 + i)), "abc"[i % 3]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = MixPlan(block_words=8)
    want = []
    for r in mix(docs, plan).collect():
        text = rows[r.doc_id][1]
        starts = [0, *[m.start() for m in re.finditer(r"[^ \t-\r]+", text)][1:], len(text)]
        want += [(r.doc_id, text)] * r.passes
        if r.blocks:
            cuts = [(b.block * 8, b.block * 8 + b.words) for b in r.blocks]
            want.append((r.doc_id, "".join(text[starts[a] : starts[b]] for a, b in cuts)))
    got = sorted((r.doc_id, r.text) for r in mixed_texts(docs, plan).collect())
    assert got == sorted(want)
    texts = {t for _, t, _ in rows}
    assert {t in texts for _, t in got} == {True, False}


def test_empty_table(empty):
    assert mix(empty).collect() == []
    assert mixed_texts(empty).collect() == []
