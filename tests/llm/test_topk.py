import math
import random
from fractions import Fraction

import pytest

from cubeloom.llm.topk import exact_top_k, quantised


def plain(rows, k, is_query):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [math.floor(Fraction(x) * 256) for x in v]))
    out = set()
    asked = {}
    for i, v in vectors:
        if is_query(i):
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:k]
        out |= {
            (q, r + 1, i, -s if -(2**63) <= -s < 2**63 else None, str(-s)) for r, (s, i) in enumerate(scores)
        }
    return out


@pytest.mark.parametrize("blocks", [(2_048, 16_384), (3, 7)])
def test_messy_vectors(spark, blocks):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(60)]
    rows += [(100, None), (101, [None, 1.0]), (102, [math.nan]), (103, [math.inf]), (104, []), (105, [1e30])]
    rows += [(i, [0.5] * 6) for i in range(200, 240)]  # ties
    rows += [(5, [0.1] * 6), (5, [0.2] * 6), (None, [1.0] * 6), (300, [1.0, 1.0]), (305, [2.0] * 9), (400, [-0.001] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, v array<double>, score string")
    own = quantised(df, "vec_id", "v")
    got = exact_top_k(own.where("vec_id % 5 = 0"), own, 5, *blocks).collect()
    assert {tuple(r) for r in got} == plain(rows, 5, lambda i: i % 5 == 0)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, v array<double>")
    own = quantised(df, "vec_id", "v")
    got = exact_top_k(own.where("vec_id = 0"), own)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 256 * 512, str(256 * 512))]
    none = own.where("false")
    assert exact_top_k(none, none).collect() == []


@pytest.mark.parametrize("blocks", [(2_048, 16_384), (3, 7)])
def test_large_components_take_part(spark, blocks):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows += [(i, [rng.uniform(-1, 1) * 4e6 for _ in range(4)]) for i in range(40, 60)]
    rows += [(60, [-3e13, 1.0, 0.0, 0.0]), (61, [3e13, -1.0, 0.0, 0.0]), (62, []), (63, [-0.001])]
    rows += [(70, [1e30, 1.0]), (71, [-1e30, 2.0]), (72, [1.7e308] * 4), (75, [-1.7e308, 5e-324]), (76, [1e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    own = quantised(df, "vec_id", "v")
    got = exact_top_k(own.where("vec_id % 5 = 0"), own, 5, *blocks).collect()
    want = plain(rows, 5, lambda i: i % 5 == 0)
    assert {tuple(r) for r in got} == want
    assert any(w[3] is None and w[4].startswith("-") for w in plain(rows[-9:], 9, lambda i: True))
    own = own.where("vec_id >= 60")
    got = exact_top_k(own, own, 9, *blocks).collect()
    assert {tuple(r) for r in got} == plain(rows[-9:], 9, lambda i: True)


def test_sums_beyond_64_bits_that_cancel(spark):
    rows = [(0, [1000.0, -1000.0]), (1, [3e16, 3e16]), (2, [1.0, 0.5])]
    own = quantised(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    got = exact_top_k(own.where("vec_id = 0"), own).collect()
    assert {tuple(r) for r in got} == {(0, 1, 2, 256_000 * 128, "32768000"), (0, 2, 1, 0, "0")}
