import math
from fractions import Fraction

import numpy as np
import pytest

from cubeloom.llm import whitening as wh


def build(eigenvalues, seed=1):
    """A matrix of these eigenvalues in extended precision, and its eigenvectors."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(eigenvalues),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(len(q)) - q.T @ q) / 2
    return (q * np.array(eigenvalues, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values, tolerance",
    [
        ([5.0, 4.0, 3.0, 2.0, 1.0, 0.5], 1e-16),
        ([1e6, 1e3, 1.0, 1e-3], 1e-11),  # as far as the matrix itself has it
        ([2.0, 1.0 + 1e-8, 1.0, 1.0 - 1e-8, 0.1], 1e-9),
        ([3.0, 2.0 + 2e-10, 2.0 + 1e-10, 2.0, 1.0, 1.0 - 1e-9], 1e-7),
        (list(np.linspace(2, 1, 64)), 1e-15),
    ],
)
def test_eigenvectors_to_full_precision(values, tolerance):
    a, q = build(values)
    got, x = wh.eigen(a)
    assert np.abs(got - np.array(values)).max() < 1e-15 * max(values)
    assert np.abs(np.abs((x * q).sum(0)) - 1).max() < tolerance
    assert np.abs(x - q * np.sign((x * q).sum(0))).max() < tolerance
    # float32 alone is far off
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(rough - q * np.sign((rough * q).sum(0))).max() > 1e-8


def test_equal_eigenvalues_keep_an_orthonormal_basis():
    a, _ = build([2.0, 1.0, 1.0, 1.0, 0.0, 0.0])
    values, x = wh.eigen(a)
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-17
    assert np.abs(a @ x - x * values).max() < 1e-17
    values, x = wh.eigen(np.zeros((3, 3), np.longdouble))
    assert not values.any() and (x == np.eye(3)).all()


def plain(rows, k):
    """Exact fractions for all but the eigenvectors."""
    kept = [
        (i, [max(-(2**63), min(2**63 - 1, math.floor(256 * c))) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    dims = max(len(v) for _, v in kept)
    kept = [(i, v + [0] * (dims - len(v))) for i, v in kept]
    fit = [list(v) for v in sorted({tuple(v) for _, v in kept})]
    n = len(fit)
    s = [sum(v[d] for v in fit) for d in range(dims)]
    cov = [
        [float(sum((Fraction(v[a]) - Fraction(s[a], n)) * (Fraction(v[b]) - Fraction(s[b], n)) for v in fit) / n) for b in range(dims)]
        for a in range(dims)
    ]
    e, u = np.linalg.eigh(np.array(cov))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, v in kept:
        away = sum((n * x - t) ** 2 for x, t in zip(v, s))
        centred = np.array([float(Fraction(x) - Fraction(t, n)) for x, t in zip(v, s)])
        for c in range(k):
            out.append((i, c + 1, n, away, float(centred @ u[:, c]) / math.sqrt(e[c]), e[c] / np.trace(cov)))
    return out


def compare(spark, rows, k=4):
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<double>, n string, c string")
    got = wh.whiten(df.repartition(3), k).collect()
    want = plain(rows, k)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[3] or 0, r[1])
    signs = {}
    for g, w in zip(
        sorted(((r.vec_id, r.component, r.n, r.deviation if r.deviation_wide is None else int(r.deviation_wide), r.whitened, r.explained) for r in got), key=key),
        sorted(want, key=key),
    ):
        assert g[:4] == w[:4]
        if abs(w[4]) > 1e-6:
            sign = math.copysign(1, g[4] * w[4])
            assert signs.setdefault(g[1], sign) == sign
            assert g[4] * sign == pytest.approx(w[4], rel=1e-9, abs=1e-9)
        assert g[5] == pytest.approx(w[5], rel=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)
    return got


def test_messy_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * [3, 2, 1, 0.5, 0.2]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # copies count once in the fit
    rows += [(7, rows[9][1]), (None, [1.0] * 5), (2000, None), (2001, [1.0, None]), (2002, [math.nan] * 5)]
    rows += [(2003, [1.0, math.inf]), (2004, []), (2005, [0.25]), (2006, [0.25, 0.0]), (2007, [-0.0] * 5)]
    compare(spark, rows)


def test_wide_components_are_exact(spark):
    rng = np.random.default_rng(4)
    compare(spark, [(i, (rng.normal(size=4) * [1e9, 1e8, 3e7, 1e7]).tolist()) for i in range(100)])
    got = compare(spark, [(i, (rng.normal(size=4) * [3e15, 1e15, 4e14, 1e14]).tolist()) for i in range(60)])
    assert all(r.deviation is None for r in got)


def test_numbers_beyond_64_bits_end_there(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = wh.whiten(df, 1).collect()
    assert {r.vec_id for r in got} == {1, 2, 3}
    assert all(r.identity_error < 1e-4 and math.isfinite(r.whitened) for r in got)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert wh.whiten(spark.createDataFrame([], schema)).collect() == []
    assert wh.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [
        (i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)
    ]
    line = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], schema)).collect()
    assert {(r.component, None if r.whitened is None else round(abs(r.whitened), 9)) for r in line} == {(1, 1.0), (2, None)}


def test_partitioning_changes_nothing(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    a, b = (wh.fit_whitening(wh.fit_list(wh.sound_vectors(v, "vec_id", "embedding")), 4) for v in (vectors, vectors.repartition(7)))
    assert (a.vectors == b.vectors).all() and (a.values == b.values).all() and a.moments.sums == b.moments.sums
