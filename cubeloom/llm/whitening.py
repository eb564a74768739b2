"""Whitening of embeddings: an exact distributed covariance and refined eigenvectors.

Components are quantised to integers, x = floor(scale * c).  The fit list holds each distinct x
once.  Spark sums it twice: first the vectors, then, centred by the whole numbers next to the
means, their products.  Products of integers are summed in doubles only as far as those are exact
(20-bit limbs, 4,096 rows at a time) and as integers from there on, so the covariance is the true
one whatever the partitioning, and reruns agree.

Its eigenvectors come in float32 first.  Ogita and Aishima's iteration corrects them: with
R = I - X'X and S = X'AX, and the Rayleigh quotients l of the columns,

    E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i]),    X <- X + X E

which squares the error and needs matrix products only, in doubles and at last in extended
precision.  Eigenvalues nearer to one another than the current error are a cluster: there E is
R / 2, and the cluster's small matrix X'(A - mu I)X, whose large common part is gone, is solved
apart and turns its columns.

Vectors of different lengths count as followed by zeros.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import Shared, tidy
from cubeloom.session import materialize

SCALE = 256
LIMB = 20  # bits
ROWS = 1 << 12  # products of two limbs that a double can sum exactly
FLUSH = 512  # blocks of that many rows that a 64-bit integer can sum
MAX_DIMS = 4_096  # the driver holds a matrix of this size; longer vectors are refused
EXTENDED = np.longdouble
LONG = np.iinfo(np.int64)

# ------------------------------------------------------------------ eigenvectors


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: better columns, their Rayleigh quotients, and how far they were off."""
    one = np.eye(len(a), dtype=a.dtype)
    r = one - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    rest = s - np.diag(values)
    np.fill_diagonal(rest, 0)
    error = 2 * (np.sqrt((rest**2).sum()) + np.sqrt((a**2).sum()) * np.sqrt((r**2).sum()))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > error
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
    np.fill_diagonal(e, np.diag(r) / 2)
    x = x + x @ e
    for cluster in _clusters(values, error):
        x[:, cluster] = _turned(a, x[:, cluster], values[cluster].mean())
    return x, values, float(error)


def _clusters(values: np.ndarray, error: float) -> list[np.ndarray]:
    """Places of eigenvalues of which each is within ``error`` of the next one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > error) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _turned(a: np.ndarray, y: np.ndarray, middle: float) -> np.ndarray:
    """The columns of a cluster, turned to the eigenvectors of the shifted small matrix."""
    for _ in range(2):
        y = y + y @ (np.eye(y.shape[1], dtype=a.dtype) - y.T @ y) / 2
    small = y.T @ (a @ y - middle * y)
    size = np.abs(small).max()
    if size == 0:
        return y
    _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))
    turn = turn.astype(a.dtype)
    turn = turn + turn @ (np.eye(len(turn), dtype=a.dtype) - turn.T @ turn) / 2
    return y @ turn


def eigen(matrix: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix.

    The largest entry of each vector is positive (the first of them in a tie).
    """
    size = np.abs(matrix).max(initial=0)
    if size == 0:
        return np.zeros(len(matrix), matrix.dtype), np.eye(len(matrix), dtype=matrix.dtype)
    a = (matrix / size).astype(EXTENDED)
    _, x = np.linalg.eigh(a.astype(np.float32))
    for kind in (np.float64, EXTENDED):
        own, x, last = a.astype(kind), x.astype(kind), np.inf
        for _ in range(steps):
            x, values, error = _corrected(own, x)
            if error >= last / 2:  # as near as this precision comes
                break
            last = error
    x = x / np.sqrt((x**2).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    top = np.argmax(np.abs(x), 0)
    x = x * np.where(x[top, np.arange(x.shape[1])] < 0, -1, 1)
    return values[order] * size, x


# ------------------------------------------------------------------ quantised vectors


def sound_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, c): vectors that are not null and hold finite numbers only."""
    c = F.col("c")
    finite = F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c")
    ).where(c.isNotNull() & F.coalesce(finite, F.lit(False)))


def quantise(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * c) as 64-bit integers, which end where those end."""
    with np.errstate(over="ignore"):
        floors = np.floor(values * float(scale))
    inside = (floors >= -(2.0**63)) & (floors < 2.0**63)
    x = np.where(inside, floors, 0).astype(np.int64)
    x[~inside] = np.where(floors[~inside] > 0, LONG.max, LONG.min)
    return x


def _rows(lists: pa.Array, scale: int) -> Iterator[np.ndarray]:
    """x of each row."""
    lengths = np.diff(lists.offsets.to_numpy())
    x = quantise(lists.flatten().to_numpy(zero_copy_only=False), scale)
    yield from np.split(x, np.cumsum(lengths)[:-1])


def _matrix(lists: pa.Array, scale: int, dims: int) -> np.ndarray:
    """Rows of x, zeros behind the shorter ones."""
    lengths = np.diff(lists.offsets.to_numpy())
    x = quantise(lists.flatten().to_numpy(zero_copy_only=False), scale)
    if (lengths == dims).all():
        return x.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = x
    return out


def _pack(x: np.ndarray) -> bytes:
    """The same bytes for the same vector: width of a number, then numbers up to the last one."""
    least, most = int(x.min(initial=0)), int(x.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= least and most < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes().rstrip(b"\0")


def _unpack(packed: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(packed), dims), np.int64)
    for i, value in enumerate(packed.to_pylist()):
        width = value[0]
        own = np.frombuffer(value[1:].ljust(-(-(len(value) - 1) // width) * width, b"\0"), f"<i{width}")
        out[i, : len(own)] = own
    return out


def fit_list(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(x, dims): each distinct quantised vector once, and the greatest length it came with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            if not rows.num_rows:
                continue
            lists = rows.column("c")
            packed = [_pack(x) for x in _rows(lists, scale)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), pa.array(np.diff(lists.offsets.to_numpy()), pa.int32())],
                ["x", "dims"],
            )

    packed = vectors.select("c").mapInArrow(run, "x binary, dims int")
    return materialize(packed.groupBy("x").agg(F.max("dims").alias("dims")), "whitening-fit")


# ------------------------------------------------------------------ moments


@dataclass(frozen=True)
class Moments:
    """The fit list's size, sums and products, exact."""

    n: int
    sums: list[int]
    middle: list[int]  # whole numbers next to the means
    products: np.ndarray  # of what is left, summed; Python's integers

    @property
    def left(self) -> list[int]:
        """Sums of what is left when the middles are taken away."""
        return [s - self.n * m for s, m in zip(self.sums, self.middle)]

    def covariance(self) -> np.ndarray:
        """The true covariance with divisor n, rounded once to extended precision."""
        left = np.array(self.left, object)
        scaled = self.n * self.products - left[:, None] * left[None, :]
        return _extended(scaled) / _extended(np.array([[self.n * self.n]], object))


def _extended(whole: np.ndarray) -> np.ndarray:
    high = whole.astype(np.float64)
    rest = whole - np.array([int(h) for h in high.flat], object).reshape(whole.shape)
    return high.astype(EXTENDED) + rest.astype(np.float64)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        n, least, most = 0, 0, 0
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for rows in batches:
            x = _unpack(rows.column("x"), dims)
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
            least, most = min(least, int(x.min(initial=0))), max(most, int(x.max(initial=0)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(dims, dtype=np.int32)),
                pa.array(high),
                pa.array(low),
                pa.array(np.full(dims, n)),
                pa.array(np.full(dims, least)),
                pa.array(np.full(dims, most)),
            ],
            ["dim", "high", "low", "n", "least", "most"],
        )

    return run


def _limbs(z: np.ndarray, count: int) -> list[np.ndarray]:
    """Doubles whose sum, each times 2 ** (LIMB * place), is z; the last one has the sign."""
    parts = [(z >> LIMB * i & (1 << LIMB) - 1) for i in range(count - 1)]
    return [p.astype(np.float64) for p in (*parts, z >> LIMB * (count - 1))]


def _products(dims: int, middle: np.ndarray, limbs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        levels = 2 * limbs - 1
        total, blocks = np.zeros((levels, dims, dims), np.int64), 0

        def told() -> Iterator[pa.RecordBatch]:
            for level in range(levels):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(dims, level, np.int32)),
                        pa.array(np.arange(dims, dtype=np.int32)),
                        pa.array(list(total[level]), pa.list_(pa.int64())),
                    ],
                    ["level", "row", "products"],
                )

        for rows in batches:
            z = _unpack(rows.column("x"), dims) - middle
            for lo in range(0, len(z), ROWS):
                parts = _limbs(z[lo : lo + ROWS], limbs)
                for i, a in enumerate(parts):
                    for j, b in enumerate(parts):
                        total[i + j] += (a.T @ b).astype(np.int64)
                blocks += 1
                if blocks * limbs >= FLUSH:
                    yield from told()
                    total[:], blocks = 0, 0
        yield from told()

    return run


def moments(fit: DataFrame) -> Moments | None:
    """What the covariance needs; None for an empty fit list.  The driver sees dims² numbers."""
    dims = fit.agg(F.max("dims")).first()[0]
    if dims is None:
        return None
    if dims > MAX_DIMS:
        raise ValueError(f"vectors have {dims} components, more than {MAX_DIMS}")
    dims = max(1, dims)

    def whole(name: str):
        return F.sum(F.col(name).cast("decimal(20,0)")).alias(name)

    per_dim = (
        fit.mapInArrow(_sums(dims), "dim int, high long, low long, n long, least long, most long")
        .groupBy("dim")
        .agg(whole("high"), whole("low"), F.sum("n").alias("n"), F.min("least").alias("a"), F.max("most").alias("b"))
        .orderBy("dim")
        .collect()
    )
    n = per_dim[0].n
    sums = [(int(r.high) << 32) + int(r.low) for r in per_dim]
    widest = max(-per_dim[0].a, per_dim[0].b)
    # beside numbers near the end of 64 bits there is no room to take a middle away
    middle = [(2 * s + n) // (2 * n) if widest < 1 << 61 else 0 for s in sums]
    limbs = -(-(max(1, widest + max(map(abs, middle))).bit_length() + 1) // LIMB)
    made = fit.mapInArrow(
        _products(dims, np.array(middle, np.int64), limbs), "level int, row int, products array<long>"
    )
    rows = (
        made.select("level", "row", F.posexplode("products").alias("column", "p"))
        .groupBy("level", "row", "column")
        .agg(whole("p"))
        .toArrow()
    )
    products = np.zeros((dims, dims), object)
    for level, row, column, p in zip(*(rows.column(c).to_pylist() for c in ("level", "row", "column", "p"))):
        products[row, column] += int(p) << LIMB * level
    return Moments(n, sums, middle, products)


# ------------------------------------------------------------------ whitening


@dataclass(frozen=True)
class Whitening:
    """Components in their order; ``scaled`` has NaN where an eigenvalue is zero."""

    moments: Moments
    vectors: np.ndarray  # (components, dims), unit
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def scaled(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.vectors / np.where(self.values > 0, np.sqrt(self.values), np.nan)[:, None]

    def centred(self, x: np.ndarray) -> np.ndarray:
        left = np.array([t / self.moments.n for t in self.moments.left])
        return (x - np.array(self.moments.middle, np.int64)).astype(np.float64) - left

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.scaled.T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n x - S)^2 for each row, exact: n^2 z z - 2 n z t + t t with z = x - middle."""
        n, left = self.moments.n, self.moments.left
        z = x - np.array(self.moments.middle, np.int64)
        reach = int(np.abs(z.astype(np.float64)).max(initial=0)) + 1
        wide = reach * max(reach, *map(abs, left), 1) * max(1, len(left)) >= 1 << 62
        z = z.astype(object) if wide else z
        squares, across = (z * z).sum(1), (z * np.array(left, object if wide else np.int64)).sum(1)
        rest = sum(t * t for t in left)
        return [n * n * int(a) - 2 * n * int(b) + rest for a, b in zip(squares, across)]


def _unit_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened fit list's covariance less the identity, as measured."""
    held = np.flatnonzero(np.isfinite(model.scaled).all(1))
    if not len(held):
        return None
    sent, k = Shared(fit.sparkSession, model), len(held)
    dims = model.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        total = np.zeros((k + 1, k + 1))
        for rows in batches:
            w = sent.value.project(_unpack(rows.column("x"), dims))[:, held]
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            total += w.T @ w
        place = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "v"])

    # whitened values are centred already; what is left of their mean goes here
    rows = fit.mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v"))
    found = np.zeros((k + 1) ** 2)
    for place, v in rows.collect():
        found[place] = v
    found = found.reshape(k + 1, k + 1) / model.moments.n
    return float(np.abs(found[:k, :k] - np.outer(found[:k, k], found[:k, k]) - np.eye(k)).max())


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    found = moments(fit)
    if found is None:
        return None
    covariance = found.covariance()
    values, vectors = eigen(covariance)
    total = np.trace(covariance)
    values, vectors = values[:components], vectors[:, :components].T
    # what extended precision cannot tell from zero is zero
    values = np.where(values > len(covariance) * np.finfo(np.float64).eps * total / 64, values, 0)
    explained = values / total if total > 0 else np.full(len(values), np.nan)
    model = Whitening(found, *(v.astype(np.float64) for v in (vectors, values, explained)))
    error = _unit_error(fit, model)
    return Whitening(model.moments, model.vectors, model.values, model.explained, error)


WHITE = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("component", pa.int32()),
        ("n", pa.int64()),
        ("deviation", pa.int64()),
        ("deviation_wide", pa.string()),
        ("whitened", pa.float64()),
        ("explained", pa.float64()),
        ("identity_error", pa.float64()),
    ]
)
WHITE_DDL = (
    "vec_id long, component int, n long, deviation long, deviation_wide string, whitened double, "
    "explained double, identity_error double"
)


def whiten(
    vectors: DataFrame,
    components: int = 4,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per sound vector and component, as ``WHITE_DDL`` has it.

    Vectors that are null or hold a null or non-finite component are left out; a null id stays.
    Repeated vectors count once in the fit and give their rows each.  x ends where 64 bits end.
    A vector without components is all zeros.  ``deviation`` is null where it needs more than 64
    bits; ``deviation_wide`` has its digits then.  ``whitened`` is null for a component whose
    eigenvalue is zero, ``explained`` if all are.  No sound vector: no rows.
    """
    own = sound_vectors(vectors, id_col, vector_col)
    model = fit_whitening(fit_list(own, scale), components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITE_DDL)
    sent, dims, k = Shared(vectors.sparkSession, model), model.vectors.shape[1], len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            if not rows.num_rows:
                continue
            x, n = _matrix(rows.column("c"), scale, dims), rows.num_rows
            away = sent.value.deviations(x)
            fits = [d if d <= LONG.max else None for d in away]
            wide = [str(d) if d > LONG.max else None for d in away]
            white = sent.value.project(x).ravel()
            every = np.repeat(np.arange(n), k)
            error = sent.value.identity_error
            explained = np.tile(sent.value.explained, n)
            columns = [
                rows.column("vec_id").take(pa.array(every)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, sent.value.moments.n)),
                pa.array(fits, pa.int64()).take(pa.array(every)),
                pa.array(wide, pa.string()).take(pa.array(every)),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained, mask=np.isnan(explained)),
                pa.array([error] * (n * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=WHITE)

    return own.mapInArrow(run, WHITE_DDL)
