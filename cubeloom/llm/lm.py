"""Language-model scores: a log-bilinear model trained by noise contrast on all training texts.

Every word that has at least ``sqrt(N) / 4`` of the ``N`` training tokens has vectors of its own;
so there are at most ``4 sqrt(N)`` of them, and more with more text.  All other words fall into
classes by their shape (ending letter, punctuation, letters beyond ASCII), and the end of a text
is a class.  For a position with the class ``h`` one or two places before,

    P(word) = P(class | h1, h2) * P(word | class)

P(class | ...) mixes two log-bilinear models, one for each distance, with the class unigram; a
log-bilinear model gives the class w the score (r_h C) . q_w + b_w.  Both are trained in numpy
with noise-contrastive estimation on the pairs of *all* training texts: Spark adds up their
counts, cut into blocks of histories; in every round each block gives its part of the gradient by
batched matrix products (the noise words of a pair enter by their expectation, so nothing is
drawn), and the driver gets one sum of the size of the model.  The parts are added as fixed-point
integers, so neither partitions nor repeated tasks change a score.
Normalisers are computed once for each history; scoring a position is one product of two vectors.
A rare word has its add-one share of its class, with one place left for unknown words of that
shape; hence the probabilities of all words add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm.chunks import (
    documents_of,
    pack_bytes,
    pack_ints,
    packets_of,
    unpack_bytes,
    unpack_ints,
    unpack_words,
    word_order,
    write_chunks,
)
from cubeloom.llm.common import Shared, shuffle_partitions, text_of, tidy
from cubeloom.session import materialize

SHAPES = 32
END = SHAPES  # classes: the shapes, the end, then the words with vectors of their own
FIRST_WORD = SHAPES + 1
OWN_SHARE = 16  # a word is a class of its own if OWN_SHARE * count**2 >= training tokens
HISTORIES = 64  # rows of a block of pair counts
PART = 1 << 16  # numbers of a gradient that are added up together
FIXED = float(1 << 44)  # of gradients, whose entries are below 2**10


def pack_longs(values: np.ndarray) -> bytes:
    """Signed 64-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return pack_bytes(planes.tobytes())


def unpack_longs(data: bytes) -> np.ndarray:
    raw = np.frombuffer(unpack_bytes(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def split_words(text: bytes) -> list[bytes]:
    return text.lower().split()


def shape_of(word: bytes) -> int:
    """One of ``SHAPES`` shapes: mark at the end, bytes beyond ASCII, ending letter."""
    bare = word.rstrip(b".,;:!?")
    letter = bare[-1] % 8 if bare else 0
    return (letter << 2) | (len(bare) < len(word)) << 1 | (not word.isascii())


# ------------------------------------------------------------------ counts of the corpus

COUNTED = pa.schema(
    [
        ("kind", pa.string()),
        ("chunk", pa.int64()),
        ("bucket", pa.int32()),
        ("numbers", pa.binary()),
        ("counts", pa.binary()),
        ("tags", pa.binary()),
        ("shape", pa.int32()),
        ("total", pa.int64()),
        ("distinct", pa.int64()),
    ]
)
COUNTED_DDL = (
    "kind string, chunk long, bucket int, numbers binary, counts binary, tags binary, "
    "shape int, total long, distinct long"
)


def _count_bucket(tokens: int):
    """Corpus counts of a bucket's words, back to every chunk; and the bucket's totals.

    A word's tag is its shape and, if it is a class of its own, its place among the bucket's.
    """

    def run(key, packets):
        tidy()
        bucket = key[0].as_py()
        totals: dict[bytes, int] = {}
        read = []
        for chunk, n, numbers, words, counts in zip(
            *(packets.column(c).to_pylist() for c in ("chunk", "n", "numbers", "words", "counts"))
        ):
            own = unpack_words(words, n)
            for word, count in zip(own, unpack_ints(counts).tolist()):
                totals[word] = totals.get(word, 0) + count
            read.append((chunk, numbers, own))
        top = sorted(w for w, n in totals.items() if n and OWN_SHARE * n * n >= tokens)
        place = {w: i + 1 for i, w in enumerate(top)}
        tags = {w: shape_of(w) | place.get(w, 0) << 8 for w in totals}
        rows: dict[str, list] = {name: [] for name in COUNTED.names}

        def add(**values) -> None:
            for name in COUNTED.names:
                rows[name].append(values.get(name))

        for chunk, numbers, own in read:
            add(
                kind="packet",
                chunk=chunk,
                bucket=bucket,
                numbers=numbers,
                counts=pack_longs(np.array([totals[w] for w in own], np.int64)),
                tags=pack_ints(np.array([tags[w] for w in own], np.int64)),
            )
        add(kind="top", bucket=bucket, counts=pack_longs(np.array([totals[w] for w in top], np.int64)))
        sums = np.zeros((SHAPES, 4), np.int64)  # tokens and types, of all words and of rare ones
        for word, total in totals.items():
            if total:
                sums[shape_of(word)] += (total, 1, 0, 0) if word in place else (total, 1, total, 1)
        for shape, (total, distinct, rare, rare_types) in enumerate(sums.tolist()):
            add(kind="shape", shape=shape, total=total, distinct=distinct)
            add(kind="rare", shape=shape, total=rare, distinct=rare_types)
        return pa.table([pa.array(rows[f.name], f.type) for f in COUNTED], schema=COUNTED)

    return run


@dataclass(frozen=True)
class CorpusCounts:
    """What the corpus has in all; its size is bounded by the number of classes."""

    tokens: int  # N, ends counted
    types: int  # V, the end counted
    ends: int
    first: dict[int, int]  # bucket -> class of its first word with vectors of its own
    rare: np.ndarray  # for each shape: tokens, types that are no class of their own
    totals: np.ndarray  # training tokens of each class

    @property
    def classes(self) -> int:
        return len(self.totals)


def gather_counts(counted: DataFrame, ends: int) -> CorpusCounts:
    sums = np.zeros((2, SHAPES, 2), np.int64)
    shapes = (
        counted.where("kind IN ('shape', 'rare')")
        .groupBy("kind", "shape")
        .agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"))
    )
    for row in shapes.collect():
        sums[int(row.kind == "rare"), row.shape] = (row.total, row.distinct)
    first, totals = {}, [sums[1, :, 0], np.array([ends], np.int64)]
    number = FIRST_WORD
    for row in counted.where("kind = 'top'").select("bucket", "counts").orderBy("bucket").collect():
        first[row.bucket] = number
        totals.append(unpack_longs(bytes(row.counts)))
        number += len(totals[-1])
    tokens, types = (int(x) for x in sums[0].sum(0))
    return CorpusCounts(tokens + ends, types + (ends > 0), ends, first, sums[1], np.concatenate(totals))


# ------------------------------------------------------------------ classes of the documents

SEQUENCE = pa.schema(
    [
        ("lag", pa.int32()),
        ("block", pa.int32()),
        ("pairs", pa.binary()),
        ("counts", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("flags", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("known", pa.list_(pa.int64())),
        ("base", pa.list_(pa.float64())),
        ("rare", pa.list_(pa.float64())),
        ("data", pa.binary()),
    ]
)
SEQUENCE_DDL = (
    "lag int, block int, pairs binary, counts binary, doc_ids array<long>, flags array<boolean>, lengths array<int>, known array<long>, "
    "base array<double>, rare array<double>, data binary"
)


def histories(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before; the end's class stands before a text."""
    one, two = np.full(len(classes), END), np.full(len(classes), END)
    one[1:] = classes[:-1]
    two[2:] = classes[:-2]
    one[starts] = END
    two[starts] = END
    after = starts[starts + 1 < len(classes)] + 1
    two[after] = END
    return one, two


def _classify_chunk(shared):
    """cogroup of a chunk: class sequences and partial scores, and the chunk's counts of pairs."""

    def run(docs, packets):
        tidy()
        corpus: CorpusCounts = shared.value
        size = corpus.classes
        place = word_order(packets)
        counts, classes = [], []
        for bucket, own_counts, tags in zip(
            *(packets.column(c).to_pylist() for c in ("bucket", "counts", "tags"))
        ):
            tag = unpack_ints(tags).astype(np.int64)
            at = tag >> 8
            classes.append(np.where(at > 0, corpus.first[bucket] + at - 1, tag & 0xFF))
            counts.append(unpack_longs(own_counts))
        counts = np.concatenate(counts).astype(np.float64)[place] if counts else np.empty(0)
        classes = np.concatenate(classes)[place] if classes else np.empty(0, np.int64)
        log_count = np.log10(counts + 1)
        room = np.log10(corpus.rare.sum(1) + 1)
        inside = np.zeros(len(classes))
        is_rare = classes < SHAPES
        inside[is_rare] = log_count[is_rare] - room[classes[is_rare]]
        norm = np.log10(corpus.tokens + corpus.types + 1)
        seen: tuple[list, list] = ([], [])
        rows: dict[str, list] = {name: [] for name in SEQUENCE.names}

        def add(**values) -> None:
            for name in SEQUENCE.names:
                rows[name].append(values.get(name))

        for doc_ids, flags, lengths, numbers in zip(
            *(docs.column(c).to_pylist() for c in ("doc_ids", "flags", "lengths", "numbers"))
        ):
            words = unpack_ints(numbers)
            sizes = np.array(lengths, np.int64)
            cuts = np.concatenate([[0], np.cumsum(sizes)])

            def per_doc(values: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[0.0], np.cumsum(values)])
                return sums[cuts[1:]] - sums[cuts[:-1]]

            sequence = np.insert(classes[words], cuts[1:], END)
            starts = cuts[:-1] + np.arange(len(sizes))
            base = per_doc(log_count[words]) + np.log10(corpus.ends + 1) - (sizes + 1) * norm
            trains = np.repeat(np.array(flags, bool), sizes + 1)
            for lag, history in enumerate(histories(sequence, starts)):
                seen[lag].append(history[trains] * size + sequence[trains])
            known = per_doc((counts[words] > 0).astype(float)) + (corpus.ends > 0)
            add(
                doc_ids=doc_ids,
                flags=flags,
                lengths=(sizes + 1).tolist(),
                known=known.round().astype(np.int64).tolist(),
                base=base.tolist(),
                rare=per_doc(inside[words]).tolist(),
                data=pack_ints(sequence),
            )
        for lag, pairs in enumerate(seen):
            pairs, times = np.unique(np.concatenate(pairs or [np.empty(0, np.int64)]), return_counts=True)
            for block, cells, own in _blocks(pairs, times, size):
                add(lag=lag, block=block, pairs=pack_longs(np.diff(cells, prepend=0)), counts=pack_longs(own))
        return pa.table([pa.array(rows[f.name], f.type) for f in SEQUENCE], schema=SEQUENCE)

    return run


def _blocks(pairs: np.ndarray, counts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorted pairs (history * size + class) and their counts, by blocks of histories."""
    block = pairs // (HISTORIES * size)
    numbers, starts = np.unique(block, return_index=True)
    for number, lo, hi in zip(numbers.tolist(), starts, [*starts[1:], len(pairs)]):
        yield number, pairs[lo:hi], counts[lo:hi]


class PairCounts:
    """Running counts of the pairs of one block, in the memory of its distinct pairs."""

    def __init__(self):
        self.pairs, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((pairs, counts))
        self.size += len(pairs)
        if self.size > len(self.pairs) + PART:
            self.settle()

    def settle(self) -> None:
        every = [(self.pairs, self.counts), *self.waiting]
        self.pairs, where = np.unique(np.concatenate([p for p, _ in every]), return_inverse=True)
        counts = np.zeros(len(self.pairs), np.int64)
        np.add.at(counts, where, np.concatenate([n for _, n in every]))
        self.counts, self.waiting, self.size = counts, [], 0


PAIRS_DDL = "lag int, block int, pairs binary, counts binary"


def _add_pairs(batches):
    """Counts of a task's rows, one row for each block."""
    sums: dict[tuple[int, int], PairCounts] = {}
    for rows in batches:
        for lag, block, pairs, counts in zip(
            *(rows.column(c).to_pylist() for c in ("lag", "block", "pairs", "counts"))
        ):
            own = sums.setdefault((lag, block), PairCounts())
            own.add(np.cumsum(unpack_longs(pairs)), unpack_longs(counts))
    for (lag, block), own in sums.items():
        own.settle()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lag], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([pack_longs(np.diff(own.pairs, prepend=0))], pa.binary()),
                pa.array([pack_longs(own.counts)], pa.binary()),
            ],
            ["lag", "block", "pairs", "counts"],
        )


def pair_counts(sequences: DataFrame) -> DataFrame:
    """Counts of (history, class) over all training texts: a row for each distance and block."""
    parts = sequences.where("block IS NOT NULL").select("lag", "block", "pairs", "counts")
    # a number of partitions that is not merged again: every round reads these files in parallel
    tasks = shuffle_partitions(sequences.sparkSession)
    summed = parts.mapInArrow(_add_pairs, PAIRS_DDL).repartition(tasks, "lag", "block")
    return materialize(summed.mapInArrow(_add_pairs, PAIRS_DDL), "lm-pairs")


# ------------------------------------------------------------------ the model


@dataclass(frozen=True)
class Training:
    width: int = 32
    rounds: int = 30  # over all pairs of the corpus
    noise: int = 128  # noise words of a pair, counted as often as they are expected
    rate: float = 0.15
    seed: int = 7
    mix: tuple[float, float, float] = (0.65, 0.25, 0.10)  # one before, two before, unigram


class LogBilinear:
    """Scores (r_h C) . q_w + b_w of one distance; all its numbers lie in one array."""

    def __init__(self, unigram: np.ndarray, how: Training, rng: np.random.Generator):
        self.size, self.width, self.rate = len(unigram), how.width, how.rate
        n, d = self.size, how.width
        self.numbers = np.concatenate(
            [rng.normal(0, 0.1, n * d), np.eye(d).ravel(), rng.normal(0, 0.1, n * d), np.log(unigram)]
        )
        self.memory = np.full(len(self.numbers), 1e-20)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": None}  # only the driver steps

    def views(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n, d = self.size, self.width
        r, c, q, b = np.split(numbers, np.cumsum([n * d, d * d, n * d]))
        return r.reshape(n, d), c.reshape(d, d), q.reshape(n, d), b

    def gradient(
        self, lo: int, shares: np.ndarray, log_noise: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of the noise-contrastive loss of the histories from ``lo`` on: their rows', the rest's.

        ``shares`` (histories, classes) are shares of all pairs; ``log_noise`` is the log of how
        often each class is expected among the noise words of a pair.
        """
        r, c, q, b = self.views(self.numbers)
        own = r[lo : lo + len(shares)]
        context = own @ c
        is_true = context @ q.T
        is_true += b - log_noise
        np.clip(is_true, -30, 30, out=is_true)
        np.negative(is_true, out=is_true)
        np.exp(is_true, out=is_true)
        is_true += 1
        np.reciprocal(is_true, out=is_true)
        # taken for true though noise, less taken for noise though true
        wrong = shares.sum(1, keepdims=True) * np.exp(log_noise) + shares
        wrong *= is_true
        wrong -= shares
        d_context = wrong @ q
        rest = [(own.T @ d_context).ravel(), (wrong.T @ context).ravel(), wrong.sum(0)]
        return (d_context @ c.T).ravel(), np.concatenate(rest)

    def add_gradient(self, total: np.ndarray, lo: int, shares: np.ndarray, log_noise: np.ndarray) -> None:
        """Add it to ``total``, in fixed point."""
        rows, rest = self.gradient(lo, shares, log_noise)
        at = lo * self.width
        total[at : at + len(rows)] += np.rint(rows * FIXED).astype(np.int64)
        total[self.size * self.width :] += np.rint(rest * FIXED).astype(np.int64)

    def step(self, gradient: np.ndarray) -> None:
        self.memory += gradient**2
        self.numbers -= self.rate * gradient / np.sqrt(self.memory)

    def normalisers(self, lo: int, hi: int) -> np.ndarray:
        """The log of the sum over all classes, for the histories lo..hi."""
        r, c, q, b = self.views(self.numbers)
        scores = r[lo:hi] @ c @ q.T + b
        high = scores.max(1)
        return high + np.log(np.exp(scores - high[:, None]).sum(1))


def shares_of(pairs: np.ndarray, counts: np.ndarray, block: int, size: int, total: int) -> np.ndarray:
    """A block's counts as shares of all pairs, as a dense matrix."""
    rows = min(HISTORIES, size - block * HISTORIES)
    out = np.zeros(rows * size)
    out[pairs - block * HISTORIES * size] = counts / total
    return out.reshape(rows, size)


GRADIENT_DDL = "lag int, part int, data binary"


def _gradients(shared):
    """The gradients of a task's blocks, added up in fixed point and cut into parts."""

    def run(batches):
        models, log_noise, total = shared.value
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for lag, block, pairs, counts in zip(
                *(rows.column(c).to_pylist() for c in ("lag", "block", "pairs", "counts"))
            ):
                shares = shares_of(
                    np.cumsum(unpack_longs(pairs)), unpack_longs(counts), block, models[lag].size, total
                )
                own = sums.setdefault(lag, np.zeros(len(models[lag].numbers), np.int64))
                models[lag].add_gradient(own, block * HISTORIES, shares, log_noise)
        for lag, own in sums.items():
            for part in range(0, len(own), PART):
                if own[part : part + PART].any():
                    yield _part_row(lag, part // PART, own[part : part + PART])

    return run


def _part_row(lag: int, part: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lag], pa.int32()), pa.array([part], pa.int32()), pa.array([pack_longs(values)], pa.binary())],
        ["lag", "part", "data"],
    )


def _add_parts(batches):
    sums: dict[tuple[int, int], np.ndarray] = {}
    for rows in batches:
        for lag, part, data in zip(*(rows.column(c).to_pylist() for c in ("lag", "part", "data"))):
            own = unpack_longs(data)
            sums[lag, part] = sums[lag, part] + own if (lag, part) in sums else own
    for (lag, part), own in sums.items():
        yield _part_row(lag, part, own)


def unigram_of(totals: np.ndarray) -> np.ndarray:
    return (totals + 1) / (totals.sum() + len(totals))


def train(pairs: DataFrame, corpus: CorpusCounts, how: Training) -> list[LogBilinear]:
    """The models of both distances; each round is one pass over the counts of all pairs."""
    spark = pairs.sparkSession
    unigram = unigram_of(corpus.totals)
    rng = np.random.default_rng(how.seed)
    models = [LogBilinear(unigram, how, rng) for _ in range(2)]
    log_noise = np.log(how.noise * unigram)
    for _ in range(how.rounds if corpus.tokens else 0):
        shared = Shared(spark, (models, log_noise, corpus.tokens))
        summed = pairs.mapInArrow(_gradients(shared), GRADIENT_DDL).repartition("lag", "part")
        gradients = [np.zeros(len(m.numbers)) for m in models]
        for row in summed.mapInArrow(_add_parts, GRADIENT_DDL).collect():
            own = unpack_longs(bytes(row.data)) / FIXED
            gradients[row.lag][row.part * PART : row.part * PART + len(own)] = own
        for model, gradient in zip(models, gradients):
            model.step(gradient)
    return models


@dataclass(frozen=True)
class MixedModel:
    """Both distances and the unigram, ready to score: context rows, class rows and normalisers."""

    context: list[np.ndarray]
    output: list[np.ndarray]
    bias: list[np.ndarray]
    log_z: list[np.ndarray]
    unigram: np.ndarray
    mix: tuple[float, float, float]

    @classmethod
    def of(cls, spark: SparkSession, models: list[LogBilinear], unigram: np.ndarray, how: Training) -> MixedModel:
        size = len(unigram)
        shared = Shared(spark, models)

        def normalise(batches):
            for rows in batches:
                for block in rows.column("id").to_pylist():
                    lo = block * HISTORIES
                    for lag, model in enumerate(shared.value):
                        values = model.normalisers(lo, min(size, lo + HISTORIES))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lag], pa.int32()),
                                pa.array([lo], pa.int64()),
                                pa.array([values.tolist()], pa.list_(pa.float64())),
                            ],
                            ["lag", "lo", "values"],
                        )

        log_z = [np.zeros(size) for _ in models]
        blocks = spark.range(-(-size // HISTORIES))
        for row in blocks.mapInArrow(normalise, "lag int, lo long, values array<double>").collect():
            log_z[row.lag][row.lo : row.lo + len(row["values"])] = row["values"]
        views = [m.views(m.numbers) for m in models]
        return cls([r @ c for r, c, _, _ in views], [q for _, _, q, _ in views], [b for *_, b in views], log_z, unigram, how.mix)

    def log10(self, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = self.mix[2] * self.unigram[classes]
        for lag, history in enumerate(histories(classes, starts)):
            for lo in range(0, len(classes), PART):
                h, w = history[lo : lo + PART], classes[lo : lo + PART]
                scores = (self.context[lag][h] * self.output[lag][w]).sum(1)
                out[lo : lo + PART] += self.mix[lag] * np.exp(
                    scores + self.bias[lag][w] - self.log_z[lag][h]
                )
        return np.log10(out)


def _score(shared):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("trained", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )

    def run(batches):
        model: MixedModel = shared.value
        for rows in batches:
            for doc_ids, flags, lengths, known, base, rare, data in zip(
                *(
                    rows.column(c).to_pylist()
                    for c in ("doc_ids", "flags", "lengths", "known", "base", "rare", "data")
                )
            ):
                classes = unpack_ints(data).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                scores = np.add.reduceat(model.log10(classes, starts), starts) + np.array(rare)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values, f.type)
                        for values, f in zip((doc_ids, flags, lengths, known, base, scores), schema)
                    ],
                    schema=schema,
                )

    return run


def score_texts(
    docs: DataFrame,
    trains: Column,
    how: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) for each row.

    ``trains`` says which rows the counts and the model are learnt from (null: not).  Tokens
    are the words and one end; scores are log10 probabilities of the whole text, ``base_score``
    by add-one unigram counts.  A null or empty text is its end alone.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_of(text_col).alias("text"),
        F.coalesce(trains, F.lit(False)).alias("flag"),
    )
    chunks = write_chunks(rows, split_words)
    flagged = F.filter(F.arrays_zip("flags", "lengths"), lambda d: d.flags)
    ends, words = (
        documents_of(chunks)
        .select(
            F.size(flagged).cast("long").alias("ends"),
            F.aggregate(flagged, F.lit(0).cast("long"), lambda sum_, d: sum_ + d.lengths).alias("words"),
        )
        .agg(F.coalesce(F.sum("ends"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)))
        .first()
    )
    counted = materialize(
        packets_of(chunks).groupBy("bucket").applyInArrow(_count_bucket(ends + words), COUNTED_DDL),
        "lm-counts",
    )
    corpus = gather_counts(counted, ends)
    packets = counted.where("kind = 'packet'").select("chunk", "bucket", "numbers", "counts", "tags")
    sequences = materialize(
        documents_of(chunks)
        .groupBy("chunk")
        .cogroup(packets.groupBy("chunk"))
        .applyInArrow(_classify_chunk(Shared(spark, corpus)), SEQUENCE_DDL),
        "lm-classes",
    )
    models = train(pair_counts(sequences), corpus, how)
    model = MixedModel.of(spark, models, unigram_of(corpus.totals), how)
    scored = sequences.where("block IS NULL").mapInArrow(
        _score(Shared(spark, model)),
        "doc_id long, trained boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))
