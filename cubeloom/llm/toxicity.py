"""Toxicity scores: gradient-boosted trees over dense features, calibrated isotonically.

The lexicon is fixed insults plus words and word beginnings that Spark counts as telling in
labelled training texts.  Each text becomes a short row of densities (lexicon hits, hits near a
second person, capitals, punctuation, obfuscation); trees are fitted to a bounded sample of
labelled rows on the driver, with lexicon features of rows that did not make the lexicon (three
folds), and the trees' margins of rows they were not fitted to calibrate the score.  Scoring is
one pass over the whole texts, with a model of a few hundred kilobytes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import Shared, keyed_texts, text_of, tidy
from cubeloom.session import materialize

# Common insults and forms of address in the languages of the texts.
INSULTS = (
    "idiot", "idiots", "moron", "moronic", "stupid", "dumb", "loser", "losers", "pathetic",
    "worthless", "scum", "trash", "garbage", "clown", "disgusting", "imbecile", "fool", "jerk",
    "vermin", "filthy", "bastard", "dummkopf", "trottel", "abschaum", "widerlich", "wertlos",
    "crétin", "imbécile", "ordure", "minable", "nul", "idiota", "estúpido", "imbécil", "basura",
    "asqueroso", "patético",
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes "
    "vous votre vos usted ustedes tú ti vosotros".split()
)
MARKS = ".,;:!?\"'()[]{}<>|*%$#&@~^_+=/\\-–—…«»¿¡“”„’‘"
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
PREFIXES = (4, 5, 6)
FEATURES = (
    "log_words", "insult_density", "insults", "lexicon_density", "lexicon_sum", "lexicon_max",
    "lexicon_kinds", "top_share", "near_second_person", "second_person", "capitals",
    "capital_words", "exclamations", "questions", "punctuation", "obfuscated", "obfuscated_hits",
    "drawn_out", "digits", "mean_length",
)


@dataclass(frozen=True)
class ToxicityPlan:
    sample: int = 20_000  # labelled rows that the lexicon and the trees are fitted to, at most
    lexicon_size: int = 2_000  # learnt entries, at most
    min_rows: int = 4  # toxic texts that hold an entry
    min_gain: float = 18.0  # log-likelihood ratio of an entry
    folds: int = 3
    trees: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 32
    leaf_rows: int = 5
    seed: int = 11


@dataclass(frozen=True)
class Lexicon:
    """Weights (log odds) of whole words and of word beginnings."""

    words: dict[str, float]
    beginnings: dict[str, float]
    heads: frozenset[str] = field(default_factory=frozenset)  # first four letters of all entries

    @classmethod
    def of(cls, entries: dict[str, float]) -> Lexicon:
        words = {e[1:]: w for e, w in entries.items() if e[0] == "="}
        beginnings = {e[1:]: w for e, w in entries.items() if e[0] == "^"}
        for word in INSULTS:
            words.setdefault(word, 3.0)
        heads = frozenset(e[:4] for e in (*words, *beginnings))
        return cls(words, beginnings, heads)

    def weight(self, word: str) -> float:
        if word[:4] not in self.heads:
            return 0.0
        best = self.words.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n and (own := self.beginnings.get(word[:n], 0.0)) > best:
                best = own
        return best


def bare_words(text: str) -> list[str]:
    return [w.strip(MARKS) for w in text.lower().split()]


def entries_of(text: str) -> set[str]:
    """Whole words, and beginnings of longer words, that a lexicon may hold."""
    out = set()
    for word in set(bare_words(text)):
        if len(word) >= 3 and word.isalpha():
            out.add("=" + word)
            out.update("^" + word[:n] for n in PREFIXES if len(word) > n)
    return out


DRAWN = re.compile(r"([^\W\d_])\1\1")


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = bare_words(text)
    n = len(words) or 1
    chars = len(text) or 1
    heads = lexicon.heads
    hits, weights, you, odd, odd_hits = [], [], [], 0, 0
    insults = 0
    fixed = INSULT_SET
    for i, word in enumerate(words):
        if word[:4] in heads:
            if (w := lexicon.weight(word)) > 0:
                hits.append(i)
                weights.append(w)
                insults += word in fixed
        if word in SECOND_PERSON:
            you.append(i)
        elif not word.isalpha() and word and not word.isdigit():
            odd += 1
            plain = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
            if plain != word and (w := lexicon.weight(plain)) > 0 and not lexicon.weight(word):
                odd_hits += 1
                hits.append(i)
                weights.append(w)
    near = 0
    if hits and you:
        places = np.array(you)
        at = np.searchsorted(places, hits)
        before = np.abs(places[np.maximum(at - 1, 0)] - hits)
        after = np.abs(places[np.minimum(at, len(you) - 1)] - hits)
        near = int((np.minimum(before, after) <= 4).sum())
    kinds = Counter(words[i] for i in hits)
    capitals = sum(map(text.count, CAPITALS)) if text.isascii() else sum(map(str.isupper, text))
    marks = sum(map(text.count, PLAIN_MARKS))
    return [
        math.log1p(len(words)),
        insults / n,
        math.log1p(insults),
        len(hits) / n,
        math.log1p(sum(weights)),
        max(weights, default=0.0),
        math.log1p(len(kinds)),
        max(kinds.values(), default=0) / max(1, len(hits)),
        near / n,
        len(you) / n,
        capitals / chars,
        sum(map(str.isupper, text.split())) / n if capitals > 3 else 0.0,
        text.count("!") / n,
        text.count("?") / n,
        marks / chars,
        odd / n,
        odd_hits / n,
        len(DRAWN.findall(text)) / n,
        sum(map(text.count, "0123456789")) / chars,
        chars / n,
    ]


INSULT_SET = frozenset(INSULTS)
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PLAIN_MARKS = ".,;:!?*%$#&@|"


# ------------------------------------------------------------------ lexicon


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tidy()
    counts: Counter = Counter()

    def emit() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in counts], pa.string()),
                pa.array([k[1] for k in counts], pa.int32()),
                pa.array([k[2] for k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["entry", "fold", "label", "n"],
        )
        counts.clear()
        return made

    for rows in batches:
        for text, fold, label in zip(
            *(rows.column(c).to_pylist() for c in ("text", "fold", "label"))
        ):
            counts.update((e, fold, label) for e in entries_of(text))
            if len(counts) > 500_000:
                yield emit()
    if counts:
        yield emit()


def _gain(pos: Column, neg: Column, n_pos: float, n_neg: float) -> Column:
    """Log-likelihood ratio of an entry's share of toxic texts against the overall share."""
    share = n_pos / (n_pos + n_neg)
    own = pos / (pos + neg)

    def part(count: Column, at: Column, overall: float) -> Column:
        return F.when(count > 0, count * F.log(at / overall)).otherwise(0.0)

    gain = 2 * (part(pos, own, share) + part(neg, 1 - own, 1 - share))
    return F.when(own > share, gain).otherwise(0.0)


def learn_lexicons(sample: DataFrame, sizes: dict[tuple[int, int], int], plan: ToxicityPlan) -> list[Lexicon]:
    """One lexicon without each fold, then the one of all folds."""
    counted = (
        sample.select("text", "fold", "label")
        .mapInArrow(_count_entries, "entry string, fold int, label int, n long")
        .groupBy("entry")
        .agg(
            *[
                F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"c{f}_{y}")
                for f in range(plan.folds)
                for y in (0, 1)
            ]
        )
    )
    held = [set(range(plan.folds)) - {f} for f in range(plan.folds)] + [set(range(plan.folds))]
    gains, odds = [], []
    for own in held:
        n = {y: max(1.0, float(sum(sizes.get((f, y), 0) for f in own))) for y in (0, 1)}
        pos, neg = (sum((F.col(f"c{f}_{y}") for f in own), F.lit(0.0)) for y in (1, 0))
        fits = pos >= plan.min_rows
        gains.append(F.when(fits, _gain(pos, neg, n[1], n[0])).otherwise(0.0))
        odds.append(F.log((pos + 0.5) / (n[1] + 1)) - F.log((neg + 0.5) / (n[0] + 1)))
    named = counted.where(
        sum((F.col(f"c{f}_1") for f in range(plan.folds)), F.lit(0)) >= plan.min_rows
    ).select(
        "entry",
        *[g.alias(f"gain{i}") for i, g in enumerate(gains)],
        *[o.alias(f"odds{i}") for i, o in enumerate(odds)],
    )
    named = named.withColumn("best", F.greatest(*[F.col(f"gain{i}") for i in range(len(held))]))
    rows = (
        named.where(F.col("best") >= plan.min_gain)
        .orderBy(F.col("best").desc(), "entry")
        .limit(plan.lexicon_size)
        .collect()
    )
    return [
        Lexicon.of({r.entry: r[f"odds{i}"] for r in rows if r[f"gain{i}"] >= plan.min_gain})
        for i in range(len(held))
    ]


# ------------------------------------------------------------------ trees and calibration


@dataclass(frozen=True)
class Trees:
    """Trees of one depth: for each, features and thresholds by node, and leaf values."""

    start: float
    nodes: np.ndarray  # (trees, inner nodes): feature
    cuts: np.ndarray  # (trees, inner nodes): goes right if above
    leaves: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.nodes.shape[1]
        for nodes, cuts, leaves in zip(self.nodes, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            while inner and at[0] < inner:
                at = 2 * at + 1 + (x[rows, nodes[at]] > cuts[at])
            out += leaves[at - inner]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, plan: ToxicityPlan) -> Trees:
    """Second-order boosting of the logistic loss on binned features."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, plan.bins + 1)[1:-1])) for j in range(m)]
    edges = [e if len(e) else np.zeros(1) for e in edges]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    width = plan.bins
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    inner = (1 << plan.depth) - 1
    trees: list[tuple] = []
    for _ in range(plan.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p) + 1e-6
        at = np.zeros(n, np.int64)
        nodes, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(plan.depth):
            first = (1 << level) - 1
            for node in range(first, 2 * first + 1):
                rows = np.flatnonzero(at == node)
                best = (1e-6, 0, np.inf)
                if len(rows) >= 2 * plan.leaf_rows:
                    total_g, total_h = g[rows].sum(), h[rows].sum()
                    for j in range(m):
                        b = binned[rows, j]
                        left_g = np.cumsum(np.bincount(b, g[rows], width))[: len(edges[j])]
                        left_h = np.cumsum(np.bincount(b, h[rows], width))[: len(edges[j])]
                        left_n = np.cumsum(np.bincount(b, minlength=width))[: len(edges[j])]
                        gain = (
                            left_g**2 / (left_h + 1)
                            + (total_g - left_g) ** 2 / (total_h - left_h + 1)
                            - total_g**2 / (total_h + 1)
                        )
                        gain[(left_n < plan.leaf_rows) | (len(rows) - left_n < plan.leaf_rows)] = 0
                        k = int(np.argmax(gain))
                        if gain[k] > best[0]:
                            best = (gain[k], j, edges[j][k])
                nodes[node], cuts[node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
        leaf = at - inner
        sums_g = np.bincount(leaf, g, inner + 1)
        sums_h = np.bincount(leaf, h, inner + 1)
        values = plan.rate * sums_g / (sums_h + 1)
        margin += values[leaf]
        trees.append((nodes, cuts, values))
    return Trees(start, *(np.stack([t[i] for t in trees]) for i in range(3)))


def isotonic(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: margins and the shares of label 1 at them, both rising."""
    order = np.argsort(margins, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first margin, last margin
    for m, value in zip(margins[order], y[order]):
        blocks.append([float(value), 1.0, float(m), float(m)])
        while len(blocks) > 1 and (
            blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]
            or blocks[-2][3] == blocks[-1][2]
        ):
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    xs, ys = [], []
    for s, w, first, last in blocks:
        # one row of each label beside the block keeps small blocks off 0 and 1
        value = (s + 0.5) / (w + 1)
        xs += [first, last]
        ys += [value, value]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(x), *self.knots)


def train(docs: DataFrame, labels: DataFrame, trains: Column, plan: ToxicityPlan) -> ToxicityModel | float:
    """The model from labelled training rows; without both labels, only a constant score.

    ``docs`` (doc_id, text), ``labels`` (doc_id, label).  At most about ``plan.sample`` rows
    are taken, by a hash of the doc_id, so the driver sees bounded data.
    """
    marked = (
        labels.where(F.col("label").isin(0, 1) & trains)
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    n = marked.count()
    if not n:
        return 0.5
    draw = F.pmod(F.xxhash64("doc_id", F.lit(plan.seed)), F.lit(1 << 30))
    share = min(1.0, plan.sample / n)
    picked = marked.where(draw < int(share * (1 << 30))).withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", F.lit(plan.seed + 1)), F.lit(plan.folds)).cast("int")
    )
    # plan.sample bounds what is broadcast and what is written: rows are picked in the scan
    sample = materialize(
        docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "fold", "label"),
        "toxicity-sample",
    )
    sizes = {
        (r.fold, r.label): r["count"] for r in picked.groupBy("fold", "label").count().collect()
    }
    if any(not sum(sizes.get((f, y), 0) for f in range(plan.folds)) for y in (0, 1)):
        total = sum(sizes.values())
        return (sum(v for (_, y), v in sizes.items() if y) + 0.5) / (total + 1)
    lexicons = learn_lexicons(sample, sizes, plan)
    shared = Shared(docs.sparkSession, lexicons)
    width = len(FEATURES)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            folds = rows.column("fold").to_pylist()
            texts = rows.column("text").to_pylist()
            x = [features(t, shared.value[f]) for t, f in zip(texts, folds)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("fold"),
                    rows.column("label"),
                    pa.array(x, pa.list_(pa.float64())),
                ],
                ["doc_id", "fold", "label", "x"],
            )

    # bounded by plan.sample rows of numbers
    rows = (
        sample.mapInArrow(dense, "doc_id long, fold int, label int, x array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, width)
    y = rows.column("label").to_numpy().astype(np.float64)
    fold = rows.column("fold").to_numpy()
    margins = np.zeros(len(y))
    for f in range(plan.folds):
        own = fold == f
        if own.any() and len(set(y[~own])) == 2:
            margins[own] = fit_trees(x[~own], y[~own], plan).margin(x[own])
    return ToxicityModel(lexicons[-1], fit_trees(x, y, plan), isotonic(margins, y))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    trains: Column | None = None,
    plan: ToxicityPlan = ToxicityPlan(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.7,
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) added.

    Learnt from rows of ``labels`` for which ``trains`` (an expression over doc_id) holds;
    labels of a doc_id that is labelled twice count as toxic if one of them is; labels other
    than 0 and 1 are ignored.  Null and empty texts are scored like any other.  Without labels
    of both kinds every text gets the same score.  Columns named ``score`` or ``predicted`` are
    replaced, all others are passed on.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    model = train(
        keyed_texts(docs, id_col, text_col), known, F.lit(True) if trains is None else trains, plan
    )
    shared = Shared(docs.sparkSession, model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        tidy()
        model = shared.value
        if isinstance(model, float):
            return pd.Series(np.full(len(texts), model))
        x = np.array([features(t, model.lexicon) for t in texts], np.float64)
        return pd.Series(model.score(x.reshape(-1, len(FEATURES))))

    plain = docs.drop("score", "predicted")
    return plain.withColumn("score", scored(text_of(text_col))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
