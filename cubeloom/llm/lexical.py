"""Ranked lexical search: term-at-a-time with a limited set of accumulators.

A scan task turns its documents into index blocks of about ``BLOCK_WORDS`` words: per block the
distinct terms, and for each its postings (document, occurrences).  Blocks are written once and
serve every set of queries.  A first pass over them counts, for the terms of the queries, in how
many documents each occurs; a second one scores.

In a block an item's terms come rarest first.  Each adds its share to the dense score array; a
document gets its accumulator when it is first touched.  As soon as the bounds of the terms to
come, summed, cannot lift an untouched document to the k-th best partial score, no accumulators
are created any more: the remaining terms update the survivors only, exactly.  A task carries the
best k of each item from block to block, so later blocks stop earlier, and tells Spark only its
final ones, which are merged per item.

Queries go to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cubeloom.llm.chunks import Numbers, pack_ints, pack_words, unpack_ints, unpack_words
from cubeloom.llm.common import Shared, keyed_texts, text_of, tidy
from cubeloom.llm.decontam import words_of
from cubeloom.session import materialize

BLOCK_WORDS = 1_000_000
QUERY_BYTES = 4 << 20  # of query texts that tasks work on at a time
LONGEST = np.iinfo(np.int64).max
# Fixed values of the score: a term's share is w * (UNIT * tf // (1000 * tf + 12 * m)) with
# m = 75 + 25 * n * N // L and w = floor(1000 * ln((2 N + 2) / (2 df + 1))).
UNIT, SCALE, LENGTH, FLAT, SLOPE = 1_000_000_000, 1_000, 12, 75, 25

# ------------------------------------------------------------------ index

INDEX = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("n_terms", pa.int64()),
        ("terms", pa.binary()),
        ("sizes", pa.binary()),
        ("docs", pa.binary()),
        ("counts", pa.binary()),
    ]
)
INDEX_DDL = (
    "doc_ids array<long>, lengths array<long>, n_terms long, terms binary, sizes binary, "
    "docs binary, counts binary"
)


def _index(block_words: int):
    def block(doc_ids: list, lengths: list, ids: Numbers, parts: list) -> pa.RecordBatch:
        term = np.concatenate(parts)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        # sorted by term, then document
        pair, counts = np.unique(term * len(lengths) + doc, return_counts=True)
        term, doc = np.divmod(pair, len(lengths))
        sizes = np.bincount(term, minlength=len(ids))
        row = {
            "doc_ids": doc_ids,
            "lengths": lengths,
            "n_terms": len(ids),
            "terms": pack_words(list(ids)),
            "sizes": pack_ints(sizes),
            "docs": pack_ints(doc),
            "counts": pack_ints(counts),
        }
        return pa.RecordBatch.from_pylist([row], schema=INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        doc_ids, lengths, ids, parts, size = [], [], Numbers(), [], 0
        for rows in batches:
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text")):
                words = words_of(text.as_buffer().to_pybytes())
                if not words:  # no score above zero
                    continue
                doc_ids.append(doc_id)
                lengths.append(len(words))
                parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size >= block_words:
                    yield block(doc_ids, lengths, ids, parts)
                    doc_ids, lengths, ids, parts, size = [], [], Numbers(), [], 0
        if parts:
            yield block(doc_ids, lengths, ids, parts)

    return run


def lexical_index(
    docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Index blocks of ``docs``, written once.  Texts without terms are in none."""
    own = keyed_texts(docs, id_col, text_col)
    return materialize(own.mapInArrow(_index(block_words), INDEX_DDL), "lexical-index")


# ------------------------------------------------------------------ queries


@dataclass(frozen=True)
class Queries:
    """A block of items: the terms of each with their repeats, and every term once."""

    ids: list[int]
    terms: list[dict[int, int]]
    vocabulary: list[bytes]

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Queries:
        numbers, terms = Numbers(), []
        for _, text in rows:
            own: dict[int, int] = {}
            for word in words_of(text):
                own[numbers[word]] = own.get(numbers[word], 0) + 1
            terms.append(own)
        return cls([i for i, _ in rows], terms, list(numbers))


def _document_counts(sent: Shared):
    """(term, documents) of the queries' terms, summed over the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        wanted = {w: i for i, w in enumerate(sent.value.vocabulary)}
        total = np.zeros(len(wanted), np.int64)
        for rows in batches:
            for n, terms, sizes in zip(*(rows.column(c).to_pylist() for c in ("n_terms", "terms", "sizes"))):
                for word, size in zip(unpack_words(terms, n), unpack_ints(sizes).tolist()):
                    if (at := wanted.get(word)) is not None:
                        total[at] += size
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Plan:
    """What a task needs to score: the queries, and weights and sizes of the whole corpus."""

    queries: Queries
    weights: list[int]
    order: list[list[int]]  # each item's terms that occur, rarest first
    n_docs: int
    n_words: int
    k: int


class Best:
    """The k best (score, doc_id) of an item so far; null ids come behind all others."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    @property
    def least(self) -> int:
        """What a score must at least equal to matter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, null = np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            held = np.flatnonzero(scores >= least)
            scores, ids, null = scores[held], ids[held], null[held]
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


class Block:
    """An index block's postings of the queries' terms, with their shares of the score."""

    def __init__(self, row: dict, plan: Plan):
        wanted = {w: i for i, w in enumerate(plan.queries.vocabulary)}
        self.null = np.array([d is None for d in row["doc_ids"]])
        self.ids = np.array([d or 0 for d in row["doc_ids"]], np.int64)
        lengths = np.array(row["lengths"], np.int64)
        reach = SLOPE * int(lengths.max(initial=0)) * plan.n_docs
        lengths = lengths if reach <= LONGEST else lengths.astype(object)
        middle = FLAT + ((SLOPE * lengths * plan.n_docs) // plan.n_words).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum(unpack_ints(row["sizes"]).astype(np.int64))])
        docs, counts = unpack_ints(row["docs"]), unpack_ints(row["counts"])
        self.docs: dict[int, np.ndarray] = {}
        self.shares: dict[int, np.ndarray] = {}
        self.bounds: dict[int, int] = {}
        for place, word in enumerate(unpack_words(row["terms"], row["n_terms"])):
            if (term := wanted.get(word)) is not None and plan.weights[term] > 0:
                own = docs[cut[place] : cut[place + 1]].astype(np.int64)
                tf = counts[cut[place] : cut[place + 1]].astype(np.int64)
                share = plan.weights[term] * (UNIT * tf // (SCALE * tf + LENGTH * middle[own]))
                self.docs[term], self.shares[term], self.bounds[term] = own, share, int(share.max())

    def score(self, order: list[int], repeats: dict[int, int], best: Best) -> int:
        """Adds the block's documents to ``best``; returns how many accumulators were made."""
        terms = [t for t in order if t in self.docs]
        rest = sum(self.bounds[t] * repeats[t] for t in terms)
        scores, touched = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        made, creates, least = 0, True, best.least
        for term in terms:
            # an untouched document can reach ``rest`` at most; equal scores may win by doc_id
            if creates and rest < least:
                creates = False
            docs, share = self.docs[term], self.shares[term] * repeats[term]
            if not creates:
                held = touched[docs]
                docs, share = docs[held], share[held]
            scores[docs] += share  # a document is once in a list
            if creates:
                made += int(np.count_nonzero(~touched[docs]))
                touched[docs] = True
                if made >= best.k:
                    # partial scores only grow, so the k-th of them bounds the k-th score
                    least = max(least, int(np.partition(scores, len(scores) - best.k)[len(scores) - best.k]))
            rest -= self.bounds[term] * repeats[term]
        held = np.flatnonzero(scores >= max(least, 1))
        best.add(scores[held], self.ids[held], self.null[held])
        return made


SCORED = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _score(sent: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        plan: Plan = sent.value
        best = [Best(plan.k) for _ in plan.queries.ids]
        for rows in batches:
            for row in range(rows.num_rows):
                block = Block(rows.slice(row, 1).to_pylist()[0], plan)
                for order, repeats, own in zip(plan.order, plan.queries.terms, best):
                    block.score(order, repeats, own)
        items = [pa.array(np.full(len(b.ids), i)) for i, b in zip(plan.queries.ids, best)]
        if items:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(items),
                    pa.concat_arrays([pa.array(b.ids, mask=b.null) for b in best]),
                    pa.concat_arrays([pa.array(b.scores) for b in best]),
                ],
                schema=SCORED,
            )

    return run


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 20,
    query_bytes: int = QUERY_BYTES,
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, scores above 0.

    ``index`` is what :func:`lexical_index` gives.  Equal scores go by doc_id, null last; rows
    that repeat a doc_id are documents each.  Null and empty items, items without an id and
    those whose terms occur nowhere have no rows.  Of items that share an id, the text that
    comes first in order counts.
    """
    spark = index.sparkSession
    texts = (
        queries.select(F.col(item_col).cast("long").alias("item_id"), text_of(text_col).alias("text"))
        .where("item_id IS NOT NULL")
        .groupBy("item_id")
        .agg(F.min("text").alias("text"))
    )
    totals = index.agg(
        F.coalesce(F.sum(F.size("lengths")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0)),
    ).first()
    blocks = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // query_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = None
    for number in range(blocks):
        # about query_bytes, one item at least
        rows = texts.where(block == number).orderBy("item_id").collect()
        own = Queries.of([(r.item_id, r.text.encode()) for r in rows])
        df = [0] * len(own.vocabulary)
        counted = index.mapInArrow(_document_counts(Shared(spark, own)), "term long, df long")
        for term, count in counted.groupBy("term").agg(F.sum("df")).collect():  # one row per query term
            df[term] = count
        order = [sorted((t for t in terms if df[t]), key=lambda t: (df[t], t)) for terms in own.terms]
        weights = [term_weight(totals[0], d) if d else 0 for d in df]
        plan = Plan(own, weights, order, totals[0], totals[1], k)
        scored = index.mapInArrow(_score(Shared(spark, plan)), "item_id long, doc_id long, score long")
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            ranked = materialize(ranked, "lexical-ranked")
        found = ranked if found is None else found.unionByName(ranked)
    return found
