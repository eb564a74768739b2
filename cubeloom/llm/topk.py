"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Components are quantised to integers; a dimension is a term, and its postings are the
candidates with a non-zero weight in it.  Queries and candidates are cut into blocks of fixed
size and every query block meets every candidate block in one task: for each query, the terms
of its sparse row scatter their weighted postings into a dense array with one score for each
candidate of the block, a partition selection keeps the k best, and the blocks' winners are
merged per query.  A cell's memory depends on the block sizes only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 256
QUERY_BLOCK = 2_048
CANDIDATE_BLOCK = 16_384
WHOLE = float(1 << 53)  # doubles from here on are integers
PLAIN = 1 << 24  # rows with a larger component are scored apart, in wide integers if need be


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, weights): floor(SCALE * x) / SCALE of every component, x as double.

    These are doubles without loss: a component beyond 2**53 is an integer as it is.  Vectors
    that are null or hold a null or non-finite component take no part, nor do rows without an
    id.  An empty vector takes part; all its products are 0.
    """

    def weight(x: Column) -> Column:
        own = x.cast("double")
        return F.when(F.abs(own) >= WHOLE, own).otherwise(F.floor(own * SCALE) / F.lit(float(SCALE)))

    def finite(x: Column) -> Column:
        own = x.cast("double")
        return F.coalesce(~F.isnan(own) & (F.abs(own) < float("inf")), F.lit(False))

    sound = F.col(vector_col).isNotNull() & F.forall(F.col(vector_col), finite)
    return vectors.where(F.col(id_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vector_col), weight).alias("weights")
    )


def _sparse(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, and (row, term, weight) of the non-zero components, from (cell, id, weights)."""
    rows = rows.combine_chunks()
    ids = rows.column(1).to_numpy()
    lists = rows.column(2).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    lengths = np.diff(lists.offsets.to_numpy())
    weights = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(ids)), lengths)
    term = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    held = weights != 0
    return ids, row[held], term[held], weights[held]


def _integers(weights: np.ndarray, plain: bool) -> np.ndarray:
    """SCALE times the weights; as Python's integers, which have no bound, unless all are plain."""
    if plain:
        return (weights * SCALE).astype(np.int64)
    out = np.empty(len(weights), object)
    out[:] = [int(w) * SCALE if abs(w) >= WHOLE else int(w * SCALE) for w in weights.tolist()]
    return out


def _parts(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As :func:`_sparse` in integers, rows with a component beyond ``PLAIN`` apart from the others."""
    ids, row, term, weight = _sparse(rows)
    wide = np.zeros(len(ids), bool)
    wide[row[np.abs(weight) > PLAIN / SCALE]] = True
    parts = []
    for own, plain in ((~wide, True), (wide, False)):
        if own.any():
            held = own[row]
            parts.append(
                (ids[own], (np.cumsum(own) - 1)[row[held]], term[held], _integers(weight[held], plain))
            )
    return parts


def _largest(weight: np.ndarray) -> int:
    return max(int(weight.max()), -int(weight.min())) if len(weight) else 0


def _postings(sparse) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    ids, row, term, weight = sparse
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    terms, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    return ids, {
        int(t): (row[a:b], weight[a:b]) for t, a, b in zip(terms, starts, ends)
    }


def _score_cell(k: int):
    schema = pa.schema(
        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.string())]
    )

    def score(queries, candidates) -> pa.Table:
        query_ids, row, term, weight = queries
        terms = min((int(x[2].max(initial=0)) + 1 for x in (queries, candidates)))
        bounds = _largest(weight), _largest(candidates[3])
        exact = max(*bounds, bounds[0] * bounds[1] * terms) < 1 << 63
        kind = np.int64 if exact else object
        weight = weight.astype(kind)
        ids, postings = _postings((*candidates[:3], candidates[3].astype(kind)))
        starts = np.searchsorted(row, np.arange(len(query_ids) + 1))
        scores = np.zeros(len(ids), kind)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, query_id in enumerate(query_ids):
            scores[:] = 0
            for at in range(starts[q], starts[q + 1]):
                if (list_ := postings.get(int(term[at]))) is not None:
                    # a candidate is once in a list, so a plain indexed add is a scatter
                    scores[list_[0]] += weight[at] * list_[1]
            open_ = np.flatnonzero(ids != query_id)
            if len(open_) > k:
                own = scores[open_]
                least = (np.partition(own, len(own) - k) if exact else np.sort(own))[len(own) - k]
                open_ = open_[own >= least]
                # the least score may be shared by many: the smaller ids win
                open_ = open_[np.argsort(ids[open_], kind="stable")]
                open_ = open_[np.argsort(-scores[open_], kind="stable")[:k]]
            found.append((np.full(len(open_), query_id), ids[open_], scores[open_]))
        ids, partners, scores = (np.concatenate([f[i] for f in found]).tolist() for i in range(3))
        inside = [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in scores]
        beyond = [None if x == y else str(x) for x, y in zip(scores, inside)]
        return pa.table(dict(zip(schema.names, (ids, partners, inside, beyond))), schema=schema)

    def run(queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        own = _parts(candidates)
        return pa.concat_tables([score(q, c) for q in _parts(queries) for c in own])

    return run


def exact_top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score, score_wide): the k largest inner products of each query.

    Both inputs are (vec_id, weights) as :func:`quantised` gives them.  A query is no
    candidate of its own; ties go to the smaller vec_id; fewer than k candidates give fewer
    rows.  Vectors of different lengths meet in the terms that both have.  Rows that repeat a
    vec_id are candidates each, and as queries they are answered once, by the first of them in
    the order of the weights.  ``score_wide`` has the digits of the score; ``score`` is null
    if they are beyond 64 bits, and the rank is exact all the same.
    """
    once = queries.groupBy("vec_id").agg(F.min("weights").alias("weights"))
    n_queries, n_candidates = once.count(), candidates.count()
    q_blocks = max(1, -(-n_queries // query_block))
    c_blocks = max(1, -(-n_candidates // candidate_block))

    def block(df: DataFrame, blocks: int) -> DataFrame:
        return df.withColumn("_block", F.pmod(F.xxhash64("vec_id", "weights"), F.lit(blocks).cast("long")))

    own = F.col("_block")
    row = F.sequence(own * c_blocks, own * c_blocks + (c_blocks - 1))
    left = block(once, q_blocks).select(F.explode(row).alias("cell"), "vec_id", "weights")
    column = F.sequence(own, own + (q_blocks - 1) * c_blocks, F.lit(c_blocks).cast("long"))
    # names of their own: both sides may come from one table, and a cogroup mixes up columns that they share
    right = block(candidates, c_blocks).select(
        F.explode(column).alias("cell"), F.col("vec_id").alias("own_id"), F.col("weights").alias("own_weights")
    )
    scored = (
        left.groupBy("cell")
        .cogroup(right.groupBy("cell"))
        .applyInArrow(_score_cell(k), "query_id long, vec_id long, score long, beyond string")
    )
    # beyond 64 bits the clipped score ties, and sign, number of digits and digits decide
    below = F.col("beyond").startswith("-")
    size = F.when(below, -F.length("beyond")).otherwise(F.length("beyond"))
    sign = F.when(F.col("beyond").isNull(), 0).when(below, -1).otherwise(1)
    best = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(),
        sign.desc(),
        size.desc(),
        F.when(~below, F.col("beyond")).desc(),
        F.when(below, F.col("beyond")).asc(),
        "vec_id",
    )
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(
            "query_id",
            "rank",
            "vec_id",
            F.when(F.col("beyond").isNull(), F.col("score")).alias("score"),
            F.coalesce("beyond", F.col("score").cast("string")).alias("score_wide"),
        )
    )
