"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

The state has three tables in the shared folder:

* ``postings``: which document holds which line key (each key once per doc_id);
* ``refs``: for each key, how many documents hold it and the largest doc_id of them;
* ``filters``: for each shard of the key space, a cuckoo filter of the *frequent* keys,
  those held by at least ``min_docs`` documents; the number of shards follows their count.

``insert`` and ``delete`` change postings and counts exactly and move into or out of the
filters only the keys that cross the threshold, so deleting what was inserted gives the
state back.  ``drop_lines`` probes the filters first: eligible lines and filters meet by shard,
and a shard with many lines (one line may fill the corpus) is cut into parts that each get its
filter.  A line that its filter does not know is surely not frequent and goes no further.  The
rest is decided by a join with the exact table, so a false positive of a filter costs a row in
a shuffle and never a wrong result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm.common import keyed_texts, tidy
from cubeloom.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
SHARDS = 16  # at least
SHARD_KEYS = 1 << 18  # frequent keys of a shard when filters are built, half of what it may get
PART_LINES = 1 << 20  # of a shard that meet its filter in one task
SLOTS = 4
LOAD = 0.5  # of a new filter, so that it takes as many keys again


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key has two buckets.  Supports deletion."""

    KICKS = 500

    def __init__(self, cells: np.ndarray):
        self.cells = cells  # (buckets, SLOTS), 0 is free
        self.mask = np.uint64(len(cells) - 1)

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = hashes & self.mask
        return prints, first.astype(np.int64), self._other(first, prints).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        step = prints.astype(np.uint64) * np.uint64(0x5BD1E995)
        return (bucket.astype(np.uint64) ^ step) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        own = prints[:, None]
        return (self.cells[first] == own).any(1) | (self.cells[second] == own).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if the filter is too full; it must then be built anew."""
        prints, first, second = self._places(hashes)
        left = np.arange(len(hashes))
        for bucket in (first, second):
            order = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            free = (self.cells == 0)[at]
            fits = rank < free.sum(1)
            # the rank-th free slot of the bucket
            slot = np.argmax(np.cumsum(free, 1) > rank[:, None], 1)
            self.cells[at[fits], slot[fits]] = prints[order[fits]]
            left = order[~fits]
        return all(self._evict(int(second[i]), int(prints[i])) for i in left)

    def _evict(self, bucket: int, print_: int) -> bool:
        for kick in range(self.KICKS):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = print_
                return True
            slot = kick % SLOTS
            print_, self.cells[bucket, slot] = int(self.cells[bucket, slot]), print_
            bucket = int(
                self._other(np.array([bucket]), np.array([print_], dtype=np.uint16))[0]
            )
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Only for keys that were inserted."""
        for print_, first, second in zip(*self._places(hashes)):
            for bucket in (first, second):
                slots = np.flatnonzero(self.cells[bucket] == print_)
                if len(slots):
                    self.cells[bucket, slots[0]] = 0
                    break


def key_hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8")[::2].copy()


def shard_of(key: Column, shards: int) -> Column:
    """By the last four bytes of the digest."""
    return (F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long") % shards).cast("int")


def shards_for(frequent: int) -> int:
    """A power of two."""
    return max(SHARDS, 1 << max(0, -(-frequent // SHARD_KEYS) - 1).bit_length())


# ------------------------------------------------------------------ lines of documents


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(position, digest) of the lines whose key has enough code points."""
    for position, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) < min_chars:
            continue
        if len(key) < 4 * min_chars and not key.isascii():
            if len(key.decode("utf-8", "replace")) < min_chars:
                continue
        yield position, hashlib.blake2b(key, digest_size=16).digest()


def _texts(rows: pa.RecordBatch) -> Iterator[bytes]:
    for text in rows.column("text"):
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def _postings(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            keys, owners = [], []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), _texts(rows)):
                own = {digest for _, digest in line_keys(text, min_chars)}
                keys.extend(own)
                owners.extend([doc_id] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], ["key", "doc_id"]
            )

    return run


def _eligible(min_chars: int):
    """Every line whose key has enough code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            row_keys, owners, places, keys = [], [], [], []
            for row_key, doc_id, text in zip(
                rows.column("row_key").to_pylist(), rows.column("doc_id").to_pylist(), _texts(rows)
            ):
                for position, digest in line_keys(text, min_chars):
                    row_keys.append(row_key)
                    owners.append(doc_id)
                    places.append(position)
                    keys.append(digest)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row_keys, pa.int64()),
                    pa.array(owners, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.array(keys, pa.binary()),
                ],
                ["row_key", "doc_id", "position", "key"],
            )

    return run


LINES_DDL = "row_key long, doc_id long, position int, key binary"


def _probe_part(key, lines: pa.Table, filters: pa.Table) -> pa.Table:
    """Lines of a part of a shard that its filter knows."""
    tidy()
    names = ["row_key", "doc_id", "position", "key"]
    lines = lines.select(names)
    if not filters.num_rows or not lines.num_rows:
        return lines.slice(0, 0)
    one = CuckooFilter.from_bytes(filters.column("own_cells")[0].as_py())
    return lines.filter(pa.array(one.contains(key_hashes(lines.column("key").to_pylist()))))


def _probe_by_shard(lines: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Lines that may be frequent, found where the filter of their shard is."""
    lines = materialize(lines.withColumn("shard", shard_of(F.col("key"), shards)), "line-eligible")
    # one row for each shard
    parts = lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART_LINES).alias("parts"))
    dealt = lines.join(parts, "shard").withColumn(
        "part", F.pmod(F.xxhash64("row_key", "position", "doc_id"), F.col("parts"))
    )
    own = filters.join(parts, "shard").select(
        F.col("shard").alias("own_shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("own_part"),
        F.col("cells").alias("own_cells"),
    )
    return (
        dealt.drop("parts")
        .groupBy("shard", "part")
        .cogroup(own.groupBy("own_shard", "own_part"))
        .applyInArrow(_probe_part, LINES_DDL)
    )


# ------------------------------------------------------------------ state


@dataclass(frozen=True)
class LineState:
    """An immutable version of the three tables; a change gives a new version."""

    postings: DataFrame  # key, doc_id
    refs: DataFrame  # key, refs, keep_doc
    filters: DataFrame  # shard, shards (of the whole key space), cells
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    def save(self, path: str) -> None:
        for name in ("postings", "refs", "filters"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, **settings: int) -> LineState:
        read = spark.read.parquet
        return cls(*(read(f"{path}/{n}") for n in ("postings", "refs", "filters")), **settings)


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("refs"), F.max("doc_id").alias("keep_doc")
    )


FILTERS_DDL = "shard int, shards int, cells binary"


def _filter_row(shard: int, shards: int, cells: bytes | None) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([shard], pa.int32()),
            "shards": pa.array([shards], pa.int32()),
            "cells": pa.array([cells], pa.binary()),
        }
    )


def _shards(filters: DataFrame) -> int:
    return filters.agg(F.max("shards")).first()[0] or SHARDS


def _build_filters(refs: DataFrame, min_docs: int) -> DataFrame:
    frequent = refs.where(F.col("refs") >= min_docs)
    shards = shards_for(frequent.count())

    def build(key, rows):
        tidy()
        hashes = key_hashes(rows.column("key").to_pylist())
        size = len(hashes)
        while True:
            one = CuckooFilter.sized_for(size)
            if one.insert(hashes):
                break
            size *= 2
        return _filter_row(key[0].as_py(), shards, one.to_bytes())

    built = (
        frequent.select("key", shard_of(F.col("key"), shards).alias("shard"))
        .groupBy("shard")
        .applyInArrow(build, FILTERS_DDL)
    )
    return materialize(built, "line-filters")


def _move_keys(filters: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame | None:
    """Filters after keys came and went; None if one is too full, also if for want of shards."""
    shards = _shards(filters)
    moves = added.select("key", F.lit(True).alias("comes")).unionByName(
        removed.select("key", F.lit(False).alias("comes"))
    )
    moves = moves.withColumn("shard", shard_of(F.col("key"), shards))
    if added.count() > shards * SHARD_KEYS:
        return None
    most = CuckooFilter.sized_for(2 * SHARD_KEYS).cells.size

    def change(key, old, rows):
        shard = key[0].as_py()
        comes = np.array(rows.column("comes").to_pylist(), bool)
        hashes = key_hashes(rows.column("key").to_pylist())
        if old.num_rows:
            one = CuckooFilter.from_bytes(old.column("cells")[0].as_py())
        else:
            one = CuckooFilter.sized_for(int(comes.sum()))
        one.delete(hashes[~comes])
        fits = one.insert(hashes[comes]) and one.cells.size <= most
        return _filter_row(shard, shards, one.to_bytes() if fits else None)

    changed = (
        filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInArrow(change, FILTERS_DDL)
    )
    changed = materialize(changed, "line-filters")
    return None if changed.where(F.col("cells").isNull()).take(1) else changed


def empty_state(spark: SparkSession, **settings: int) -> LineState:
    return LineState(
        spark.createDataFrame([], "key binary, doc_id long"),
        spark.createDataFrame([], "key binary, refs long, keep_doc long"),
        spark.createDataFrame([], FILTERS_DDL),
        **settings,
    )


def insert(
    state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> LineState:
    """The state with the lines of ``docs`` added.

    Rows of one doc_id are one document, in one call or in several: a key is counted once for
    each doc_id that holds it.  Rows without a doc_id are no documents and count for no key.
    """
    found = (
        keyed_texts(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
        .mapInArrow(_postings(state.min_chars), "key binary, doc_id long")
        .distinct()  # by key and document, so a key that fills the corpus spreads over all tasks
    )
    first = state.refs.isEmpty()
    if not first:
        found = found.join(state.postings, ["key", "doc_id"], "left_anti")
    fresh = materialize(found, "line-postings")
    came = _counted(fresh)
    if first:
        refs = materialize(came, "line-refs")
        return LineState(
            fresh, refs, _build_filters(refs, state.min_docs), state.min_docs, state.min_chars
        )
    new = came.select("key", F.col("refs").alias("more"), F.col("keep_doc").alias("new_doc"))
    old_refs, more = (F.coalesce(c, F.lit(0)) for c in ("refs", "more"))
    joined = materialize(
        state.refs.join(new, "key", "full").select(
            "key",
            (old_refs + more).alias("refs"),
            F.greatest("keep_doc", "new_doc").alias("keep_doc"),
            ((old_refs < state.min_docs) & (old_refs + more >= state.min_docs)).alias("rises"),
        ),
        "line-refs",
    )
    refs = joined.drop("rises")
    filters = _move_keys(state.filters, joined.where("rises"), joined.where(F.lit(False)))
    return LineState(
        state.postings.unionByName(fresh),
        refs,
        filters if filters is not None else _build_filters(refs, state.min_docs),
        state.min_docs,
        state.min_chars,
    )


def delete(state: LineState, doc_ids: DataFrame, id_col: str = "doc_id") -> LineState:
    """The state without these documents; only keys that they hold are counted anew."""
    gone = doc_ids.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    held = materialize(
        state.postings.join(gone, "doc_id", "left_semi").select("key").distinct(), "line-held"
    )
    left = materialize(state.postings.join(gone, "doc_id", "left_anti").select("key", "doc_id"), "line-postings")
    now = _counted(left.join(held, "key", "left_semi"))
    touched = state.refs.join(held, "key", "left_semi").select("key", F.col("refs").alias("were"))
    changed = materialize(
        touched.join(now, "key", "left").select(
            "key",
            F.coalesce("refs", F.lit(0)).cast("long").alias("refs"),
            "keep_doc",
            (
                (F.col("were") >= state.min_docs)
                & (F.coalesce("refs", F.lit(0)) < state.min_docs)
            ).alias("falls"),
        ),
        "line-changed",
    )
    refs = materialize(
        state.refs.join(held, "key", "left_anti").unionByName(
            changed.where("refs > 0").select("key", "refs", "keep_doc")
        ),
        "line-refs",
    )
    filters = _move_keys(state.filters, changed.where(F.lit(False)), changed.where("falls"))
    return LineState(
        left,
        refs,
        filters if filters is not None else _build_filters(refs, state.min_docs),
        state.min_docs,
        state.min_chars,
    )


def drop_lines(
    state: LineState,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with columns ``kept_text``, ``n_lines`` (before) and ``n_dropped`` added.

    A line goes if its key is held by at least ``min_docs`` documents, unless the document
    has the largest doc_id that holds it (rows that repeat that doc_id all keep it; if every
    holder's doc_id is null, all keep it).  A null or empty text is one empty line.  Columns
    of those three names are replaced; all others are passed on.
    """
    added = ["kept_text", "n_lines", "n_dropped"]
    frequent = state.refs.where(F.col("refs") >= state.min_docs).select("key", "keep_doc")
    texts = keyed_texts(docs, id_col, text_col)
    texts = texts.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "text")
    lines = texts.mapInArrow(_eligible(state.min_chars), LINES_DDL)
    maybe = _probe_by_shard(lines, state.filters, _shards(state.filters))
    dropped = (
        maybe.join(frequent, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keep_doc")))
        .groupBy("row_key", "doc_id")
        .agg(F.collect_set("position").alias("__line_dropped"))
        .select(
            F.col("row_key").alias("__line_row"), F.col("doc_id").alias("__line_owner"), "__line_dropped"
        )
    )
    plain = docs.drop(*added)
    owner = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = plain.join(
        dropped,
        (F.xxhash64(owner, text) == F.col("__line_row")) & owner.eqNullSafe(F.col("__line_owner")),
        "left",
    )
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__line_dropped"))
    joined = F.concat_ws("\n", F.transform(kept, lambda i: F.get(lines, i)))
    return rows.select(
        *plain.columns,
        F.when(F.col("__line_dropped").isNull(), text).otherwise(joined).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__line_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
