"""Exact deduplication of whole texts by Grace hashing.

Equal means identical after no change.  The tables are open-addressing tables of
complete contents with a byte budget:

1. Every scan task folds the copies among its own rows, so that a text which a third
   of all rows share leaves a task a few times and not once per row.
2. The folded texts are partitioned by a hash of the content.  Each task fills a table
   until its budget is used up; contents that found no room are passed on *with all
   their copies* (once full, a table takes no new content) and are partitioned again by
   another hash, recursively, until every content has been in a table.  The partitions
   are Spark's shuffle and tables in the shared folder, so a lost executor costs a retry.

Each level admits at least one content per task, hence the recursion ends whatever the
lengths of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import batch, keyed_texts, numbering, shuffle_partitions
from cubeloom.session import materialize

TABLE_BYTES = 48 << 20
ENTRY_BYTES = 200  # what an entry costs beside its content
OUT_ROWS = 20_000


class ContentTable:
    """Open addressing with linear probing; contents are compared whole."""

    def __init__(self, budget: int):
        self.budget = budget
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.used = 0

    def _slot(self, mixed: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = mixed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == mixed and self.contents[entry] == content:
                break
            at = (at + 1) & mask
        return at

    def find_or_add(self, mixed: int, content: bytes) -> int | None:
        """The entry's number; None if the content is new and there is no room for it."""
        at = self._slot(mixed, content)
        if self.slots[at] >= 0:
            return self.slots[at]
        size = len(content) + ENTRY_BYTES
        if self.contents and self.used + size > self.budget:
            return None
        self.slots[at] = len(self.contents)
        self.hashes.append(mixed)
        self.contents.append(content)
        self.used += size
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, mixed in enumerate(self.hashes):
            at = mixed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _digest(content: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(content, seed)


FOLD = pa.schema(
    [
        ("is_row", pa.bool_()),
        ("row_id", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int64()),
        ("text_sha256", pa.string()),
        ("content", pa.binary()),
        ("n", pa.int64()),
    ]
)
FOLD_DDL = (
    "is_row boolean, row_id long, doc_id long, piece long, text_sha256 string, "
    "content binary, n long"
)
LOWEST = -(1 << 63)


def _order(doc_id: int | None, row_id: int) -> tuple[int, int, int]:
    """Largest doc_id first choice; a null one last; equal ones by row."""
    return (doc_id is not None, doc_id if doc_id is not None else 0, row_id)


def fold_copies(budget: int = TABLE_BYTES):
    """mapInArrow: rows (their piece and digest) and pieces (content, best row, copies).

    A full table is emitted and begun anew, so a task's memory is bounded and a frequent
    text stays folded wherever in the task its copies come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = numbering()
        table, best, pieces, counts = ContentTable(budget), [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(pieces), 500):
                hi = min(lo + 500, len(pieces))
                yield batch(
                    FOLD,
                    {
                        "is_row": [False] * (hi - lo),
                        "row_id": [b[2] for b in best[lo:hi]],
                        "doc_id": [b[1] if b[0] else None for b in best[lo:hi]],
                        "piece": pieces[lo:hi],
                        "text_sha256": [None] * (hi - lo),
                        "content": table.contents[lo:hi],
                        "n": counts[lo:hi],
                    },
                )

        for rows in batches:
            row_ids, row_pieces, digests = [], [], []
            doc_ids = rows.column("doc_id").to_pylist()
            for doc_id, text in zip(doc_ids, rows.column("text")):
                content = text.as_buffer().to_pybytes() if text.is_valid else b""
                row_id = next(ids)
                mixed = _digest(content, 0)
                entry = table.find_or_add(mixed, content)
                if entry is None:
                    yield from flush()
                    table, best, pieces, counts = ContentTable(budget), [], [], []
                    entry = table.find_or_add(mixed, content)
                key = _order(doc_id, row_id)
                if entry == len(best):
                    best.append(key)
                    pieces.append(row_id)
                    counts.append(0)
                best[entry] = max(best[entry], key)
                counts[entry] += 1
                row_ids.append(row_id)
                row_pieces.append(pieces[entry])
                digests.append(hashlib.sha256(content).hexdigest())
            n = len(row_ids)
            if n:
                yield batch(
                    FOLD,
                    {
                        "is_row": [True] * n,
                        "row_id": row_ids,
                        "doc_id": doc_ids,
                        "piece": row_pieces,
                        "text_sha256": digests,
                        "content": [None] * n,
                        "n": [None] * n,
                    },
                )
        yield from flush()

    return run


LEVEL = pa.schema(
    [
        ("piece", pa.int64()),
        ("keep_id", pa.int64()),
        ("keep_row", pa.int64()),
        ("group_size", pa.int64()),
        ("row_id", pa.int64()),
        ("doc_id", pa.int64()),
        ("content", pa.binary()),
        ("n", pa.int64()),
    ]
)
LEVEL_DDL = (
    "piece long, keep_id long, keep_row long, group_size long, row_id long, doc_id long, "
    "content binary, n long"
)


def one_level(seed: int, budget: int):
    """mapInArrow over one partition: resolved pieces, and those that found no room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, best, counts, members = ContentTable(budget), [], [], []
        for rows in batches:
            over: dict[str, list] = {f.name: [] for f in LEVEL}
            for piece, row_id, doc_id, content, n in zip(
                *(rows.column(c).to_pylist() for c in ("piece", "row_id", "doc_id", "content", "n"))
            ):
                entry = table.find_or_add(_digest(content, seed + 1), content)
                if entry is None:
                    for name, value in zip(
                        LEVEL.names, (piece, None, None, None, row_id, doc_id, content, n)
                    ):
                        over[name].append(value)
                    continue
                key = _order(doc_id, row_id)
                if entry == len(best):
                    best.append(key)
                    counts.append(0)
                    members.append([])
                best[entry] = max(best[entry], key)
                counts[entry] += n
                members[entry].append(piece)
            if over["piece"]:
                yield batch(LEVEL, over)
        flat = [(p, e) for e, own in enumerate(members) for p in own]
        for lo in range(0, len(flat), OUT_ROWS):
            part = flat[lo : lo + OUT_ROWS]
            nulls = [None] * len(part)
            yield batch(
                LEVEL,
                {
                    "piece": [p for p, _ in part],
                    "keep_id": [best[e][1] if best[e][0] else None for _, e in part],
                    "keep_row": [best[e][2] for _, e in part],
                    "group_size": [counts[e] for _, e in part],
                    "row_id": nulls,
                    "doc_id": nulls,
                    "content": nulls,
                    "n": nulls,
                },
            )

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    The row with the largest doc_id of equal texts stays; a null doc_id is smaller than
    any other, and of rows that repeat a doc_id exactly one stays.  A null text counts as
    the empty text.  ``keep_id`` is null only if every copy has a null doc_id.  Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folded = materialize(
        keyed_texts(docs, id_col, text_col).mapInArrow(fold_copies(table_bytes), FOLD_DDL),
        "grace-fold",
    )
    pieces = folded.where(~F.col("is_row")).select("piece", "row_id", "doc_id", "content", "n")
    size = pieces.agg(F.sum(F.octet_length("content") + ENTRY_BYTES)).first()[0] or 0
    resolved = None
    level, open_pieces = 0, pieces
    while size:
        parts = max(shuffle_partitions(spark), -(-2 * size // table_bytes))
        dealt = open_pieces.repartition(int(parts), F.xxhash64("content", F.lit(level)))
        done = materialize(
            dealt.mapInArrow(one_level(level, table_bytes), LEVEL_DDL), f"grace-level{level}"
        )
        found = done.where(F.col("keep_row").isNotNull()).select(
            "piece", "keep_id", "keep_row", "group_size"
        )
        resolved = found if resolved is None else resolved.unionByName(found)
        open_pieces = done.where(F.col("keep_row").isNull()).select(
            "piece", "row_id", "doc_id", "content", "n"
        )
        size = open_pieces.agg(F.sum(F.octet_length("content") + ENTRY_BYTES)).first()[0] or 0
        level += 1
    if resolved is None:
        resolved = spark.createDataFrame([], "piece long, keep_id long, keep_row long, group_size long")
    rows = folded.where("is_row").select("row_id", "doc_id", "piece", "text_sha256")
    return rows.join(resolved, "piece").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )
