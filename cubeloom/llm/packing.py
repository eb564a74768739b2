"""Token ids packed into fixed rows: best-fit decreasing with a segment tree.

Scan tasks pack what they read, buffer by buffer: no shuffle, bounded memory, and the fill is
near perfect as a buffer holds thousands of documents.  Documents longer than a row are split
without loss; every row comes with cumulative segment lengths and the places where positions
start again at 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm.common import numbering

ROW_TOKENS = 8_192
BUFFER_TOKENS = 8 << 20
PAD, EOS, FIRST = 0, 1, 3  # fixed values of the byte vocabulary: a byte b has the id b + 3

PACKED_DDL = (
    "row_id long, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_keys array<long>, doc_ids array<long>, starts array<long>, doc_tokens array<long>"
)
PACKED = pa.schema(
    [
        ("row_id", pa.int64()),
        ("ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())),
        ("doc_keys", pa.list_(pa.int64())),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
    ]
)


class RoomTree:
    """Which free capacities some open row has; finds the least one that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its room) of the least room >= need."""
        node = need + self.leaves
        if not self.count[node]:
            # climb until a right sibling has rows, then down its leftmost way
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers; longest pieces first, each into the fullest row that takes it."""
    tree, rows = RoomTree(capacity), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = tree.take(need)
        row, room = found if found else (len(rows), capacity)
        if not found:
            rows.append([])
        rows[row].append(piece)
        tree.put(room - need, row)
    return rows


def _pack_tokens(row_tokens: int, buffer_tokens: int, in_type: str, shift: int, eos: int | None):
    kind = np.dtype(in_type)

    def flush(held: list[tuple[int, int | None, np.ndarray]], numbers) -> Iterator[pa.RecordBatch]:
        pieces = [
            (doc, start)
            for doc, (_, _, ids) in enumerate(held)
            for start in range(0, max(1, len(ids)), row_tokens)
        ]
        lengths = np.array(
            [min(row_tokens, len(held[doc][2]) - start) for doc, start in pieces], np.int64
        )
        out: dict[str, list] = {name: [] for name in PACKED.names}

        def emit() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in PACKED], schema=PACKED
            )
            for column in out.values():
                column.clear()
            return made

        for row in best_fit_decreasing(lengths, row_tokens):
            matrix = np.full(row_tokens, PAD, "<u2" if shift or kind.itemsize < 2 else kind)
            ends = np.concatenate([[0], np.cumsum(lengths[row])])
            for at, piece in zip(ends, row):
                doc, start = pieces[piece]
                matrix[at : at + lengths[piece]] = held[doc][2][start : start + lengths[piece]]
            docs = [pieces[piece][0] for piece in row]
            out["row_id"].append(next(numbers))
            out["ids"].append(matrix.tobytes())
            out["cu_seqlens"].append(ends.tolist())
            out["position_resets"].append(ends[:-1].tolist())
            out["doc_keys"].append([held[d][0] for d in docs])
            out["doc_ids"].append([held[d][1] for d in docs])
            out["starts"].append([pieces[piece][1] for piece in row])
            out["doc_tokens"].append([len(held[d][2]) for d in docs])
            if len(out["row_id"]) >= 256:
                yield emit()
        if out["row_id"]:
            yield emit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, rows, held, size = numbering(), numbering(), [], 0
        for part in batches:
            for doc_id, data in zip(part.column("doc_id").to_pylist(), part.column("tokens")):
                ids = np.frombuffer(data.as_buffer(), kind) if data.is_valid else np.empty(0, kind)
                if shift:
                    ids = ids.astype("<u2") + np.uint16(shift)
                if eos is not None:
                    ids = np.append(ids, ids.dtype.type(eos))
                held.append((next(numbers), doc_id, ids))
                size += len(ids)
                if size >= buffer_tokens:
                    yield from flush(held, rows)
                    held, size = [], 0
        if held:
            yield from flush(held, rows)

    return run


def pack(
    tokens: DataFrame,
    id_col: str = "doc_id",
    token_col: str = "tokens",
    in_type: str = "<u4",
    row_tokens: int = ROW_TOKENS,
    buffer_tokens: int = BUFFER_TOKENS,
    shift: int = 0,
    eos: int | None = None,
) -> DataFrame:
    """Packed rows of ``tokens``, whose binary column holds little-endian ids of ``in_type``.

    ``ids`` is a row of the matrix, padded with 0 behind ``cu_seqlens[-1]``: unsigned 16-bit
    if the input is narrower or shifted, else of the input's type.  ``shift`` is added to each
    id, ``eos`` closes each document.  A piece is told by (doc_key, start): ``doc_keys`` are
    unique for each input row, so rows that repeat a doc_id, or have none, stay apart.  A null
    or empty document is a piece without ids (but for ``eos``).  Other columns are ignored; an
    empty table gives no rows.
    """
    rows = tokens.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(token_col).cast("binary").alias("tokens")
    )
    return rows.mapInArrow(
        _pack_tokens(row_tokens, buffer_tokens, in_type, shift, eos), PACKED_DDL
    )


def write_packed(packed: DataFrame, path: str) -> None:
    """One row of the matrix per record; already compact, so Parquet's own encodings suffice."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def unpack(packed: DataFrame, width: int = 2) -> DataFrame:
    """(doc_key, doc_id, tokens): the documents' ids again, as binary of ``width`` bytes each."""
    begin = F.element_at("cu_seqlens", F.col("at") + 1)
    end = F.element_at("cu_seqlens", F.col("at") + 2)
    pieces = packed.select("*", F.posexplode("doc_keys").alias("at", "doc_key")).select(
        "doc_key",
        F.get("doc_ids", F.col("at")).alias("doc_id"),
        F.struct(
            F.get("starts", F.col("at")).alias("start"),
            F.substring("ids", begin * width + 1, (end - begin) * width).alias("part"),
        ).alias("piece"),
    )
    ordered = F.sort_array(F.collect_list("piece"))
    return pieces.groupBy("doc_key", "doc_id").agg(
        F.aggregate(
            ordered, F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p["part"])
        ).alias("tokens")
    )
