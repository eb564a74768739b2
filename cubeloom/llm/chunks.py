"""Distinct-word tables of document chunks, and their join back by position.

A scan task splits its documents into words and numbers the distinct words of each chunk of
about ``CHUNK_WORDS`` words, frequent ones first.  A document is then an array of word numbers
(about 1.7 bytes a word when compressed), and a chunk's distinct words go out in one packet for
each hash bucket.  All packets of a bucket meet in one task, where each distinct word of the
corpus is worked on once; the results go back to the chunks and are joined by word number.
Only distinct words and compressed numbers are shuffled, never texts, and a word that fills the
corpus is one entry in each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import numbering, shuffle_partitions, tidy
from cubeloom.session import materialize

CHUNK_WORDS = 4_000_000
GROUP_WORDS = 250_000  # of the documents that share a row
DOCS = -1  # the bucket of rows that hold documents

CHUNK = pa.schema(
    [
        ("chunk", pa.int64()),
        ("bucket", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("flags", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("numbers", pa.binary()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
    ]
)
CHUNK_DDL = (
    "chunk long, bucket int, doc_ids array<long>, flags array<boolean>, lengths array<int>, "
    "numbers binary, words binary, counts binary"
)


def pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(unpack_bytes(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def pack_bytes(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(3).compress(data)


def unpack_bytes(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_words(words: list[bytes]) -> bytes:
    """Words without line feeds."""
    return pack_bytes(b"\n".join(words))


def unpack_words(data: bytes, n: int) -> list[bytes]:
    return unpack_bytes(data).split(b"\n") if n else []


class Numbers(dict):
    """The number of each distinct word, in the order of their first use."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _chunks(split: Callable[[bytes], list[bytes]], buckets: int, chunk_words: int):
    def close(chunk: int, ids: Numbers, docs: list, counted: bool) -> Iterator[pa.RecordBatch]:
        words = list(ids)
        every = np.concatenate([n for _, _, n in docs]) if docs else np.empty(0, np.uint32)
        counts = np.bincount(every, minlength=len(words))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        trained = np.zeros(len(words), np.int64)
        if counted:
            own = [n for _, flag, n in docs if flag]
            if own:
                trained = np.bincount(np.concatenate(own), minlength=len(words))
        lo = 0
        while lo < len(docs):
            hi, size = lo, 0
            while hi < len(docs) and (hi == lo or size + len(docs[hi][2]) <= GROUP_WORDS):
                size += len(docs[hi][2])
                hi += 1
            part = docs[lo:hi]
            yield row(
                chunk,
                DOCS,
                [d for d, _, _ in part],
                [f for _, f, _ in part],
                [len(n) for _, _, n in part],
                pack_ints(rank[np.concatenate([n for _, _, n in part])]),
                None,
                None,
            )
            lo = hi
        digest = xxhash.xxh3_64_intdigest
        bucket = np.fromiter((digest(w) % buckets for w in words), np.int32, len(words))[order]
        for b in np.unique(bucket).tolist():
            own = np.flatnonzero(bucket == b)
            yield row(
                chunk,
                b,
                None,
                None,
                [len(own)],
                pack_ints(np.diff(own, prepend=0)),
                pack_words([words[i] for i in order[own]]),
                pack_ints(trained[order[own]]) if counted else None,
            )

    def row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, CHUNK)], schema=CHUNK
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        chunks, ids, docs, size = numbering(), Numbers(), [], 0
        counted = False
        for rows in batches:
            names = rows.schema.names
            counted = "flag" in names
            flags = rows.column("flag").to_pylist() if counted else [None] * rows.num_rows
            for doc_id, flag, text in zip(
                rows.column("doc_id").to_pylist(), flags, rows.column("text")
            ):
                words = split(text.as_buffer().to_pybytes() if text.is_valid else b"")
                numbers = np.fromiter(map(ids.__getitem__, words), np.uint32, len(words))
                docs.append((doc_id, flag, numbers))
                size += len(words)
                if size >= chunk_words:
                    yield from close(next(chunks), ids, docs, counted)
                    ids, docs, size = Numbers(), [], 0
        if docs:
            yield from close(next(chunks), ids, docs, counted)
        del ids, docs
        tidy()

    return run


def write_chunks(
    docs: DataFrame, split: Callable[[bytes], list[bytes]], chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Chunks of ``docs`` (doc_id, text and, if words are to be counted, flag), written once.

    ``split`` gives the words of a text in UTF-8; words hold no line feed.  With flags, a
    packet also has how often each word occurs in the flagged documents of the chunk.
    """
    buckets = max(32, shuffle_partitions(docs.sparkSession))
    return materialize(docs.mapInArrow(_chunks(split, buckets, chunk_words), CHUNK_DDL), "chunks")


def documents_of(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("bucket") == DOCS).select(
        "chunk", "doc_ids", "flags", "lengths", "numbers"
    )


def packets_of(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("bucket") != DOCS).select(
        "chunk", "bucket", F.col("lengths")[0].alias("n"), "numbers", "words", "counts"
    )


def word_order(packets: pa.Table) -> np.ndarray:
    """For a chunk's packets one behind the other: the place of each word number."""
    numbers = [np.cumsum(unpack_ints(d).astype(np.int64)) for d in packets.column("numbers").to_pylist()]
    if not numbers:
        return np.empty(0, np.int64)
    every = np.concatenate(numbers)
    place = np.empty(len(every), np.int64)
    place[every] = np.arange(len(every))
    return place
