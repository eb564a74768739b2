"""Small helpers that several text operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.session import materialize

# White space of the contracts: blank, tab, line feed, vertical tab, form feed, return.
# ``bytes.split()``, ``bytes.strip()`` and ``bytes.lower()`` use exactly these and A-Z.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text): whatever else the table carries cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def crc_bucket(column: Column, buckets: int) -> Column:
    """crc32 of the value as text, modulo ``buckets``; null for a null value."""
    return F.crc32(column.cast("string").cast("binary")) % buckets


def numbering() -> Iterator[int]:
    """Numbers that no other task of the stage hands out."""
    base = TaskContext.get().partitionId() << 36
    while True:
        yield base
        base += 1


def stable_scan(df: DataFrame, label: str) -> DataFrame:
    """Written and read back, so that reruns of a task see the same rows in the same order."""
    return materialize(df, label)


def batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], field.type) for field in schema], schema=schema
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidy() -> None:
    """Give memory that is not in use back to the machine.

    Spark keeps Python workers for its next tasks; without this, each holds on to the largest
    amount it ever needed while tasks of another kind run beside it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
        ctypes.CDLL(None).malloc_trim(0)


class Shared:
    """A bounded value for all tasks of a plan, sent to each executor once."""

    def __init__(self, spark: SparkSession, value):
        # by value like the functions themselves: executors need not have this package
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._read = None

    def __getstate__(self):
        return {"_sent": self._sent, "_read": None}

    @property
    def value(self):
        if self._read is None:
            self._read = cloudpickle.loads(self._sent.value)
        return self._read
