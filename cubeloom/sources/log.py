"""Small append-only logs that several writers may share.

A log is a folder of numbered files, each with a few rows as JSON lines.  A file is created only
if its number is free, whole and at once, so of two writers that saw the same last number one
wins; the other reads the log again and decides anew.  Rows are never changed: what counts is
the last row of a key, and the log as it was at a version can be read at any time.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.operators.history import latest_per_key

VERSION = "version"
# file systems whose rename refuses an existing target; object stores create conditionally
RENAMING = ("hdfs", "viewfs", "webhdfs", "swebhdfs", "ofs", "o3fs")
STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) with the session's own settings."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its text at once; False if it exists already."""
    system, target = hadoop_path(spark, path)
    system.mkdirs(target.getParent())
    scheme, data = system.getUri().getScheme(), text.encode()
    if scheme == "file":
        # a hard link is made whole or not at all, and never over another file
        local = target.toUri().getPath()
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            file.write(data)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    if scheme in RENAMING:
        draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
        _write(system.create(draft, False), data)
        if system.rename(draft, target):
            return True
        system.delete(draft, False)
        return False
    if system.exists(target):
        return False
    _write(system.create(target, False), data)
    return True


def _write(stream, data: bytes) -> None:
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list:
    """File statuses of the entries of a folder; none if there is no such folder."""
    system, target = hadoop_path(spark, path)
    return list(system.listStatus(target)) if system.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    system, target = hadoop_path(spark, path)
    system.delete(target, True)


@dataclass
class VersionedLog:
    """Rows of ``fields`` (DDL) below ``path``; one row per month or run, so it stays small."""

    spark: SparkSession
    path: str
    fields: str

    def last_version(self) -> int:
        names = (s.getPath().getName() for s in children(self.spark, self.path))
        return max((int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n))), default=0)

    def read(self, as_of: int | None = None) -> DataFrame:
        """All rows up to a version (default: now) with the version that added each."""
        last = self.last_version() if as_of is None else as_of
        empty = self.spark.createDataFrame([], f"{self.fields}, {VERSION} bigint")
        if not last:
            return empty
        stored = self.spark.read.schema(self.fields).options(**STAMPS).json(self.path)
        number = F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).cast("bigint")
        return stored.select("*", number.alias(VERSION)).where(F.col(VERSION) <= last)

    def latest(self, key: str, as_of: int | None = None) -> DataFrame:
        """The last row of each key, without its version."""
        return latest_per_key(self.read(as_of), key, [F.col(VERSION).desc()]).drop(VERSION)

    def append(self, decide: Callable[[DataFrame], DataFrame]) -> int | None:
        """Add the rows that ``decide`` makes of the log as it is; None if it makes none.

        When another writer was faster, ``decide`` is asked again about the log as it is then.
        """
        while True:
            last = self.last_version()
            rows = decide(self.read(last))
            names = self.spark.createDataFrame([], self.fields).columns
            json = F.to_json(F.struct(*names), {"ignoreNullFields": "false", **STAMPS})
            lines = [r[0] for r in rows.select(json).collect()]  # one per month or run
            if not lines:
                return None
            if put_if_absent(self.spark, f"{self.path}/{last + 1:020d}.json", "\n".join(lines) + "\n"):
                return last + 1
