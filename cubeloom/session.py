"""Session defaults and the folder shared by driver and executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Worth setting on any cluster: wide projections beyond the size HotSpot compiles
# (8000 bytes) are better split into small methods than fused and interpreted.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
_fallback: dict[str, str] = {}


def local_session(cpus: int | str = 8, app: str = "cubeloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (RECOMMENDED_CONF | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
UNSET_LIMIT = "65535"  # Spark's default


def split_large_methods(spark: SparkSession) -> None:
    """Take the recommended limit for generated methods, unless the session has one of its own.

    HotSpot never compiles a method of more than 8000 bytes, so a projection of 40 columns that
    Spark fuses into one is interpreted for every row.
    """
    if spark.conf.get(METHOD_LIMIT, UNSET_LIMIT) == UNSET_LIMIT:
        spark.conf.set(METHOD_LIMIT, RECOMMENDED_CONF[METHOD_LIMIT])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master, whose driver is its one executor, may do without.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        if "dir" not in _fallback:
            _fallback["dir"] = tempfile.mkdtemp(prefix="cubeloom-")
        folder = _fallback["dir"]
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


MANY = 1_000_000  # tasks, more than any stage has, so none are joined


def own_step(df: DataFrame) -> DataFrame:
    """The same rows in the same tasks, by a narrow step between two wide projections or a sort.

    Spark puts what lies between two steps into one generated method, and the JVM refuses one
    of more than 64 kB.
    """
    return df.coalesce(MANY)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go once it has run, not when the driver collects garbage.

    For writes, whose plans run once: another run of the same plan would make its files again.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def materialize(
    df: DataFrame, label: str, partition_by: str | None = None, path: str | None = None
) -> DataFrame:
    """Cut lineage through a written table, so a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = fresh_path(spark, label) if path is None else path
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
