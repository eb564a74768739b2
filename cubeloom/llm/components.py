"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.session import materialize


def _canonical(edges: DataFrame) -> DataFrame:
    return (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node reachable.

    Roots are nodes of their own.  A round costs a few shuffles of the edges, and the number
    of rounds grows with the logarithm of a component's size.  A hub's edges meet only in
    aggregates with map-side combine and in joins that Spark can split; each round is
    written to the shared folder, so no plan grows with the rounds.
    """
    current = materialize(_canonical(edges.select("u", "v")), "components")
    state = None
    while True:
        now = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state or now[0] == 0:
            break
        state = now
        grown = _canonical(_large_star(current))
        current = materialize(_canonical(_small_star(grown)), "components")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = leaves.select(F.col("root").alias("node"), "root").distinct()
    return leaves.unionByName(roots)
