"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``links`` (a, b).

    Both steps are grouped minima joined back, so a centre with very many neighbours
    is combined before the shuffle and its join can be split. Every round is written
    and reread; the driver sees a count and a checksum. Nodes without links, and links
    of a node to itself, give no row.
    """
    edges = saved(_oriented(links), "edges")
    state = _state(edges)
    while True:
        edges = saved(_small_star(_large_star(edges)), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(larger)


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(least.select("a", F.col("m").alias("b"))))
