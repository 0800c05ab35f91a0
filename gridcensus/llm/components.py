"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, with the least id among the first node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("of"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the least id of its component) of every node in ``edges`` (a, b).

    Each round writes its edges to the shared folder; rounds end when the edges no longer change,
    after a number of rounds that grows with the logarithm of the longest chain. Nothing but a count
    and a checksum reaches the driver.
    """
    loops = edges.select("a").union(edges.select("b")).distinct()
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
        before = mark
        large = _stars(edges).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where(F.col("a") != F.col("b")).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
        down = large.join(least, F.col("a") == F.col("of"))
        small = down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        edges = materialize(small.where(F.col("a") != F.col("b")).distinct(), "edges")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return loops.withColumnRenamed("a", "node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
