"""Families of grids whose cells coincide, over all sources at once.

Two grids are neighbours where their cells are of one size and their origins a whole number of cells
apart, both within a tolerance; a family is all that neighbours connect. Sizes and origins fall into
buckets of the tolerance's width, so neighbours lie in one bucket or in two that touch, and are found
by an equi-join on buckets instead of comparing all grids with all.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.operators.joins import cut_lineage
from gridcensus.operators.quality import TOLERANCE

SHAPE = ["cell_width", "cell_height", "x_phase", "y_phase"]


def _phase(origin: str, size: str) -> Column:
    """Where an origin lies within a cell, from 0 up to 1."""
    return F.pmod(F.col(origin) / F.col(size), F.lit(1.0))


def _apart(a: Column, b: Column) -> Column:
    """Distance of two phases around the cell."""
    straight = F.abs(a - b)
    return F.least(straight, 1 - straight)


def _neighbours(shapes: DataFrame, tolerance: float) -> DataFrame:
    """Pairs (a, b) of neighbouring shapes, each pair in both orders."""
    around = int(1 / tolerance)
    sizes = [F.floor(F.log(c) / F.lit(tolerance)).alias(f"{c}_bucket") for c in SHAPE[:2]]
    phases = [F.least(F.floor(F.col(c) * around), F.lit(around - 1)).alias(f"{c}_bucket") for c in SHAPE[2:]]
    placed = shapes.select("*", *sizes, *phases)
    buckets = [f"{c}_bucket" for c in SHAPE]
    # each shape goes to its own bucket and to those that touch it; phases go around
    steps = F.array(*[F.array(*map(F.lit, step)) for step in product((-1, 0, 1), repeat=4)])
    sent = placed.withColumn("step", F.explode(steps))
    moved = [F.col(b) + F.get("step", F.lit(i)) for i, b in enumerate(buckets)]
    moved = [m if i < 2 else F.pmod(m, F.lit(around)) for i, m in enumerate(moved)]
    sent = sent.select(F.col("shape").alias("b"), *[F.col(c).alias(f"b_{c}") for c in SHAPE], *[m.alias(b) for m, b in zip(moved, buckets)])
    near = [F.abs(F.log(c) - F.log(f"b_{c}")) <= F.lit(tolerance) for c in SHAPE[:2]]
    near += [_apart(F.col(c), F.col(f"b_{c}")) <= F.lit(tolerance) for c in SHAPE[2:]]
    pairs = placed.join(sent, buckets).where((F.col("shape") != F.col("b")) & near[0] & near[1] & near[2] & near[3])
    return pairs.select(F.col("shape").alias("a"), "b").distinct()


def _connected(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, least): the least node that each node is connected to.

    Labels go to neighbours and then jump to the labels of their labels, so a chain shortens by half
    in every round. Each round is checkpointed.
    """
    labels = cut_lineage(nodes.select("node", F.col("node").alias("least")))
    pairs = cut_lineage(pairs)
    while True:
        seen = pairs.join(labels, pairs["b"] == labels["node"]).groupBy("a").agg(F.min("least").alias("offered"))
        told = labels.join(seen, labels["node"] == seen["a"], "left").select(
            "node", F.col("least").alias("was"), F.least("least", F.coalesce("offered", "least")).alias("least")
        )
        of = told.select(F.col("node").alias("least"), F.col("least").alias("further"))
        jumped = cut_lineage(told.join(of, "least").select("node", "was", F.col("further").alias("least")))
        labels = jumped.select("node", "least")
        if jumped.where("was <> least").isEmpty():
            return labels


def grid_families(grids: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """The grids with ``family``, the least key of their family, and its number of grids.

    ``grids`` has xmin, ymin, cell_width and cell_height. Sizes agree where their logarithms differ by
    the tolerance at most, origins where their places within a cell do. Grids of one shape are one node,
    so the join sees shapes only, however many sources share one.
    """
    phased = grids.withColumns({"x_phase": _phase("xmin", "cell_width"), "y_phase": _phase("ymin", "cell_height")})
    # the least key of a shape names it
    shapes = cut_lineage(phased.groupBy(*SHAPE).agg(F.min(key).alias("shape"), F.count(F.lit(1)).alias("n")))
    labels = _connected(shapes.select(F.col("shape").alias("node")), _neighbours(shapes, tolerance))
    joined = shapes.join(labels, shapes["shape"] == labels["node"])
    sizes = joined.groupBy("least").agg(F.sum("n").alias("n_grids"))
    named = joined.join(sizes, "least").select(*SHAPE, F.col("least").alias("family"), "n_grids")
    return phased.join(named, SHAPE).drop("x_phase", "y_phase")
