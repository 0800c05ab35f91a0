"""Statistics and breaks read from a merged sketch, by interpolated inversion (Ben-Haim and Tom-Tov 2010).

A sketch is an array of bins (x, y): y values lie around x, half of them on either side. Between two
bins the density changes linearly, so the number of values up to a point is a piece of a parabola, and
a quantile is the point where that reaches its share. The least and greatest value close the ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.operators.zonal import distribution_mode


def bin_total(distribution: Column) -> Column:
    return F.aggregate(distribution, F.lit(0.0), lambda n, b: n + b["y"])


def _segments(distribution: Column, zmin: Column, zmax: Column) -> Column:
    """Array of (x0, y0, x1, y1, below): neighbouring bins and the number of values up to the first."""

    def end(x: Column) -> Column:
        return F.array(F.struct(x.cast("double").alias("x"), F.lit(0.0).alias("y")))

    points = F.concat(end(zmin), F.transform(distribution, lambda b: F.struct(b["x"].alias("x"), b["y"].alias("y"))), end(zmax))
    pairs = F.zip_with(
        F.slice(points, F.lit(1), F.size(points) - 1),
        F.slice(points, F.lit(2), F.size(points) - 1),
        lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")),
    )
    start = F.struct(
        F.lit(0.0).alias("below"),
        F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double,below:double>>").alias("done"),
    )

    def add(so_far: Column, s: Column) -> Column:
        one = F.struct(*[s[k].alias(k) for k in ("x0", "y0", "x1", "y1")], so_far["below"].alias("below"))
        return F.struct(
            (so_far["below"] + (s["y0"] + s["y1"]) / 2).alias("below"), F.concat(so_far["done"], F.array(one)).alias("done")
        )

    return F.aggregate(pairs, start, add, lambda so_far: so_far["done"])


def _inverted(segment: Column, target: Column) -> Column:
    """The point of a segment up to which ``target`` values lie."""
    rest = F.greatest(target - segment["below"], F.lit(0.0))
    bend = segment["y1"] - segment["y0"]
    root = F.sqrt(F.greatest(segment["y0"] * segment["y0"] + 2 * bend * rest, F.lit(0.0)))
    # the form of the root that neither cancels nor divides by a bend of nearly nothing
    share = F.coalesce(F.try_divide(2 * rest, segment["y0"] + root), F.lit(0.0))
    return segment["x0"] + (segment["x1"] - segment["x0"]) * F.least(share, F.lit(1.0))


def sketch_quantiles(distribution: Column, zmin: Column, zmax: Column, shares: Sequence[float]) -> Column:
    """Array of quantiles; NULL for an empty sketch."""
    segments, total = _segments(distribution, zmin, zmax), bin_total(distribution)

    def quantile(share: float, of: Column) -> Column:
        target = F.lit(float(share)) * of["total"]
        reached = F.filter(of["segments"], lambda s: s["below"] + (s["y0"] + s["y1"]) / 2 >= target)
        found = F.coalesce(F.get(reached, F.lit(0)), F.element_at(of["segments"], -1))
        return _inverted(found, target)

    once = F.array(F.struct(segments.alias("segments"), total.alias("total")))
    found = F.get(F.transform(once, lambda of: F.array(*[quantile(s, of) for s in shares])), F.lit(0))
    return F.when(F.size(distribution) > 0, found)


STATISTICS = ("mean", "median", "mode", "stddev")


def sketch_statistics(
    summary: DataFrame, breaks: int = 0, wanted: Sequence[str] = STATISTICS, distribution: str = "distribution"
) -> DataFrame:
    """Adds the wanted statistics, and ``breaks`` quantile breaks, from the sketch, zmin and zmax alone.

    The mean is exact up to rounding, as bins keep weighted sums. A quantile lies between the two bins
    around its rank, so its rank is off by at most half the values of those two. The deviation takes
    every value at the centre of its bin, so it is at most the exact one.
    """
    bins, low, high = F.col(distribution), F.col("zmin"), F.col("zmax")
    total = bin_total(bins)
    mean = F.try_divide(F.aggregate(bins, F.lit(0.0), lambda a, b: a + b["x"] * b["y"]), total)
    # distances from the least value, so large values close together do not cancel
    first = F.aggregate(bins, F.lit(0.0), lambda a, b: a + (b["x"] - low) * b["y"])
    second = F.aggregate(bins, F.lit(0.0), lambda a, b: a + (b["x"] - low) * (b["x"] - low) * b["y"])
    spread = F.try_divide(second, total) - F.pow(F.try_divide(first, total), F.lit(2.0))
    shares = [0.5, *[(i + 1) / breaks for i in range(breaks)]]
    read = summary.withColumn("_quantiles", sketch_quantiles(bins, low, high, shares))
    added = {
        "mean": mean,
        "median": F.get("_quantiles", F.lit(0)),
        "mode": distribution_mode(bins),
        "stddev": F.sqrt(F.greatest(spread, F.lit(0.0))),
    }
    added = {name: added[name] for name in wanted}
    if breaks:
        added["breaks"] = F.slice("_quantiles", 2, breaks)
    return read.withColumns(added).drop("_quantiles")
