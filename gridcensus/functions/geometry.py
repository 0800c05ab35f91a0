"""Geometry of one row's nested rings, computed inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def close_ring(ring: Column) -> Column:
    """Repeat the first vertex at the end where the ring does not close by itself."""
    first = F.element_at(ring, 1)
    return F.when(F.element_at(ring, -1) == first, ring).otherwise(F.concat(ring, F.array(first)))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as an array of (x1, y1, x2, y2)."""
    closed = close_ring(ring)
    starts = F.slice(closed, F.lit(1), F.greatest(F.size(closed) - 1, F.lit(0)))
    ends = F.slice(closed, F.lit(2), F.greatest(F.size(closed) - 1, F.lit(0)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            F.element_at(a, 1).alias("x1"),
            F.element_at(a, 2).alias("y1"),
            F.element_at(b, 1).alias("x2"),
            F.element_at(b, 2).alias("y2"),
        ),
    )


def ring_bounds(ring: Column) -> dict[str, Column]:
    xs = F.transform(ring, lambda v: F.element_at(v, 1))
    ys = F.transform(ring, lambda v: F.element_at(v, 2))
    return {
        "xmin": F.array_min(xs),
        "ymin": F.array_min(ys),
        "xmax": F.array_max(xs),
        "ymax": F.array_max(ys),
    }


def _ring_moments(ring: Column) -> Column:
    """Doubled signed area and six-fold first moments of one ring."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("a"), zero.alias("mx"), zero.alias("my"))

    def add(acc: Column, e: Column) -> Column:
        cross = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (e["x1"] + e["x2"]) * cross).alias("mx"),
            (acc["my"] + (e["y1"] + e["y2"]) * cross).alias("my"),
        )

    return F.aggregate(ring_edges(ring), start, add)


def polygon_moments(rings: Column) -> Column:
    """Area and first moments of a polygon: its shell counts for it, its holes against it."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("a"), zero.alias("mx"), zero.alias("my"))
    signed = F.transform(
        rings,
        lambda ring, i: F.struct(
            _ring_moments(ring).alias("m"),
            F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("side"),
        ),
    )

    def add(acc: Column, r: Column) -> Column:
        turn = r["side"] * F.signum(r["m"]["a"])
        return F.struct(
            (acc["a"] + turn * r["m"]["a"] / 2).alias("a"),
            (acc["mx"] + turn * r["m"]["mx"] / 6).alias("mx"),
            (acc["my"] + turn * r["m"]["my"] / 6).alias("my"),
        )

    return F.aggregate(signed, start, add)


def centroid(moments: Column) -> tuple[Column, Column]:
    return F.try_divide(moments["mx"], moments["a"]), F.try_divide(moments["my"], moments["a"])


def ring_turn(ring: Column) -> Column:
    """1 for a ring that turns to the left, -1 for one that turns to the right, 0 without area."""
    return F.signum(_ring_moments(ring)["a"])
