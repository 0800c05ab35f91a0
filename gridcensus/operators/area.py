"""Centroids, UTM zones and planar areas of regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import geometry, projections
from gridcensus.operators.regions import part_edges


def part_centroids(parts: DataFrame) -> DataFrame:
    """Adds centroid_x and centroid_y, the centre of mass of each part without its holes."""
    measured = parts.withColumn("moments", geometry.polygon_moments(F.col("rings")))
    x, y = geometry.centroid(F.col("moments"))
    return measured.select(*parts.columns, x.alias("centroid_x"), y.alias("centroid_y"))


def part_zones(parts: DataFrame) -> DataFrame:
    """Adds the UTM zone and hemisphere of each part's centroid."""
    return part_centroids(parts).select(
        "*",
        projections.utm_zone(F.col("centroid_x")).alias("utm_zone"),
        (F.col("centroid_y") < 0).alias("south"),
    )


def utm_vertices(parts: DataFrame) -> DataFrame:
    """Vertices of every ring in the UTM zone of their part."""
    zoned = part_zones(parts).select(
        "region_id", "part", "utm_zone", "south", F.posexplode("rings").alias("ring", "pts")
    )
    vertices = zoned.select(
        "region_id", "part", "ring", "utm_zone", "south", F.posexplode("pts").alias("i", "v")
    )
    easting, northing = projections.utm_coordinates(
        F.element_at("v", 1), F.element_at("v", 2), F.col("utm_zone"), F.col("south")
    )
    return vertices.select(
        "region_id", "part", "ring", "i", "utm_zone",
        easting.alias("easting"), northing.alias("northing"),
    )


def region_areas(parts: DataFrame) -> DataFrame:
    """Planar area of each region: every part in its own UTM zone, holes taken off.

    ``area`` is in thousands of square metres, the unit ``density`` divides by;
    ``area_km2`` is in square kilometres.
    """
    edges = part_edges(part_zones(parts), "utm_zone")
    meridian = projections.utm_central_meridian(F.col("utm_zone"))
    ax, ay = projections.utm_plane(F.col("x1"), F.col("y1"), meridian)
    bx, by = projections.utm_plane(F.col("x2"), F.col("y2"), meridian)
    projected = edges.select(
        "region_id", "part", "ring",
        ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"),
    )
    cross = F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")
    rings = projected.groupBy("region_id", "part", "ring").agg(
        (F.abs(F.sum(cross)) / 2).alias("m2")
    )
    side = F.when(F.col("ring") == 0, F.col("m2")).otherwise(-F.col("m2"))
    return (
        rings.groupBy("region_id")
        .agg(F.sum(side).alias("m2"))
        .select(
            "region_id",
            (F.col("m2") / 1000).alias("area"),
            (F.col("m2") / 1e6).alias("area_km2"),
        )
    )
