"""Regions: parts, edges, the antimeridian rule and the tiles each region meets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import geometry
from gridcensus.functions.grid import GridSpec
from gridcensus.operators.scanline import scanline_runs


def explode_parts(regions: DataFrame) -> DataFrame:
    """One row per polygon of each region; attributes repeat, ``geom`` becomes part and rings."""
    attributes = [c for c in regions.columns if c != "geom"]
    parts = regions.select(*attributes, F.posexplode("geom").alias("part", "rings"))
    bounds = geometry.ring_bounds(F.element_at("rings", 1))
    return parts.select("*", *[bound.alias(name) for name, bound in bounds.items()])


def drop_antimeridian(parts: DataFrame) -> DataFrame:
    """Leave out parts that touch or cross x = 180 or x = -180; other parts of a region stay."""
    crosses = [
        (F.col("xmin") <= F.lit(x)) & (F.col("xmax") >= F.lit(x)) for x in (180.0, -180.0)
    ]
    return parts.where(~(crosses[0] | crosses[1]))


def part_edges(parts: DataFrame, *keep: str) -> DataFrame:
    """One row per edge of every ring: region_id, part, ring, x1, y1, x2, y2 and kept columns."""
    rings = parts.select("region_id", "part", *keep, F.posexplode("rings").alias("ring", "pts"))
    return rings.select(
        "region_id", "part", "ring", *keep, F.inline(geometry.ring_edges(F.col("pts")))
    )


def _clamped_sequence(first: str, last: str, size: int) -> str:
    low, high = f"greatest(0, int({first}))", f"least({size - 1}, int({last}))"
    return f"case when {low} <= {high} then sequence({low}, {high}) end"


def edge_tiles(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Tiles an edge meets, touching included, walked one tile row at a time along the edge.

    Within a row of tiles an edge covers one interval of x, so long edges never enumerate the
    tiles of their whole bounding box.
    """
    left, top = f"{grid.xmin!r}D", f"{grid.ymax!r}D"
    width, height = f"{grid.tile_width!r}D", f"{grid.tile_height!r}D"
    ordered = edges.selectExpr(
        "region_id", "part", "x1", "y1",
        "least(x1, x2) as west", "greatest(x1, x2) as east",
        "least(y1, y2) as south", "greatest(y1, y2) as north",
        "(x2 - x1) / nullif(y2 - y1, 0D) as slope",
    )
    rows = _clamped_sequence(
        f"ceil(({top} - north) / {height}) - 1", f"floor(({top} - south) / {height})", grid.layout_rows
    )
    banded = ordered.selectExpr("*", f"explode({rows}) as tile_row")
    crossed = banded.selectExpr(
        "region_id", "part", "tile_row", "west", "east",
        f"x1 + (least(north, {top} - tile_row * {height}) - y1) * slope as xa",
        f"x1 + (greatest(south, {top} - (tile_row + 1) * {height}) - y1) * slope as xb",
    )
    # a level edge has no slope: greatest and least leave the NULLs out and keep its own ends
    cols = _clamped_sequence(
        f"ceil((greatest(west, least(xa, xb)) - {left}) / {width}) - 1",
        f"floor((least(east, greatest(xa, xb)) - {left}) / {width})",
        grid.layout_cols,
    )
    return crossed.selectExpr("region_id", "part", f"explode({cols}) as tile_col", "tile_row")


def corner_tiles(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Tiles whose lower left corner lies inside a part."""
    runs = scanline_runs(
        edges,
        ["region_id", "part"],
        x0=grid.xmin, dx=grid.tile_width, n_cols=grid.layout_cols,
        y0=grid.ymax - grid.tile_height, dy=grid.tile_height, n_rows=grid.layout_rows,
    )
    return runs.select(
        "region_id",
        "part",
        F.explode(F.sequence("c0", "c1")).alias("tile_col"),
        F.col("row").alias("tile_row"),
    )


def tile_candidates(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, tile_col, tile_row) for every tile a part intersects, touching included.

    A part meets a tile where one of its edges does, or where it holds the tile's corner. Both
    come from the edges alone, without comparing all parts with all tiles.
    """
    edges = part_edges(parts)
    return edge_tiles(edges, grid).unionByName(corner_tiles(edges, grid)).distinct()


def region_tile_candidates(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """The same for whole regions: (region_id, tile_col, tile_row)."""
    edges = part_edges(parts)
    both = edge_tiles(edges, grid).unionByName(corner_tiles(edges, grid))
    return both.select("region_id", "tile_col", "tile_row").distinct()


def merge_equal_keys(regions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: features of one key become one region of all their parts.

    Its region_id is the least of them. A group is one region's features.
    """
    shapes = F.sort_array(F.collect_list(F.struct("region_id", "geom")))
    merged = regions.groupBy(*keys).agg(F.min("region_id").alias("region_id"), shapes.alias("shapes"))
    geom = F.flatten(F.transform("shapes", lambda s: s["geom"]))
    return merged.select("region_id", *keys, geom.alias("geom"))


def part_bounds(parts: DataFrame) -> tuple[float, float, float, float] | None:
    """(west, south, east, north) of all parts; None without any.

    One row of four numbers, read while a job is planned.
    """
    bounds = parts.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).head()
    return None if bounds[0] is None else tuple(bounds)


def attach_regions(summary: DataFrame, regions: DataFrame, key: str = "adm1_code") -> DataFrame:
    """Join summaries to their region features by key; a key with several features is an error."""
    attributes = [F.first(c).alias(c) for c in regions.columns if c != key]
    message = F.concat(F.lit("several regions share "), F.col(key))
    single = (
        regions.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), *attributes)
        .withColumn(key, F.when(F.col("n") == 1, F.col(key)).otherwise(F.raise_error(message)))
        .drop("n")
    )
    return summary.join(single, key)
