"""Colour-classified Web Mercator pyramid of the merged population layer.

Two physical forms give the same base level. Pixels finer than the raster are computed from packed
tiles, block by block; coarser ones from cells, which reduce to pixels before they shuffle. The levels
above are averaged block by block in either case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.colors import (
    GLOBAL_BREAKS,
    MAP_COLORS,
    classify,
    stable,
)
from gridcensus.functions.grid import GridSpec, ZoomLevel
from gridcensus.operators.block_tiles import warp_levels
from gridcensus.operators.mosaic import mosaic_cells
from gridcensus.operators.pyramid import (
    BLOCK,
    block_span,
    climb,
    level_steps,
    place_in_blocks,
    pyramid_tiles,
)
from gridcensus.operators.resample import mercator_axes, resample_bilinear
from gridcensus.operators.tiles import pack_tiles, unpack_tiles
from gridcensus.sinks.map_tiles import shade_tiles
from gridcensus.sources import catalog

BASE_ZOOM = 12


def finer_than_raster(level: ZoomLevel, grid: GridSpec) -> bool:
    return 360.0 / level.pixels <= grid.cell_width


def mercator_layer(
    raster: DataFrame, grid: GridSpec, level: ZoomLevel, partitions: int | None = None
) -> DataFrame:
    """(block_col, block_row, col, row, value) at one zoom: sources warped bilinearly, then merged.

    Warped cells are placed in the pyramid's blocks first, so merging and the levels above share
    one shuffle.
    """
    cells = unpack_tiles(raster, grid.tile_size) if "cells" in raster.columns else raster
    warped = resample_bilinear(cells, grid, mercator_axes(level))
    return mosaic_cells(place_in_blocks(warped, block_span(level.tile_size), partitions), *BLOCK)


def tile_levels(
    raster: DataFrame,
    grid: GridSpec,
    base_zoom: int,
    min_zoom: int,
    tile_size: int,
    partitions: int | None = None,
) -> DataFrame:
    """(zoom, tile_col, tile_row, cells) of all levels.

    The base level comes from packed tiles where its pixels are finer than the raster, else from cells,
    which reduce to pixels before they shuffle; from there on both are tiles in the same blocks.
    """
    base = ZoomLevel(base_zoom, tile_size)
    if not finer_than_raster(base, grid):
        return pyramid_tiles(mercator_layer(raster, grid, base, partitions), base_zoom, min_zoom, tile_size)
    packed = raster if "cells" in raster.columns else pack_tiles(raster, grid.tile_size)
    steps = level_steps(base_zoom, min_zoom)
    first = warp_levels(packed, grid, base, steps[0], block_span(tile_size), partitions)
    return climb(first, steps, tile_size)


def render_pyramid(
    raster: DataFrame,
    grid: GridSpec,
    *,
    base_zoom: int = BASE_ZOOM,
    min_zoom: int = 0,
    tile_size: int = 256,
    colors: Sequence[int] = MAP_COLORS,
    breaks: Sequence[float] = GLOBAL_BREAKS,
    include: Sequence[int] | None = None,
    exclude: Sequence[int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """(zoom, col, row, color) of every pixel with data on every level."""
    raster = catalog.exclude(catalog.include(raster, include, "src"), exclude, "src")
    span = (base_zoom, min_zoom, tile_size, partitions)
    pixels = unpack_tiles(tile_levels(raster, grid, *span), tile_size)
    color = classify(stable(F.col("value")), colors, breaks)
    return pixels.select("zoom", "col", "row", color.alias("color"))


def render_tiles(
    raster: DataFrame,
    grid: GridSpec,
    output: str,
    *,
    base_zoom: int = BASE_ZOOM,
    min_zoom: int = 0,
    tile_size: int = 256,
    colors: Sequence[int] = MAP_COLORS,
    breaks: Sequence[float] = GLOBAL_BREAKS,
    include: Sequence[int] | None = None,
    exclude: Sequence[int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The same packed as tile rows (zoom, tile_col, tile_row, path, rgba)."""
    raster = catalog.exclude(catalog.include(raster, include, "src"), exclude, "src")
    span = (base_zoom, min_zoom, tile_size, partitions)
    return shade_tiles(tile_levels(raster, grid, *span), output, colors, breaks)
