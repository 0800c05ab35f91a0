"""Rendering again only what changed: a rendered pyramid brought up to date with changed source tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec, ZoomLevel
from gridcensus.operators.block_tiles import coarser_levels, read_blocks, warp_levels
from gridcensus.operators.joins import broadcast_if_small, cut_lineage

TILE = ["tile_col", "tile_row"]


def stale_tiles(changed: DataFrame, grid: GridSpec, base_zoom: int, min_zoom: int, tile_size: int) -> DataFrame:
    """(zoom, tile_col, tile_row) of the rendered tiles that changed source tiles reach on any level."""
    base = read_blocks(changed.select(*TILE).distinct(), grid, ZoomLevel(base_zoom, tile_size), tile_size)
    base = base.select("block_col", "block_row").distinct()
    zoom = F.explode(F.sequence(F.lit(min_zoom), F.lit(base_zoom))).alias("zoom")
    up = F.lit(base_zoom) - F.col("zoom")
    levels = base.select("*", zoom)
    shifted = [F.call_function("shiftright", F.col(b), up).alias(t) for b, t in (("block_col", "tile_col"), ("block_row", "tile_row"))]
    return levels.select("zoom", *shifted).distinct()


def source_tiles_of(tiles: DataFrame, stale: DataFrame, grid: GridSpec, base_zoom: int, tile_size: int) -> DataFrame:
    """(tile_col, tile_row) of the source tiles that stale tiles of the base level read.

    Found from the keys of ``tiles`` alone; of a table stored along the curve they make key ranges.
    """
    keys = tiles.select(*TILE).distinct()
    blocks = read_blocks(keys, grid, ZoomLevel(base_zoom, tile_size), tile_size)
    base = stale.where(F.col("zoom") == base_zoom).select(F.col("tile_col").alias("block_col"), F.col("tile_row").alias("block_row"))
    return blocks.join(broadcast_if_small(base), ["block_col", "block_row"], "left_semi").select(*TILE).distinct()


def refresh_levels(
    stored: DataFrame,
    tiles: DataFrame,
    changed: DataFrame,
    grid: GridSpec,
    *,
    base_zoom: int,
    min_zoom: int = 0,
    tile_size: int = 256,
) -> DataFrame:
    """(zoom, tile_col, tile_row, cells) of all levels after the source tiles at ``changed`` keys changed.

    ``stored`` are the levels as rendered before, ``tiles`` the source tiles as they are now. Changed
    keys are carried up the zooms. On the base level the pixels of stale tiles are warped again from the
    source tiles they read; above it a stale tile is averaged from its four children, new ones and
    stored ones. All other tiles are the stored ones. A stale tile left without data is gone.
    """
    level = ZoomLevel(base_zoom, tile_size)
    stale = cut_lineage(stale_tiles(changed, grid, base_zoom, min_zoom, tile_size))
    read = source_tiles_of(tiles, stale, grid, base_zoom, tile_size)
    sources = tiles.join(broadcast_if_small(read), TILE, "left_semi")
    names = {"tile_col": "block_col", "tile_row": "block_row"}
    only = stale.where(F.col("zoom") == base_zoom).select(*[F.col(t).alias(b) for t, b in names.items()])
    zooms = range(base_zoom, base_zoom - 1, -1)
    fresh = [cut_lineage(warp_levels(sources, grid, level, zooms, tile_size, only=broadcast_if_small(only)))]

    key = ["zoom", *TILE]
    kept = stored.join(broadcast_if_small(stale), key, "left_anti")
    for zoom in range(base_zoom - 1, min_zoom - 1, -1):
        parents = stale.where(F.col("zoom") == zoom).select(F.col("tile_col").alias("up_col"), F.col("tile_row").alias("up_row"))
        ups = {"up_col": F.shiftright("tile_col", 1), "up_row": F.shiftright("tile_row", 1)}
        beside = kept.where(F.col("zoom") == zoom + 1).withColumns(ups)
        beside = beside.join(broadcast_if_small(parents), ["up_col", "up_row"], "left_semi").select(*key, "cells")
        children = fresh[-1].select(*key, "cells").unionByName(beside)
        fresh.append(cut_lineage(coarser_levels(children, range(zoom, zoom - 1, -1), tile_size, tile_size)))
    return reduce(DataFrame.unionByName, [kept.select(*key, "cells"), *[f.select(*key, "cells") for f in fresh]])
