"""Packed tiles to packed Web Mercator tiles, a block of tiles at a time.

For pixels finer than the raster the cell-by-cell form multiplies rows: every pixel takes four
contributions. Here source tiles travel packed to the blocks that read them, and each block is
warped, merged and averaged as arrays. Tasks read their blocks sorted by source and keep one
source window and one block in memory, however many sources meet there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import projections
from gridcensus.functions.grid import MERCATOR_HALF, MERCATOR_MAX_LAT, GridSpec, ZoomLevel

TILES = "zoom int, tile_col int, tile_row int, cells array<double>"
BLOCK = ["block_col", "block_row"]


def _halve(block: np.ndarray) -> np.ndarray:
    """Mean of the data cells of every 2 x 2 square."""
    rows, cols = block.shape
    squares = block.reshape(rows // 2, 2, cols // 2, 2)
    n = np.isfinite(squares).sum(axis=(1, 3))
    total = np.nansum(squares, axis=(1, 3))
    return np.where(n > 0, total / np.maximum(n, 1), np.nan)


def _cut(
    block: np.ndarray, col: int, row: int, zooms: range, size: int
) -> Iterator[pd.DataFrame]:
    """Tiles with data on the levels of a block at block position (col, row)."""
    for zoom in zooms:
        if zoom != zooms[0]:
            block = _halve(block)
        n = block.shape[0] // size
        tiles = block.reshape(n, size, n, size).swapaxes(1, 2)
        rows, cols = np.nonzero(np.isfinite(tiles).any(axis=(2, 3)))
        if len(rows):
            yield pd.DataFrame(
                {
                    "zoom": zoom,
                    "tile_col": col * n + cols,
                    "tile_row": row * n + rows,
                    "cells": [tiles[r, c].ravel() for r, c in zip(rows, cols)],
                }
            )


class _Warp:
    """Bilinear reading of a source grid by the pixels of one block."""

    def __init__(self, grid: GridSpec, level: ZoomLevel, span: int, col: int, row: int):
        x = (np.arange(col * span, (col + 1) * span) + 0.5) * level.pixel_metres - MERCATOR_HALF
        y = MERCATOR_HALF - (np.arange(row * span, (row + 1) * span) + 0.5) * level.pixel_metres
        lat = np.degrees(2.0 * np.arctan(np.exp(y / projections.EARTH_RADIUS)) - np.pi / 2)
        fx = (x * 180.0 / MERCATOR_HALF - grid.xmin) / grid.cell_width - 0.5
        fy = (grid.ymax - lat) / grid.cell_height - 0.5
        self.size = grid.tile_size
        self.wx, self.wy = fx - np.floor(fx), (fy - np.floor(fy))[:, None]
        cols, rows = np.floor(fx).astype(int), np.floor(fy).astype(int)
        self.left, self.top = cols[0], rows[0]
        self.cols, self.rows = cols - cols[0], rows - rows[0]
        self.clear()

    def clear(self) -> None:
        self.window = np.full((self.rows[-1] + 2, self.cols[-1] + 2), np.nan)

    def add(self, tile_col: int, tile_row: int, cells: np.ndarray) -> None:
        """Put the part of a source tile that this block reads into the window."""
        size, (height, width) = self.size, self.window.shape
        dx, dy = tile_col * size - self.left, tile_row * size - self.top
        x0, x1 = max(dx, 0), min(dx + size, width)
        y0, y1 = max(dy, 0), min(dy + size, height)
        if x0 < x1 and y0 < y1:
            tile = np.asarray(cells, dtype=float).reshape(size, size)
            self.window[y0:y1, x0:x1] = tile[y0 - dy : y1 - dy, x0 - dx : x1 - dx]

    def pixels(self) -> np.ndarray:
        def both_axes(layer: np.ndarray) -> np.ndarray:
            wide = layer[:, self.cols] * (1 - self.wx) + layer[:, self.cols + 1] * self.wx
            return wide[self.rows] * (1 - self.wy) + wide[self.rows + 1] * self.wy

        data = np.isfinite(self.window)
        weight = both_axes(data.astype(float))
        total = both_axes(np.where(data, self.window, 0.0))
        return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), np.nan)


def _block_range(low: Column, high: Column, pixel_metres: float, span: int, blocks: int) -> Column:
    """Blocks from one distance to another, in metres from the square's edge, one pixel wider."""
    first = F.floor((low / F.lit(pixel_metres) - 1) / F.lit(span)).cast("int")
    last = F.floor((high / F.lit(pixel_metres) + 1) / F.lit(span)).cast("int")
    return F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(blocks - 1))))


def read_blocks(tiles: DataFrame, grid: GridSpec, level: ZoomLevel, span: int) -> DataFrame:
    """Source tiles next to every block that reads them, their rims of half a cell included."""
    half, blocks = F.lit(MERCATOR_HALF), max(1, level.pixels // span)
    extent = grid.tile_extent(F.col("tile_col"), F.col("tile_row"))
    limit = F.lit(MERCATOR_MAX_LAT)

    def from_west(lon: Column) -> Column:
        return half + projections.mercator_x(F.greatest(F.lit(-180.0), F.least(F.lit(180.0), lon)))

    def from_north(lat: Column) -> Column:
        return half - projections.mercator_y(F.greatest(-limit, F.least(limit, lat)))

    rim_x, rim_y = F.lit(grid.cell_width), F.lit(grid.cell_height)
    wide = tiles.withColumn(
        "block_col",
        _block_range(
            from_west(extent["xmin"] - rim_x), from_west(extent["xmax"] + rim_x),
            level.pixel_metres, span, blocks,
        ),
    )
    return wide.withColumn(
        "block_row",
        _block_range(
            from_north(extent["ymax"] + rim_y), from_north(extent["ymin"] - rim_y),
            level.pixel_metres, span, blocks,
        ),
    )


def warp_levels(
    tiles: DataFrame,
    grid: GridSpec,
    level: ZoomLevel,
    zooms: range,
    span: int,
    partitions: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """(zoom, tile_col, tile_row, cells) of the base level and those above it, in one shuffle.

    Sources are warped bilinearly and the lowest with data wins a pixel. ``zooms`` counts down
    from the base level. ``span`` is a block's side in pixels
    and must hold whole tiles on every level. ``only`` names the blocks to make, by block_col and block_row.
    """
    size = level.tile_size
    span = min(span, level.pixels)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = source = warp = block = None
        for frame in frames:
            for bc, br, src, tc, tr, cells in zip(
                frame["block_col"], frame["block_row"], frame["src"],
                frame["tile_col"], frame["tile_row"], frame["cells"],
            ):
                if warp is not None and (key, source) != ((bc, br), src):
                    block = np.where(np.isnan(block), warp.pixels(), block)
                    warp.clear()
                if key != (bc, br):
                    if key is not None:
                        yield from _cut(block, *key, zooms, size)
                    warp = _Warp(grid, level, span, bc, br)
                    block = np.full((span, span), np.nan)
                key, source = (bc, br), src
                warp.add(tc, tr, cells)
        if key is not None:
            block = np.where(np.isnan(block), warp.pixels(), block)
            yield from _cut(block, *key, zooms, size)

    placed = read_blocks(tiles.select("src", "tile_col", "tile_row", "cells"), grid, level, span)
    if only is not None:
        placed = placed.join(only, BLOCK, "left_semi")
    keys = BLOCK if partitions is None else [partitions, *BLOCK]
    ordered = placed.repartition(*keys).sortWithinPartitions(*BLOCK, "src")
    return ordered.mapInPandas(run, TILES)


def cell_blocks(cells: DataFrame, zooms: range, size: int, span: int) -> DataFrame:
    """(zoom, tile_col, tile_row, cells) of the base level ``zooms[0]`` and those above it, from its cells.

    ``cells`` come placed in blocks of ``span`` cells a side, by block_col and block_row, each cell once.
    A task fills one block after the other and averages it level by level, so each level is made once
    and no row is made for a cell of the levels above.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = block = None
        for frame in frames:
            places = frame[BLOCK].to_numpy()
            changes = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for first, last in zip([0, *changes], [*changes, len(frame)], strict=True):
                if first == last:
                    continue
                place = tuple(int(p) for p in places[first])
                if place != key:
                    if key is not None:
                        yield from _cut(block, *key, zooms, size)
                    key, block = place, np.full((span, span), np.nan)
                part = frame.iloc[first:last]
                block[part["row"].to_numpy() - key[1] * span, part["col"].to_numpy() - key[0] * span] = part["value"].to_numpy()
        if key is not None:
            yield from _cut(block, *key, zooms, size)

    return cells.select(*BLOCK, "col", "row", "value").sortWithinPartitions(*BLOCK).mapInPandas(run, TILES)


def coarser_levels(
    tiles: DataFrame, zooms: range, size: int, span: int
) -> DataFrame:
    """Levels ``zooms``, counting down, from the tiles of the level below, in one shuffle."""
    span = min(span, ZoomLevel(zooms[0], size).pixels)
    across = span // size

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = block = None
        half = size // 2
        for frame in frames:
            for bc, br, tc, tr, cells in zip(
                frame["block_col"], frame["block_row"],
                frame["tile_col"], frame["tile_row"], frame["cells"],
            ):
                if key != (bc, br):
                    if key is not None:
                        yield from _cut(block, *key, zooms, size)
                    key, block = (bc, br), np.full((span, span), np.nan)
                y, x = tr * half - br * span, tc * half - bc * span
                tile = np.asarray(cells, dtype=float).reshape(size, size)
                block[y : y + half, x : x + half] = _halve(tile)
        if key is not None:
            yield from _cut(block, *key, zooms, size)

    side = F.lit(2 * across)
    placed = tiles.where(F.col("zoom") == zooms[0] + 1).select(
        F.floor(F.col("tile_col") / side).cast("int").alias("block_col"),
        F.floor(F.col("tile_row") / side).cast("int").alias("block_row"),
        "tile_col", "tile_row", "cells",
    )
    ordered = placed.repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return ordered.mapInPandas(run, TILES)
