"""Zoom pyramids: each level is the mean of 2 x 2 data cells of the level below it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.operators.block_tiles import BLOCK, cell_blocks, coarser_levels
from gridcensus.operators.joins import cut_lineage
from gridcensus.operators.tiles import unpack_tiles

LEVELS_PER_SHUFFLE = 4


def block_span(tile_size: int, levels: int = LEVELS_PER_SHUFFLE) -> int:
    """Side of a block, in cells, that holds whole tiles on each of ``levels`` levels."""
    return tile_size << (levels - 1)


def place_in_blocks(cells: DataFrame, span: int, partitions: int | None = None) -> DataFrame:
    """Hash-partition cells by square blocks of ``span`` cells a side."""
    side = F.lit(span)
    keys = BLOCK if partitions is None else [partitions, *BLOCK]
    return cells.select(
        F.floor(F.col("col") / side).cast("int").alias("block_col"),
        F.floor(F.col("row") / side).cast("int").alias("block_row"),
        *[c for c in cells.columns if c not in BLOCK],
    ).repartition(*keys)


def level_steps(base_zoom: int, min_zoom: int) -> list[range]:
    """The zooms, from the base down to the least, in steps that share a shuffle."""
    tops = range(base_zoom, min_zoom - 1, -LEVELS_PER_SHUFFLE)
    return [range(top, max(top - LEVELS_PER_SHUFFLE, min_zoom - 1), -1) for top in tops]


def climb(first: DataFrame, steps: list[range], tile_size: int) -> DataFrame:
    """All levels from the tiles of the first step.

    A block holds whole tiles on each level of a step, so one shuffle serves the step, and the next
    one moves a 256th of the cells. Each step is computed once: its levels go to the checkpoint folder,
    the next step starts from the last of them there, and so do readers of the result.
    """
    span = block_span(tile_size)
    made: list[DataFrame] = []
    for step in steps:
        levels = coarser_levels(made[-1], step, tile_size, span) if made else first
        made.append(cut_lineage(levels) if step != steps[-1] else levels)
    return reduce(DataFrame.unionByName, made)


def pyramid_tiles(cells: DataFrame, base_zoom: int, min_zoom: int, tile_size: int) -> DataFrame:
    """(zoom, tile_col, tile_row, cells) of all levels from the merged cells of the base level.

    Cells that come placed in blocks of ``block_span(tile_size)`` stay there.
    """
    span, steps = block_span(tile_size), level_steps(base_zoom, min_zoom)
    placed = cells if set(BLOCK) <= set(cells.columns) else place_in_blocks(cells.select("col", "row", "value"), span)
    return climb(cell_blocks(placed, steps[0], tile_size, span), steps, tile_size)


def pyramid(base: DataFrame, base_zoom: int, min_zoom: int, tile_size: int) -> DataFrame:
    """All levels as cells (zoom, col, row, value)."""
    return unpack_tiles(pyramid_tiles(base, base_zoom, min_zoom, tile_size), tile_size)
