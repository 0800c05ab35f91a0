"""Which source cells the cells of another grid read, as runs: the raster stays as it is, packed or not.

Nearest neighbour is separable and monotone. Along an axis the distance from a cell to the source cell
that it reads changes by steps, at places that follow from the ratio of the cell sizes. A run of cells
is cut at those places, and each piece moves as a whole. Grids of one cell size have no such place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec

# A centre this close to a border between two source cells counts as on it, and takes the right one.
ON_BORDER = 1e-6


@dataclass(frozen=True)
class ReadAxis:
    """Cell ``t`` reads source cell ``floor(first + ratio * t)`` of an axis that has ``size`` cells."""

    first: float
    ratio: float
    size: int

    def source(self, t: Column) -> Column:
        return F.floor(F.lit(self.first) + F.lit(self.ratio) * t).cast("int")

    def source_of(self, t: int) -> int:
        return math.floor(self.first + self.ratio * t)

    def shift_over(self, low: int, high: int) -> int | None:
        """The one distance of all cells from ``low`` to ``high``, as distances grow or fall throughout."""
        shift = self.source_of(low) - low
        return shift if self.source_of(high) - high == shift else None

    def pieces(self, c0: Column, c1: Column) -> Column:
        """Array of (c0, c1) in source cells that cut the run [c0, c1] where its distance changes."""
        piece = lambda a, b: F.struct(self.source(a).alias("c0"), (self.source(a) + b - a).alias("c1"))
        if self.ratio == 1.0:
            return F.array(piece(c0, c1))
        if self.ratio >= 2.0:
            # every cell skips source cells, so it is a piece by itself
            return F.transform(F.sequence(c0, c1), lambda t: piece(t, t))
        sign = 1 if self.ratio > 1 else -1
        steps = lambda t: (self.source(t) - t) * sign

        def begin(step: Column) -> Column:
            """The first cell with that step or a later one: solved, then settled among its neighbours."""
            place = (step - sign * F.lit(self.first)) / F.lit(abs(self.ratio - 1.0))
            if sign < 0:
                place = (step - F.lit(1.0 - self.first)) / F.lit(1.0 - self.ratio)
            near = F.floor(place).cast("int")
            return F.when(steps(near) >= step, near).when(steps(near + 1) >= step, near + 1).otherwise(near + 2)

        def cut(step: Column) -> Column:
            return piece(F.greatest(c0, begin(step)), F.least(c1, begin(step + 1) - 1))

        return F.transform(F.sequence(steps(c0), steps(c1)), cut)


def read_axes(grid: GridSpec, source: GridSpec) -> tuple[ReadAxis, ReadAxis]:
    """How columns and rows of ``grid`` read those of ``source``."""
    wide, high = grid.cell_width / source.cell_width, grid.cell_height / source.cell_height
    return (
        ReadAxis((grid.xmin - source.xmin) / source.cell_width + 0.5 * wide + ON_BORDER, wide, source.cols),
        ReadAxis((source.ymax - grid.ymax) / source.cell_height + 0.5 * high + ON_BORDER, high, source.rows),
    )


def read_spans(spans: DataFrame, grid: GridSpec, source: GridSpec) -> DataFrame:
    """Runs (row, c0, c1) of job cells as the runs of source cells they read, within the source grid.

    A source cell that several job cells read comes as often, so sums over the runs are those over the
    resampled raster.
    """
    across, down = read_axes(grid, source)
    kept = [c for c in spans.columns if c not in ("row", "c0", "c1")]
    cut = spans.withColumn("row", down.source(F.col("row"))).where(F.col("row").between(0, source.rows - 1))
    moved = cut.select(*kept, "row", F.inline(across.pieces(F.col("c0"), F.col("c1"))))
    inside = moved.withColumns(
        {"c0": F.greatest("c0", F.lit(0)), "c1": F.least("c1", F.lit(source.cols - 1))}
    )
    return inside.where(F.col("c0") <= F.col("c1"))


def shifted_grid(grid: GridSpec, source: GridSpec, bounds: tuple[float, float, float, float]) -> GridSpec | None:
    """The job's cells numbered as the source cells they read, for shapes within (west, south, east, north).

    None where distances change between those bounds, or where the bounds reach over either grid.
    """
    west, south, east, north = bounds
    across, down = read_axes(grid, source)
    col0, col1 = (math.floor((x - grid.xmin) / grid.cell_width) for x in (west, east))
    row0, row1 = (math.floor((grid.ymax - y) / grid.cell_height) for y in (north, south))
    # shapes may touch the far borders of the grid, where the last cells are
    col1, row1 = min(col1, grid.cols - 1), min(row1, grid.rows - 1)
    if col0 < 0 or row0 < 0 or east > grid.xmax or south < grid.ymin:
        return None
    dx, dy = across.shift_over(col0, col1), down.shift_over(row0, row1)
    if dx is None or dy is None or col0 + dx < 0 or col1 + dx >= source.cols or row0 + dy < 0 or row1 + dy >= source.rows:
        return None
    xmin, ymax = grid.xmin - dx * grid.cell_width, grid.ymax + dy * grid.cell_height
    return GridSpec(
        xmin, ymax - source.rows * grid.cell_height, xmin + source.cols * grid.cell_width, ymax,
        grid.cell_width, grid.cell_height, source.tile_size,
    )
