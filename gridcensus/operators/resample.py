"""Resampling and reprojection by arithmetic on each axis.

A target grid reads its source separably: which source column a target column reads does not
depend on the row. A source cell therefore knows its targets on each axis as a range, from the
target grid's own formula, and is exploded by it; there is no table to join and none to broadcast.
Nearest neighbour then needs no shuffle, bilinear only that of its weighted sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import projections
from gridcensus.functions.grid import MERCATOR_HALF, MERCATOR_MAX_LAT, GridSpec, ZoomLevel
from gridcensus.functions.values import is_data

# Target numbers carry rounding errors far below this; the exact test follows.
SLACK = 1e-6


@dataclass(frozen=True)
class TargetAxis:
    """One axis of a target grid: its cells, their centres in source coordinates, and the way back.

    ``index`` gives the (fractional) cell whose centre lies at a coordinate.
    """

    size: int
    coordinate: Callable[[Column], Column]
    index: Callable[[Column], Column]


Axes = tuple[TargetAxis, TargetAxis]


def grid_axes(grid: GridSpec) -> Axes:
    """Axes of a target grid in the same coordinates as the source."""
    return (
        TargetAxis(
            grid.cols,
            grid.center_x,
            lambda x: (x - F.lit(grid.xmin)) / F.lit(grid.cell_width) - F.lit(0.5),
        ),
        TargetAxis(
            grid.rows,
            grid.center_y,
            lambda y: (F.lit(grid.ymax) - y) / F.lit(grid.cell_height) - F.lit(0.5),
        ),
    )


def mercator_axes(level: ZoomLevel) -> Axes:
    """Axes of a Web Mercator zoom level over a longitude and latitude source."""
    metres, half, limit = level.pixel_metres, MERCATOR_HALF, MERCATOR_MAX_LAT

    def clamped(lat: Column) -> Column:
        return F.greatest(F.lit(-limit), F.least(F.lit(limit), lat))

    return (
        TargetAxis(
            level.pixels,
            lambda t: projections.mercator_lon((t + F.lit(0.5)) * F.lit(metres) - F.lit(half)),
            lambda lon: (projections.mercator_x(lon) + F.lit(half)) / F.lit(metres) - F.lit(0.5),
        ),
        TargetAxis(
            level.pixels,
            lambda t: projections.mercator_lat(F.lit(half) - (t + F.lit(0.5)) * F.lit(metres)),
            lambda lat: (F.lit(half) - projections.mercator_y(clamped(lat))) / F.lit(metres) - F.lit(0.5),
        ),
    )


@dataclass(frozen=True)
class _Read:
    """How one target axis reads one source axis: source cell numbers grow with ``sign``."""

    axis: TargetAxis
    origin: float
    step: float
    sign: int

    def position(self, t: Column) -> Column:
        """The fractional source cell a target's centre lies at; whole numbers are cell edges."""
        return F.lit(float(self.sign)) * (self.axis.coordinate(t) - F.lit(self.origin)) / F.lit(self.step)

    def targets(self, cell: Column, reach: float) -> Column:
        """Targets whose centres may lie within ``reach`` cells of a cell's centre, as an array."""

        def index(offset: float) -> Column:
            return self.axis.index(F.lit(self.origin) + (cell + F.lit(offset)) * F.lit(self.sign * self.step))

        low = F.greatest(F.ceil(index(0.5 - reach) - F.lit(SLACK)), F.lit(0)).cast("int")
        high = F.least(F.floor(index(0.5 + reach) + F.lit(SLACK)), F.lit(self.axis.size - 1)).cast("int")
        return F.when(low <= high, F.sequence(low, high))


def _reads(axes: Axes, source: GridSpec) -> tuple[_Read, _Read]:
    cols, rows = axes
    return (
        _Read(cols, source.xmin, source.cell_width, 1),
        _Read(rows, source.ymax, source.cell_height, -1),
    )


def resample_nearest(cells: DataFrame, source: GridSpec, axes: Axes) -> DataFrame:
    """Each target cell takes the source cell its centre falls in."""
    kept = [c for c in cells.columns if c not in ("col", "row")]
    read = cells
    for read_by, name in zip(_reads(axes, source), ("col", "row"), strict=True):
        read = read.withColumn(f"to_{name}", F.explode(read_by.targets(F.col(name), 0.5)))
        read = read.where(F.floor(read_by.position(F.col(f"to_{name}"))) == F.col(name))
    return read.select(*kept, F.col("to_col").alias("col"), F.col("to_row").alias("row"))


def _weight(position: Column, cell: Column) -> Column:
    """Share that a cell has in the linear reading at a position, 0 where it is not read."""
    first = F.floor(position - 0.5)
    share = (position - 0.5) - first
    return F.when(cell == first, F.lit(1.0) - share).when(cell == first + 1, share).otherwise(F.lit(0.0))


def resample_bilinear(cells: DataFrame, source: GridSpec, axes: Axes) -> DataFrame:
    """Weighted mean of the up to four data cells around each target centre.

    Contributions combine within a task before the one shuffle, by (src, col, row).
    """
    read = cells.where(is_data(F.col("value"))).select("src", "col", "row", "value")
    for read_by, name in zip(_reads(axes, source), ("col", "row"), strict=True):
        read = read.withColumn(f"to_{name}", F.explode(read_by.targets(F.col(name), 1.0)))
        weight = _weight(read_by.position(F.col(f"to_{name}")), F.col(name))
        read = read.withColumn(f"w_{name}", weight).where(F.col(f"w_{name}") > 0)
    sent = read.select(
        "src",
        F.col("to_col").alias("col"),
        F.col("to_row").alias("row"),
        "value",
        (F.col("w_col") * F.col("w_row")).alias("w"),
    )
    return sent.groupBy("src", "col", "row").agg(
        (F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value")
    )
