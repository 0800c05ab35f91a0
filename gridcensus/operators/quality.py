"""Checks that grids align and that a layout is consistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec, layout_columns

# Fixed value: tolerated misalignment as a share of a cell.
TOLERANCE = 0.01


def off_grid(distance: Column, cell: Column) -> Column:
    """How far a distance lies from a whole number of cells, as a share of a cell (0 to 0.5)."""
    share = F.pmod(distance / cell, F.lit(1.0))
    return F.least(share, 1 - share)


def check_alignment(grids: DataFrame, reference: GridSpec) -> DataFrame:
    """Whether each grid's cells coincide with the reference's, within one percent of a cell.

    ``grids`` has xmin, ymin, cell_width and cell_height. Two grids coincide when their cells are of
    one size and their origins are a whole number of cells apart; ``x_offset`` and ``y_offset`` say
    by what share of a cell they miss that.
    """
    tests = {}
    for axis, origin, size in (("x", "xmin", "cell_width"), ("y", "ymin", "cell_height")):
        cell = F.lit(getattr(reference, size))
        missed = off_grid(F.col(origin) - F.lit(getattr(reference, origin)), F.col(size))
        tests[f"{axis}_size_ok"] = F.abs(F.col(size) / cell - 1) <= F.lit(TOLERANCE)
        tests[f"{axis}_aligned"] = missed <= F.lit(TOLERANCE)
        tests[f"{axis}_offset"] = missed
    passed = [tests[f"{axis}_{test}"] for axis in "xy" for test in ("size_ok", "aligned")]
    return grids.select(
        "*",
        *[test.alias(name) for name, test in tests.items()],
        (passed[0] & passed[1] & passed[2] & passed[3]).alias("aligned"),
    )


def derive_layouts(grids: DataFrame) -> DataFrame:
    """Adds the layout's counts to grids with an extent, cell size and tile_size."""
    names = ("xmin", "ymin", "xmax", "ymax", "cell_width", "cell_height", "tile_size")
    counts = layout_columns(*[F.col(name) for name in names])
    return grids.select("*", *[count.alias(name) for name, count in counts.items()])


def check_layouts(declared: DataFrame) -> DataFrame:
    """Whether declared layouts are what their grids call for.

    ``declared`` has the grid's extent, cell size and tile_size and, as declared by whoever made the
    layout, layout_cols and layout_rows (tiles), cols and rows (cells) and the layout's own extent
    layout_xmax and layout_ymin. Everything is compared with what the grid gives.
    """
    names = ("xmin", "ymin", "xmax", "ymax", "cell_width", "cell_height", "tile_size")
    due = layout_columns(*[F.col(name) for name in names])
    width = (F.col("layout_xmax") - F.col("xmin")) / F.col("cols")
    height = (F.col("ymax") - F.col("layout_ymin")) / F.col("rows")

    def close(measured: Column, cell: Column) -> Column:
        return F.abs(measured / cell - 1) <= F.lit(1e-9)

    return declared.select(
        "*",
        ((F.col("layout_cols") == due["layout_cols"]) & (F.col("layout_rows") == due["layout_rows"])).alias("tiles_ok"),
        ((F.col("cols") == due["cols"]) & (F.col("rows") == due["rows"])).alias("cells_ok"),
        F.coalesce(close(width, F.col("cell_width")), F.lit(False)).alias("cell_width_ok"),
        F.coalesce(close(height, F.col("cell_height")), F.lit(False)).alias("cell_height_ok"),
    )
