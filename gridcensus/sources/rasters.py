"""Raster tables in Parquet: cells in long form or packed tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.values import band, nodata_to_null
from gridcensus.schemas import RASTER_CELLS, RASTER_TILES
from gridcensus.sources import catalog


def read_cells(spark: SparkSession, path: str, nodata: float | None = None) -> DataFrame:
    """Cells; ``nodata`` is the number that marks cells without data, if the raster has one."""
    cells = spark.read.schema(RASTER_CELLS).parquet(path)
    return cells.withColumn("value", nodata_to_null(F.col("value"), nodata))


def read_tiles(
    spark: SparkSession,
    path: str,
    include: Sequence[int] | None = None,
    exclude: Sequence[int] | None = None,
    window: tuple[int, int, int, int] | None = None,
    nodata: float | None = None,
) -> DataFrame:
    """Tile table of the chosen sources, within tile bounds (col0, row0, col1, row1) inclusive.

    Sources prune partitions; the window reaches the Parquet scan as pushed filters. ``nodata`` is
    the number that marks cells without data, if the raster has one.
    """
    tiles = spark.read.schema(RASTER_TILES).parquet(path)
    tiles = catalog.exclude(catalog.include(tiles, include, "src"), exclude, "src")
    if window is not None:
        tiles = within(tiles, window)
    if nodata is None:
        return tiles
    return tiles.withColumn("cells", F.transform("cells", lambda v: nodata_to_null(v, nodata)))


def within(tiles: DataFrame, window: tuple[int, int, int, int]) -> DataFrame:
    """Tiles inside inclusive bounds, as literals that prune a stored table."""
    col0, row0, col1, row1 = window
    return tiles.where(
        F.col("tile_col").between(col0, col1) & F.col("tile_row").between(row0, row1)
    )


def select_band(raster: DataFrame, index: int = 0, bands: str = "bands") -> DataFrame:
    """One band of a multi-band raster as its value column."""
    return raster.withColumn("value", band(F.col(bands), index)).drop(bands)
