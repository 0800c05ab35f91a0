"""Map tiles as a table of RGBA arrays, one row per (zoom, col, row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.colors import (
    GLOBAL_BREAKS,
    MAP_COLORS,
    classify_arrays,
    tile_path,
)


def shade_tiles(
    tiles: DataFrame, output: str, colors: Sequence[int] = MAP_COLORS, breaks: Sequence[float] = GLOBAL_BREAKS
) -> DataFrame:
    """(zoom, tile_col, tile_row, path, rgba) of packed tiles (zoom, tile_col, tile_row, cells)."""
    shades = classify_arrays(colors, breaks)(F.col("cells"))
    path = tile_path(output, F.col("zoom"), F.col("tile_col"), F.col("tile_row"))
    return tiles.select("zoom", "tile_col", "tile_row", path.alias("path"), shades.alias("rgba"))


def write_map_tiles(tiles: DataFrame, output: str) -> None:
    tiles.write.partitionBy("zoom").parquet(output)
