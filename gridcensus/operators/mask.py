"""Cells covered by regions: spans of columns per grid row, and their joins with rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import is_data
from gridcensus.operators.joins import BROADCAST_ROWS, ROWS_PER_SLICE, join_masks, join_packed
from gridcensus.operators.regions import part_edges
from gridcensus.operators.scanline import scanline_runs


def part_spans(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, row, c0, c1): cells whose centre lies inside each part."""
    return scanline_runs(
        part_edges(parts),
        ["region_id", "part"],
        x0=grid.xmin + 0.5 * grid.cell_width, dx=grid.cell_width, n_cols=grid.cols,
        y0=grid.ymax - 0.5 * grid.cell_height, dy=grid.cell_height, n_rows=grid.rows,
    )


def region_spans(spans: DataFrame) -> DataFrame:
    """(region_id, row, c0, c1) with overlapping parts merged, so no cell comes twice."""
    line = Window.partitionBy("region_id", "row").orderBy("c0", "c1")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    opened = spans.withColumn("reach", F.max("c1").over(before)).withColumn(
        "opens", F.when(F.col("c0") <= F.col("reach"), F.lit(0)).otherwise(F.lit(1))
    )
    grouped = opened.withColumn(
        "island", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        grouped.groupBy("region_id", "row", "island")
        .agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
        .drop("island")
    )


def clip_spans(spans: DataFrame, grid: GridSpec) -> DataFrame:
    """Cut spans at tile borders and give each piece its tile_col and tile_row."""
    size = F.lit(grid.tile_size)
    cut = spans.withColumn(
        "tile_col", F.explode(F.sequence(grid.tile_of(F.col("c0")), grid.tile_of(F.col("c1"))))
    )
    return (
        cut.withColumn("tile_row", grid.tile_of(F.col("row")))
        .withColumn("c0", F.greatest(F.col("c0"), F.col("tile_col") * size))
        .withColumn("c1", F.least(F.col("c1"), (F.col("tile_col") + 1) * size - 1))
    )


def mask_cells(
    cells: DataFrame,
    tile_spans: DataFrame,
    grid: GridSpec,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Data cells (src, col, row, value) with the region of every span that covers them."""
    keyed = cells.where(is_data(F.col("value"))).withColumn("tile_col", grid.tile_of(F.col("col")))
    return join_masks(
        keyed,
        tile_spans,
        keys=["tile_col", "row"],
        spread=["src", "col"],
        condition=F.col("col").between(F.col("c0"), F.col("c1")),
        broadcast_rows=broadcast_rows,
        rows_per_slice=rows_per_slice,
        spread_tasks=True,
    ).drop("c0", "c1")


def pack_masks(tile_spans: DataFrame, grid: GridSpec) -> DataFrame:
    """One row per region and tile: ``runs`` of cells (start, length) in the tile's array.

    A tile that lies wholly inside has NULL runs, so the rows of a mask do not grow with the
    resolution: their number is that of (region, tile) pairs, and runs are kept only at borders, as
    many as the tile has rows (times the parts and hollows it holds).
    """
    size = grid.tile_size
    keys = [c for c in tile_spans.columns if c not in ("row", "c0", "c1")]
    run = F.struct(
        (grid.cell_index(F.col("c0"), F.col("row")) + 1).cast("int").alias("start"),
        (F.col("c1") - F.col("c0") + 1).cast("int").alias("length"),
    )
    packed = tile_spans.groupBy(*keys).agg(
        F.sort_array(F.collect_list(run)).alias("runs"),
        F.min(F.col("c1") - F.col("c0") + 1).alias("shortest"),
    )
    # every row of the tile once, from end to end
    starts = F.array_distinct(F.transform("runs", lambda r: r["start"]))
    full = (F.col("shortest") == size) & (F.size("runs") == size) & (F.size(starts) == size)
    return packed.select(*keys, F.when(~full, F.col("runs")).alias("runs"))


def mask_packed(tiles: DataFrame, packed: DataFrame, grid: GridSpec, **limits) -> DataFrame:
    """Data values under each region from packed tiles: a tile meets one mask row per region.

    Whole tiles give all their cells; others only the slices that their runs cover.
    """
    joined = join_packed(tiles, packed, grid, **limits)
    pieces = F.transform("runs", lambda r: F.slice("cells", r["start"], r["length"]))
    covered = F.when(F.col("runs").isNull(), F.col("cells")).otherwise(F.flatten(pieces))
    carried = [c for c in joined.columns if c not in ("cells", "runs")]
    values = joined.select(*carried, F.explode(covered).alias("value"))
    return values.where(is_data(F.col("value")))


def mask_tiles(tiles: DataFrame, tile_spans: DataFrame, grid: GridSpec, **limits) -> DataFrame:
    """The same from runs of cells cut at tile borders."""
    return mask_packed(tiles, pack_masks(tile_spans, grid), grid, **limits)


def mask_raster(raster: DataFrame, tile_spans: DataFrame, grid: GridSpec, **limits) -> DataFrame:
    """Masked values of a raster in either form; cells bring their col and row along."""
    form = mask_tiles if "cells" in raster.columns else mask_cells
    return form(raster, tile_spans, grid, **limits)
