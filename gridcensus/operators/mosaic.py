"""One layer from overlapping sources: the lowest source with data wins each cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import is_data
from gridcensus.operators.joins import broadcast_if_small, cut_lineage

TILE_KEY = ["tile_col", "tile_row"]
# Fixed value: bytes of one cell in a packed tile.
CELL_BYTES = 8


def mosaic_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """(keys, col, row, value) from cells of many sources."""
    return (
        cells.where(is_data(F.col("value")))
        .groupBy(*keys, "col", "row")
        .agg(F.min_by("value", "src").alias("value"))
    )


def _fold_sources(tiles: DataFrame) -> DataFrame:
    """Tiles of several sources merged as arrays: a key's tiles come by source and fill what is still empty.

    A task sorts its tiles and keeps one merged tile, however many sources meet on a key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, merged = None, None

        def done() -> pa.RecordBatch:
            cells = pa.array(merged, from_pandas=True)
            packed = pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)
            return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int32()) for k in key], packed], [*TILE_KEY, "cells"])

        for batch in batches:
            places = zip(*[batch[k].to_pylist() for k in TILE_KEY], strict=True)
            for i, place in enumerate(places):
                cells = batch["cells"][i].values.to_numpy(zero_copy_only=False).astype(float)
                if place != key:
                    if key is not None:
                        yield done()
                    key, merged = place, np.where(np.isfinite(cells), cells, np.nan)
                else:
                    merged = np.where(np.isnan(merged) & np.isfinite(cells), cells, merged)
        if key is not None:
            yield done()

    ordered = tiles.select(*TILE_KEY, "src", "cells").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "src")
    return ordered.mapInArrow(run, "tile_col int, tile_row int, cells array<double>")


def mosaic_tiles(tiles: DataFrame, grid: GridSpec) -> DataFrame:
    """(tile_col, tile_row, cells) from packed tiles.

    Only tiles that several sources share are moved and merged, as arrays; all others pass through as
    they are. The shared keys are found once, from the key columns alone, and kept.
    """
    counted = tiles.groupBy(*TILE_KEY).agg(F.count(F.lit(1)).alias("n"))
    shared = broadcast_if_small(cut_lineage(counted.where(F.col("n") > 1).select(*TILE_KEY)))
    alone = tiles.join(shared, TILE_KEY, "left_anti").select(*TILE_KEY, "cells")
    return alone.unionByName(_fold_sources(tiles.join(shared, TILE_KEY, "left_semi")))


def layer_summary(cells: DataFrame, grid: GridSpec, partition_bytes: int = 128 << 20) -> DataFrame:
    """One row of layer metadata: extent, key bounds, sources, totals and a partition estimate."""
    bounds = cells.agg(
        F.count_distinct("src").alias("n_sources"),
        F.count(F.lit(1)).alias("n_cells"),
        F.count(F.when(is_data(F.col("value")), 1)).alias("n_data"),
        F.sum(F.when(is_data(F.col("value")), F.col("value"))).alias("total"),
        F.min("col").alias("min_col"), F.max("col").alias("max_col"),
        F.min("row").alias("min_row"), F.max("row").alias("max_row"),
    )
    width, height = F.lit(grid.cell_width), F.lit(grid.cell_height)
    return bounds.select(
        "n_sources", "n_cells", "n_data", "total",
        (F.lit(grid.xmin) + F.col("min_col") * width).alias("xmin"),
        (F.lit(grid.ymax) - (F.col("max_row") + 1) * height).alias("ymin"),
        (F.lit(grid.xmin) + (F.col("max_col") + 1) * width).alias("xmax"),
        (F.lit(grid.ymax) - F.col("min_row") * height).alias("ymax"),
        grid.tile_of(F.col("min_col")).alias("min_tile_col"),
        grid.tile_of(F.col("max_col")).alias("max_tile_col"),
        grid.tile_of(F.col("min_row")).alias("min_tile_row"),
        grid.tile_of(F.col("max_row")).alias("max_tile_row"),
        F.ceil(F.col("n_cells") * F.lit(CELL_BYTES) / F.lit(partition_bytes))
        .cast("bigint")
        .alias("n_partitions"),
    )
