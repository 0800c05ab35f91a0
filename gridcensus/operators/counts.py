"""How often each value lies under a region, counted block by block, and the exact statistics of these counts.

A block is a square of small tiles, or one large tile. What it adds to a region are its distinct values and
their numbers: no row is made for a cell. The cells of all sources of a block are one stack, so a value
counts once per region and block, and many masks of a block meet the stack in one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import is_data
from gridcensus.operators.histograms import bins_array, list_sizes, merge_distributions
from gridcensus.operators.joins import BROADCAST_ROWS, ROWS_PER_SLICE, join_masks, packed_bytes
from gridcensus.operators.states import sketch_many

BLOCK = ["block_col", "block_row"]
# Cells along a block of small tiles.
BLOCK_SIDE = 32
# Cells of neighbouring sources that form one stack, and covered cells that a task counts side by side.
STACK_CELLS = 1 << 20
# Masks that meet a stack in one row.
MASKS_PER_ROW = 256


def _tiles_along(grid: GridSpec) -> int:
    return max(1, BLOCK_SIDE // grid.tile_size)


def _blocks(df: DataFrame, grid: GridSpec) -> DataFrame:
    """Adds the block of a tile, and the place in the block where the tile's cells start."""
    along, whole = _tiles_along(grid), grid.tile_size * grid.tile_size
    nth = F.pmod(F.col("tile_row"), F.lit(along)) * along + F.pmod(F.col("tile_col"), F.lit(along))
    return df.withColumns({
        "block_col": F.floor(F.col("tile_col") / along).cast("int"),
        "block_row": F.floor(F.col("tile_row") / along).cast("int"),
        "base": (nth * whole).cast("int"),
    })


def block_stacks(raster: DataFrame, grid: GridSpec) -> DataFrame:
    """(block_col, block_row, slot, idx, data): cells of a block's sources end to end, and their places in it.

    Packed tiles lie there as they are, with the place where each starts; long cells bring only those
    with data, each with its place. Sources beyond what a stack may hold go to another slot.
    """
    cells_of_block = (_tiles_along(grid) * grid.tile_size) ** 2
    slot = F.floor(F.col("src") / max(1, STACK_CELLS // cells_of_block)).alias("slot")
    if "cells" in raster.columns:
        tiles = _blocks(raster, grid).select(*BLOCK, slot, F.col("base").alias("idx"), F.col("cells").cast("array<double>").alias("data"))
        data = F.flatten(F.collect_list("data")).alias("data")
        return tiles.where("idx is not null and data is not null").groupBy(*BLOCK, "slot").agg(F.collect_list("idx").alias("idx"), data)
    tiles = {"tile_col": grid.tile_of(F.col("col")), "tile_row": grid.tile_of(F.col("row"))}
    place = (F.col("base") + grid.cell_index(F.col("col"), F.col("row"))).cast("int").alias("idx")
    cells = _blocks(raster.where(is_data(F.col("value"))).withColumns(tiles), grid)
    kept = cells.select(*BLOCK, slot, place, F.col("value").cast("double").alias("data")).where("idx is not null")
    return kept.groupBy(*BLOCK, "slot").agg(F.collect_list("idx").alias("idx"), F.collect_list("data").alias("data"))


def _mask_rows(packed: DataFrame, grid: GridSpec) -> DataFrame:
    """(block_col, block_row, masks): the runs of each region in a block, those of some regions in a row."""
    base = F.col("base")

    def run(start: Column, length: Column) -> Column:
        return F.struct((base + start).cast("int").alias("start"), length.cast("int").alias("length"))

    whole = F.array(run(F.lit(1), F.lit(grid.tile_size * grid.tile_size)))
    placed = F.when(F.col("runs").isNull(), whole).otherwise(F.transform("runs", lambda r: run(r["start"], r["length"])))
    moved = _blocks(packed, grid).select("region_id", *BLOCK, placed.alias("runs")).repartition(*BLOCK)
    regions = moved.groupBy(*BLOCK, "region_id").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    nth = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("region_id"))
    dealt = regions.withColumn("_row", F.floor((nth - 1) / MASKS_PER_ROW))
    some = dealt.groupBy(*BLOCK, "_row").agg(F.collect_list(F.struct("region_id", "runs")).alias("masks"))
    return some.drop("_row")


def _counted(idx: np.ndarray, data: np.ndarray, masks: pa.StructArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(mask, number of its values, values, counts) of a stack's masks, some masks at a time."""
    order = np.argsort(idx, kind="stable")
    idx = idx[order]
    held, code = np.unique(data[order], return_inverse=True)
    runs = masks.field(1)
    flat = runs.flatten()
    start = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64) - 1
    stop = start + flat.field(1).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(runs)), list_sizes(runs))
    first = np.searchsorted(idx, start)
    size = np.searchsorted(idx, stop) - first
    met = size > 0
    owner, first, size = owner[met], first[met], size[met]
    at, reached = 0, np.cumsum(size)
    while at < len(owner):
        # pieces of whole masks
        end = max(at + 1, int(np.searchsorted(reached, (reached[at - 1] if at else 0) + STACK_CELLS, side="right")))
        if end < len(owner):
            opened = int(np.searchsorted(owner, owner[end]))
            end = opened if opened > at else int(np.searchsorted(owner, owner[at], side="right"))
        of, local = np.unique(owner[at:end], return_inverse=True)
        n = size[at:end]
        cell = np.arange(int(n.sum())) + np.repeat(first[at:end] - (np.cumsum(n) - n), n)
        pair = np.repeat(local, n) * len(held) + code[cell]
        if len(of) * len(held) <= 4 * len(pair):
            times = np.bincount(pair, minlength=len(of) * len(held))
            pair = np.flatnonzero(times)
            times = times[pair]
        else:
            pair, times = np.unique(pair, return_counts=True)
        yield of, np.bincount(pair // len(held), minlength=len(of)), held[pair % len(held)], times
        at = end


def tile_counts(
    raster: DataFrame,
    packed: DataFrame,
    grid: GridSpec,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
    mask_bytes: int | None = None,
) -> DataFrame:
    """(region_id, data, counts): the distinct data values of a block under a region and their numbers.

    ``raster`` is packed tiles or long cells of ``grid``, ``packed`` the masks of tiles. A cell that masks cover
    several times counts as often. A row holds no more values than a stack has cells.
    """
    joined = join_masks(
        block_stacks(raster, grid),
        _mask_rows(packed, grid),
        keys=BLOCK,
        spread=["slot"],
        broadcast_rows=broadcast_rows,
        rows_per_slice=max(1, rows_per_slice // STACK_CELLS),
        mask_bytes=packed.agg(F.sum(packed_bytes(packed))).head()[0] or 0 if mask_bytes is None else mask_bytes,
        spread_tasks=True,
    )
    whole, tiled = grid.tile_size * grid.tile_size, "cells" in raster.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                idx, data, masks = (batch[k].slice(i, 1) for k in ("idx", "data", "masks"))
                data = data.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
                place = idx.flatten().to_numpy(zero_copy_only=False)
                if tiled:
                    place = np.repeat(place, whole) + np.arange(len(data)) % whole
                finite = np.isfinite(data)
                masks = masks.flatten()
                for of, n, values, times in _counted(place[finite], data[finite], masks):
                    ends = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (values, times.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([masks.field(0).take(pa.array(of)), *lists], ["region_id", "data", "counts"])

    schema = f"region_id {packed.schema['region_id'].dataType.simpleString()}, data array<double>, counts array<int>"
    return joined.select("idx", "data", "masks").mapInArrow(count, schema)


def count_statistics(counted: DataFrame, tasks: int) -> DataFrame:
    """(region_id, population, n_cells, zmin, zmax, mean, median, mode, stddev), all of them exact.

    Counts of a region meet in one of ``tasks`` tasks, which merges and sorts them and spills where
    they are many. The median is the least value that half of the cells do not exceed; the mode the most
    frequent value, the smallest on a tie.
    """
    value, n = F.col("value"), F.col("n")
    moved = counted.repartition(tasks, "region_id")
    each = moved.select("region_id", "counts", F.posexplode("data").alias("i", "value"))
    times = each.select("region_id", "value", F.get("counts", F.col("i")).cast("bigint").alias("n"))
    merged = times.groupBy("region_id", "value").agg(F.sum(n).alias("n"))
    region = Window.partitionBy("region_id")
    so_far = region.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("up_to", F.sum(n).over(so_far))
    told = ranked.withColumns({"n_cells": F.sum(n).over(region), "population": F.sum(n * value).over(region)})
    mean = F.col("population") / F.col("n_cells")
    apart = value - mean
    summary = told.groupBy("region_id").agg(
        F.max("population").alias("population"),
        F.max("n_cells").alias("n_cells"),
        F.min(value).alias("zmin"),
        F.max(value).alias("zmax"),
        F.min(F.when(2 * F.col("up_to") >= F.col("n_cells"), value)).alias("median"),
        F.max_by(value, F.struct(n, (-value).alias("low"))).alias("mode"),
        F.sum(n * apart * apart).alias("_squares"),
    )
    return summary.withColumns({"mean": mean, "stddev": F.sqrt(F.col("_squares") / F.col("n_cells"))}).drop("_squares")


def count_distributions(counted: DataFrame, bins: int) -> DataFrame:
    """(region_id, distribution): the sketch of each region's values."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = list_sizes(batch["data"])
            x, times = (batch[k].flatten().to_numpy(zero_copy_only=False) for k in ("data", "counts"))
            made = sketch_many(np.repeat(np.arange(len(n)), n), x, times, bins)
            yield pa.RecordBatch.from_arrays([batch["region_id"], bins_array(*made, len(n))], ["region_id", "distribution"])

    kind = counted.schema["region_id"].dataType.simpleString()
    sketches = counted.mapInArrow(sketch, f"region_id {kind}, distribution array<struct<x double, y double>>")
    # one row per region, which Spark then knows: where the sketch is not read, it is not made
    merged = merge_distributions(sketches, "region_id", bins=bins)
    return merged.groupBy("region_id").agg(F.first("distribution").alias("distribution"))
