"""Tiles of running sums: the sum of a run of cells is the difference of two numbers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.operators.joins import join_packed

PREFIX = "sums array<double>, counts array<int>, total double, n_data int"


def tile_arrays(column: pa.ListArray, tile_size: int) -> Iterator[np.ndarray]:
    """The tiles of a batch as square arrays, with NaN for cells without data; tiles share nothing."""
    for i in range(len(column)):
        cells = column[i].values
        values = cells.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(tile_size, tile_size)
        yield np.where(np.isfinite(values), values, np.nan)


def prefix_tiles(tiles: DataFrame, tile_size: int) -> DataFrame:
    """Packed tiles with ``sums`` and ``counts`` in place of cells, and both of the whole tile.

    Position i holds the sum and the number of the data cells from the start of its row to cell i.
    Sums start anew on each row, so a difference of two of them is as exact as a row's sum: to the last
    bit for whole numbers below 2^53, otherwise to some 1e-16 of the sum of the row. Tiles are read one
    at a time; a batch is bounded by its bytes (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    keys = [c for c in tiles.columns if c != "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, values in enumerate(tile_arrays(batch["cells"], tile_size)):
                data = np.isfinite(values)
                sums = np.cumsum(np.where(data, values, 0.0), axis=1)
                counts = np.cumsum(data, axis=1, dtype=np.int32)
                offsets = pa.array([0, sums.size], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch[k].slice(i, 1) for k in keys],
                        pa.ListArray.from_arrays(offsets, pa.array(sums.ravel())),
                        pa.ListArray.from_arrays(offsets, pa.array(counts.ravel())),
                        pa.array([float(sums[:, -1].sum())]),
                        pa.array([int(counts[:, -1].sum())], pa.int32()),
                    ],
                    [*keys, "sums", "counts", "total", "n_data"],
                )

    schema = ", ".join(f"`{k}` {tiles.schema[k].dataType.simpleString()}" for k in keys)
    return tiles.select(*keys, "cells").mapInArrow(run, f"{schema}, {PREFIX}")


def _over_runs(running: str, zero: Column, tile_size: int) -> Column:
    """Sum over the runs of the differences of running numbers."""

    def add(so_far: Column, run: Column) -> Column:
        first = run["start"] - 1
        last = F.get(running, first + run["length"] - 1)
        before = F.when(first % F.lit(tile_size) == 0, zero).otherwise(F.get(running, first - 1))
        return so_far + last - before

    return F.aggregate("runs", zero, add)


def tile_sums(prefix: DataFrame, packed: DataFrame, grid: GridSpec, **limits) -> DataFrame:
    """(mask and tile keys, population, n_cells) of every tile of a source under every mask.

    A run takes two lookups, a whole tile none, so no row is made for a cell.
    """
    joined = join_packed(prefix, packed, grid, **limits)
    whole = F.col("runs").isNull()
    size = grid.tile_size
    people = F.when(whole, F.col("total")).otherwise(_over_runs("sums", F.lit(0.0), size))
    n = F.when(whole, F.col("n_data")).otherwise(_over_runs("counts", F.lit(0), size))
    dropped = {"sums", "counts", "total", "n_data", "runs"}
    keys = [c for c in joined.columns if c not in dropped]
    return joined.select(*keys, people.alias("population"), n.cast("long").alias("n_cells"))


def zonal_sum_prefix(
    prefix: DataFrame, packed: DataFrame, grid: GridSpec, keys: Sequence[str] = ("region_id",), **limits
) -> DataFrame:
    """Population and data cells by region; a region without data cells is absent."""
    sums = tile_sums(prefix, packed, grid, **limits).where("n_cells > 0")
    return sums.groupBy(*keys).agg(F.sum("population").alias("population"), F.sum("n_cells").alias("n_cells"))
