"""Partial states per region, tile and source, made without a row per cell, and their refresh.

A state is what a tile adds to a region: sum, count, least and greatest value, squares and a sketch,
with a digest of the tile it came from. States merge by region. When sources change, only tiles whose
digest is another one are read again; the states of all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.operators.histograms import (
    bins_array, flat_bins, fold_runs, fold_some, grouped_bins, list_sizes, merge_bins, merge_grouped, merge_in_turn, merge_many,
)
from gridcensus.operators.joins import join_packed

TILE_OF_SOURCE = ["src", "tile_col", "tile_row"]
STATE = (
    "population double, n_cells long, zmin double, zmax double, centre double, squares double,"
    " distribution array<struct<x double, y double>>"
)
NUMBERS = ["population", "n_cells", "zmin", "zmax", "centre", "squares"]
# Values a sketch starts from; more distinct ones are first brought together in groups of one size.
FINE_BINS = 1024
# Cells of joined tiles that a task holds side by side.
STEP_CELLS = 1 << 20


def tile_digest(cells: Column) -> Column:
    """A 64-bit digest of a tile's cells; a cell without data counts as such wherever it is."""
    return F.xxhash64(cells)


def _fine_bins(x: np.ndarray, y: np.ndarray, most: int = FINE_BINS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their numbers, brought together in groups of one size where there are many."""
    if len(x) <= most:
        return x, y
    cut = np.searchsorted(np.cumsum(y), np.arange(most) * y.sum() / most, side="right")
    cut = np.unique(cut)
    total = np.add.reduceat(y, cut)
    return np.add.reduceat(x * y, cut) / total, total


def sketch_of(values: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``bins`` bins of data values."""
    x, y = np.unique(values, return_counts=True)
    return merge_bins(*_fine_bins(x, y.astype(float), max(FINE_BINS, 4 * bins)), bins)


def sketch_many(owner: np.ndarray, values: np.ndarray, times: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins (owner, x, y) of each owner's values, as ``sketch_of`` makes them."""
    owner, x, y = grouped_bins(owner, values, times.astype(float))
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
    size = np.diff(np.r_[first, len(owner)])
    most = max(FINE_BINS, 4 * bins)
    if np.any(size > most):
        fine = [_fine_bins(x[a : a + n], y[a : a + n], most) for a, n in zip(first, size, strict=True)]
        owner = np.repeat(owner[first], [len(f[0]) for f in fine])
        x, y = (np.concatenate([f[k] for f in fine]) for k in (0, 1))
        return merge_many(owner, x, y, bins)
    return merge_grouped(owner, x, y, bins)


def _covered(runs: pa.ListArray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, place, times) of the cells that runs cover, in tiles that lie end to end, by ascending tile.

    Where runs cover few of the cells, these are listed run by run, so a cell in several runs comes as
    often; otherwise all cells are counted through.
    """
    whole = runs.is_null().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    tile = np.repeat(np.arange(len(size)), np.where(whole, 1, list_sizes(runs)))
    first, length, cut = start[tile], size[tile], ~whole[tile]
    flat = runs.flatten()
    first[cut] += flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64) - 1
    length[cut] = flat.field(1).to_numpy(zero_copy_only=False)
    n = int(size.sum())
    if 2 * length.sum() < n:
        place = np.arange(int(length.sum())) + np.repeat(first - (np.cumsum(length) - length), length)
        return np.repeat(tile, length), place, np.ones(len(place), dtype=np.int64)
    # runs stay within their tile, so the place after the last tile is all that more is needed
    times = np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(first + length, minlength=n + 1))
    place = np.flatnonzero(times[:n] > 0)
    return np.repeat(np.arange(len(size)), size)[place], place, times[place]


def tile_states(tiles: DataFrame, packed: DataFrame, grid: GridSpec, bins: int = 64, **limits) -> DataFrame:
    """(mask and tile keys, state) of every tile of a source that has data under a mask.

    One row of numbers per (mask, tile, source), whatever the number of cells; without ``bins`` the
    sketch is empty. Masks may cover a cell several times, which then counts as often. Arrays are read
    a tile at a time, in batches bounded by their bytes.
    """
    # the sources of a tile come side by side for each mask, so their states can be merged as they come
    joined = join_packed(tiles, packed, grid, stream_masks=True, **limits)
    keys = [c for c in joined.columns if c not in ("cells", "runs")]

    names = [*NUMBERS, "distribution"]

    def states(step: pa.RecordBatch) -> pa.RecordBatch:
        size = list_sizes(step["cells"])
        owner, place, times = _covered(step["runs"], size)
        values = step["cells"].flatten().to_numpy(zero_copy_only=False)[place].astype(float, copy=False)
        data = np.flatnonzero(np.isfinite(values))
        owner, values, times = owner[data], values[data], times[data]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
        of = owner[first]
        owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(owner)]))
        add = lambda numbers: np.add.reduceat(numbers, first) if len(first) else numbers
        total, n = add(values * times), add(times)
        mean = total / n
        x_y = sketch_many(owner, values, times, bins) if bins else (owner[:0], values[:0], values[:0])
        arrays = [
            pa.array(total), pa.array(n, pa.int64()),
            pa.array(np.minimum.reduceat(values, first) if len(first) else values),
            pa.array(np.maximum.reduceat(values, first) if len(first) else values),
            pa.array(mean), pa.array(add(times * np.square(values - mean[owner]))), bins_array(*x_y, len(first)),
        ]
        rows = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays([*[step[k].take(rows) for k in keys], *arrays], [*keys, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # tiles are of one size
            rows = max(1, STEP_CELLS // max(1, int(list_sizes(batch["cells"]).max(initial=0))))
            for at in range(0, batch.num_rows, rows):
                yield states(batch.slice(at, rows))

    schema = ", ".join(f"`{k}` {joined.schema[k].dataType.simpleString()}" for k in keys)
    return joined.select(*keys, "cells", "runs").mapInArrow(run, f"{schema}, {STATE}")


def stored_states(tiles: DataFrame, packed: DataFrame, grid: GridSpec, bins: int = 64, **limits) -> DataFrame:
    """States with the digest of their tile, to be stored and refreshed later."""
    return tile_states(tiles.withColumn("digest", tile_digest(F.col("cells"))), packed, grid, bins, **limits)


def merge_moments(states: DataFrame, keys: Sequence[str] = ("region_id",)) -> DataFrame:
    """(keys, population, n_cells, zmin, zmax, mean, stddev): all that merges exactly.

    A state keeps its squares around its own mean; the spread of those means, weighed by their cells,
    comes on top.
    """
    n = F.col("n_cells")
    moments = states.groupBy(*keys).agg(
        F.sum("population").alias("population"),
        F.sum(n).alias("n_cells"),
        F.min("zmin").alias("zmin"),
        F.max("zmax").alias("zmax"),
        F.sum("squares").alias("_inside"),
        F.sum(n * F.col("centre")).alias("_first"),
        F.sum(n * F.col("centre") * F.col("centre")).alias("_second"),
    )
    mean = F.col("population") / n
    between = F.greatest(F.col("_second") / n - F.pow(F.col("_first") / n, F.lit(2.0)), F.lit(0.0))
    added = {"mean": mean, "stddev": F.sqrt(F.col("_inside") / n + between)}
    return moments.withColumns(added).drop("_inside", "_first", "_second")


def merge_states(states: DataFrame, key: str = "region_id", bins: int = 64) -> DataFrame:
    """(key, population, n_cells, zmin, zmax, mean, stddev, distribution) of each key, in one pass.

    Every task first merges the states that it made, some at a time as they come and then by sorting what
    is left, so the shuffle carries one state per task and key, however many states a key has. The final
    tasks do the same with theirs, a batch at a time.
    """

    def fold(batch: pa.RecordBatch, owner: np.ndarray) -> list[pa.Array]:
        population, n, low, high, centre, squares = (batch[c].to_numpy(zero_copy_only=False) for c in NUMBERS)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        cells = np.add.reduceat(n, first)
        mean = np.add.reduceat(n * centre, first) / cells
        inside = np.add.reduceat(squares + n * np.square(centre - mean[owner]), first)
        sketch = batch["distribution"]
        merged = merge_in_turn(owner, list_sizes(sketch), *flat_bins(sketch), bins)
        numbers = [np.add.reduceat(population, first), cells, np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), mean, inside]
        return [*map(pa.array, numbers), bins_array(*merged, len(first))]

    schema = f"`{key}` {states.schema[key].dataType.simpleString()}, {STATE}"
    flat = states.select(key, *NUMBERS, "distribution")
    merge = fold_runs([key], fold)
    some = flat.mapInArrow(fold_some([key], fold), schema)
    local = some.sortWithinPartitions(key).mapInArrow(merge, schema)
    merged = local.repartition(key).sortWithinPartitions(key).mapInArrow(merge, schema)
    return merged.select(
        key, "population", "n_cells", "zmin", "zmax",
        (F.col("population") / F.col("n_cells")).alias("mean"),
        F.sqrt(F.col("squares") / F.col("n_cells")).alias("stddev"),
        "distribution",
    )


def refresh_states(
    states: DataFrame,
    updated: DataFrame,
    packed: DataFrame,
    grid: GridSpec,
    removed: DataFrame | None = None,
    bins: int = 64,
    **limits,
) -> DataFrame:
    """Stored states after an update: ``updated`` holds new or changed tiles, ``removed`` keys of tiles that went.

    Updated tiles whose digest is the stored one are left alone; the others replace the states of
    their (src, tile). No other tile is read.
    """
    stamped = updated.withColumn("digest", tile_digest(F.col("cells")))
    known = states.select(*TILE_OF_SOURCE, "digest").distinct()
    changed = stamped.join(known, [*TILE_OF_SOURCE, "digest"], "left_anti")
    gone = changed.select(*TILE_OF_SOURCE)
    if removed is not None:
        gone = gone.unionByName(removed.select(*TILE_OF_SOURCE))
    kept = states.join(gone.distinct(), TILE_OF_SOURCE, "left_anti")
    return kept.unionByName(tile_states(changed, packed, grid, bins, **limits).select(*states.columns))
