"""Packed tiles: enumeration, packing, unpacking, pairing, balance and storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import is_data
from gridcensus.operators.joins import broadcast_if_small, join_masks


def source_tile_keys(sources: DataFrame, grid: GridSpec) -> DataFrame:
    """(src, tile_col, tile_row) for every tile a source extent overlaps with positive area.

    ``sources`` has src, xmin, ymin, xmax, ymax.
    """
    west = F.floor((F.col("xmin") - F.lit(grid.xmin)) / F.lit(grid.tile_width))
    east = F.ceil((F.col("xmax") - F.lit(grid.xmin)) / F.lit(grid.tile_width)) - 1
    north = F.floor((F.lit(grid.ymax) - F.col("ymax")) / F.lit(grid.tile_height))
    south = F.ceil((F.lit(grid.ymax) - F.col("ymin")) / F.lit(grid.tile_height)) - 1

    def keys(first: Column, last: Column, size: int) -> Column:
        low = F.greatest(first.cast("int"), F.lit(0))
        high = F.least(last.cast("int"), F.lit(size - 1))
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    cols = sources.withColumn("tile_col", keys(west, east, grid.layout_cols))
    return cols.withColumn("tile_row", keys(north, south, grid.layout_rows)).select(
        "src", "tile_col", "tile_row"
    )


def source_extents(cells: DataFrame, grid: GridSpec) -> DataFrame:
    """Extent of the cells of each source: src, xmin, ymin, xmax, ymax."""
    width, height = F.lit(grid.cell_width), F.lit(grid.cell_height)
    return cells.groupBy("src").agg(
        (F.lit(grid.xmin) + F.min("col") * width).alias("xmin"),
        (F.lit(grid.ymax) - (F.max("row") + 1) * height).alias("ymin"),
        (F.lit(grid.xmin) + (F.max("col") + 1) * width).alias("xmax"),
        (F.lit(grid.ymax) - F.min("row") * height).alias("ymax"),
    )


def dense_array(entries: Column, length: int, empty: Column) -> Column:
    """Array of ``length`` elements from (idx, v) entries sorted by idx, gaps filled with ``empty``.

    Linear in ``length``: each entry brings the gap before it. Repeated positions are an error.
    """

    def with_gap(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(entries, i - 1)["idx"]).otherwise(F.lit(-1))
        gap = F.array_repeat(empty, (entry["idx"] - before - 1).cast("int"))
        return F.concat(gap, F.array(entry["v"]))

    last = F.element_at(entries, -1)["idx"]
    tail = F.array_repeat(empty, (F.lit(length) - 1 - last).cast("int"))
    filled = F.concat(F.flatten(F.transform(entries, with_gap)), tail)
    return F.when(F.size(filled) == length, filled).otherwise(
        F.raise_error(F.lit("a tile holds a cell twice"))
    )


def pack_tiles(
    cells: DataFrame,
    grid_tile_size: int,
    keys: Sequence[str] = ("src",),
    value: str = "value",
    empty: Column | None = None,
    into: str = "cells",
) -> DataFrame:
    """Row-major arrays of tile_size^2 cells per (keys, tile_col, tile_row).

    A group is one tile, so its size is bounded by the tile size whatever the data.
    """
    size = F.lit(grid_tile_size)
    placed = cells.select(
        *keys,
        F.floor(F.col("col") / size).cast("int").alias("tile_col"),
        F.floor(F.col("row") / size).cast("int").alias("tile_row"),
        (F.pmod(F.col("row"), size) * size + F.pmod(F.col("col"), size)).cast("int").alias("idx"),
        F.col(value).alias("v"),
    )
    grouped = placed.groupBy(*keys, "tile_col", "tile_row").agg(
        F.sort_array(F.collect_list(F.struct("idx", "v"))).alias("entries")
    )
    empty = F.lit(None).cast("double") if empty is None else empty
    dense = dense_array(F.col("entries"), grid_tile_size * grid_tile_size, empty)
    return grouped.select(*keys, "tile_col", "tile_row", dense.alias(into))


def unpack_tiles(tiles: DataFrame, tile_size: int, keep_nodata: bool = False) -> DataFrame:
    """Cells (keys, col, row, value) of packed tiles."""
    size = F.lit(tile_size)
    keys = [c for c in tiles.columns if c not in ("tile_col", "tile_row", "cells")]
    flat = tiles.select(*keys, "tile_col", "tile_row", F.posexplode("cells").alias("idx", "value"))
    if not keep_nodata:
        flat = flat.where(is_data(F.col("value")))
    return flat.select(
        *keys,
        (F.col("tile_col") * size + F.pmod(F.col("idx"), size)).cast("int").alias("col"),
        (F.col("tile_row") * size + F.floor(F.col("idx") / size)).cast("int").alias("row"),
        "value",
    )


def pair_tiles(source_keys: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tiles of the sources by enumerated key; both sides are unique on the join key.

    A table of keys that is small enough, as measured, is broadcast, so the tiles are not moved.
    """
    return tiles.join(broadcast_if_small(source_keys), ["src", "tile_col", "tile_row"])


def scan_windows(tiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only the tiles at wanted (tile_col, tile_row) keys."""
    keys = ["tile_col", "tile_row"]
    return join_masks(tiles, wanted.select(*keys).distinct(), keys, spread=["src"])


def rebalance(raster: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread work evenly by place and source, so a crowded tile key is not one task."""
    place = ["tile_col", "tile_row"] if "tile_col" in raster.columns else ["col", "row"]
    keys = [F.col(c) for c in (*place, "src")]
    return raster.repartition(*keys) if partitions is None else raster.repartition(partitions, *keys)


# Cells one Parquet row group may hold. The vectorised reader fills a batch from one group, and
# tiles of mostly no data would otherwise crowd into groups that decode to many gigabytes.
CELLS_PER_GROUP = 16 << 20
GROUP_ROWS = "parquet.block.row.count.limit"


def group_rows(tile_size: int) -> int:
    return max(1, CELLS_PER_GROUP // (tile_size * tile_size))


def save_tiles(tiles: DataFrame, path: str, tile_size: int) -> None:
    """Tile table partitioned by source and ordered by tile key, for pruned window reads.

    Neighbouring tiles share a file; a large source spreads over many.
    """
    (
        tiles.repartition("src", F.floor(F.col("tile_row") / 16), F.floor(F.col("tile_col") / 16))
        .sortWithinPartitions("src", "tile_row", "tile_col")
        .write.partitionBy("src")
        .option(GROUP_ROWS, group_rows(tile_size))
        .parquet(path)
    )


def save_bucketed_tiles(tiles: DataFrame, table: str, tile_size: int, buckets: int) -> None:
    """Tile table bucketed by tile key: mask joins then move the masks only."""
    (
        tiles.repartition(buckets, "tile_col", "tile_row")
        .write.bucketBy(buckets, "tile_col", "tile_row")
        .sortBy("tile_col", "tile_row")
        .option(GROUP_ROWS, group_rows(tile_size))
        .saveAsTable(table)
    )
