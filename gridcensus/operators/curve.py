"""Tile keys along a Z-order curve: key ranges for scans, and partitions of equal work.

A key interleaves the bits of tile column and row, so every square of the quadtree is one range of
keys. Stored tiles are grouped by squares of 16 x 16 tiles; the tiles that regions need become a few
ranges, which prune whole squares before a file is opened and row groups within the files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.operators.tiles import GROUP_ROWS, group_rows
from gridcensus.schemas import RASTER_TILES

# Bits of a key within one square of 16 x 16 tiles.
SQUARE_BITS = 8
#: Spreads the 16 bits of a tile number over every other bit, by halves.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))
MOST_RANGES = 64

Range = tuple[int, int]


def curve_key(tile_col: Column, tile_row: Column) -> Column:
    """The key of a tile; columns and rows up to 65,535."""

    def spread(number: Column) -> Column:
        bits = number.cast("long")
        for by, mask in _SPREAD:
            bits = bits.bitwiseOR(F.shiftleft(bits, by)).bitwiseAND(F.lit(mask))
        return bits

    return spread(tile_col).bitwiseOR(F.shiftleft(spread(tile_row), 1))


def key_ranges(wanted: DataFrame, most: int = MOST_RANGES) -> list[Range]:
    """At most ``most`` inclusive key ranges that hold all wanted (tile_col, tile_row).

    The driver gets the least and greatest key of every wanted square, of which a grid of 844 x 422
    tiles has 1,431, joins neighbours and closes the smallest gaps until few enough are left.
    """
    keys = wanted.select(curve_key(F.col("tile_col"), F.col("tile_row")).alias("key"))
    squares = keys.groupBy(F.shiftright("key", SQUARE_BITS).alias("square")).agg(F.min("key"), F.max("key"))
    ends = sorted((low, high) for _, low, high in squares.collect())
    gaps = sorted((b[0] - a[1], i) for i, (a, b) in enumerate(zip(ends, ends[1:])))
    wide = {i for gap, i in gaps[max(0, len(gaps) - most + 1) :] if gap > 1}
    ranges: list[Range] = []
    for i, (low, high) in enumerate(ends):
        if ranges and i - 1 not in wide:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    return ranges


def within_ranges(key: Column, ranges: Sequence[Range]) -> Column:
    parts = [key.between(low, high) for low, high in ranges]
    return reduce(Column.__or__, parts) if parts else F.lit(False)


def save_curve_tiles(tiles: DataFrame, path: str, tile_size: int) -> None:
    """Tile table in folders of squares, ordered by key and source within its files."""
    keyed = tiles.withColumn("key", curve_key(F.col("tile_col"), F.col("tile_row")))
    squares = keyed.withColumn("square", F.shiftright("key", SQUARE_BITS))
    (
        squares.repartition("square", F.shiftright("key", SQUARE_BITS // 2))
        .sortWithinPartitions("square", "key", "src")
        .write.partitionBy("square")
        .option(GROUP_ROWS, group_rows(tile_size))
        .parquet(path)
    )


def read_curve_tiles(spark: SparkSession, path: str, ranges: Sequence[Range] | None = None) -> DataFrame:
    """Tiles of a table saved along the curve, within key ranges.

    The squares of the ranges choose folders, so files between two far ranges are not opened; the
    ranges themselves reach the scan as pushed filters.
    """
    schema = RASTER_TILES.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", ")
    stored = spark.read.schema(f"{schema}, key long, square long").parquet(path)
    if ranges is not None:
        squares = sorted({(low >> SQUARE_BITS, high >> SQUARE_BITS) for low, high in ranges})
        stored = stored.where(within_ranges(F.col("square"), squares)).where(within_ranges(F.col("key"), ranges))
    return stored.select(*RASTER_TILES.fieldNames())


def balance_along_curve(tiles: DataFrame, weights: DataFrame, partitions: int) -> DataFrame:
    """Tiles in ``partitions`` stretches of the curve that hold about equal weight.

    ``weights`` has tile_col, tile_row and weight, such as the cells that masks cover. Stretches end
    between squares, of which the driver gets the sums; a square heavier than a partition is cut at
    its quarters, and again, as far as it has tiles.
    """
    keyed = weights.select(curve_key(F.col("tile_col"), F.col("tile_row")).alias("key"), "weight")
    total = keyed.agg(F.sum("weight")).head()[0] or 0
    share = total / partitions
    bits, cuts = SQUARE_BITS, []
    blocks = keyed.groupBy(F.shiftright("key", bits).alias("block")).agg(F.sum("weight").alias("weight")).collect()
    blocks = {(row["block"] << bits, bits): row["weight"] for row in blocks}
    while bits > 0 and any(w > share for (_, b), w in blocks.items() if b == bits):
        heavy = [low for (low, b), w in blocks.items() if b == bits and w > share]
        finer = keyed.where(F.shiftleft(F.shiftright("key", bits), bits).isin(heavy))
        finer = finer.groupBy(F.shiftright("key", bits - 2).alias("block")).agg(F.sum("weight").alias("weight")).collect()
        blocks = {at: w for at, w in blocks.items() if at[0] not in heavy or at[1] != bits}
        bits -= 2
        blocks |= {(row["block"] << bits, bits): row["weight"] for row in finer}
    upto = 0.0
    for (low, _), weight in sorted(blocks.items()):
        if upto >= share * (len(cuts) + 1) and len(cuts) + 1 < partitions:
            cuts.append(low)
        upto += weight
    key = curve_key(F.col("tile_col"), F.col("tile_row"))
    place = reduce(lambda n, cut: n + F.when(key >= cut, 1).otherwise(0), cuts, F.lit(0))
    return tiles.repartitionById(partitions, place.cast("int"))
