"""Coarse-to-fine masks: whole tiles from the tiles' own scanline, runs of cells only at borders.

A tile that no edge meets is inside a part as a whole or not at all, so one even-odd test of its corner
settles it. Only the tiles that edges meet need the scanline of their rows. What is made and stored
grows with the length of the borders, not with the area times the rows of a tile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.operators.mask import part_spans
from gridcensus.operators.regions import corner_tiles, edge_tiles, part_edges

TILE = ["tile_col", "tile_row"]


def whole_tiles(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, tile_col, tile_row) of tiles inside a part that no edge meets, not even at a corner."""
    edges = part_edges(parts)
    keys = ["region_id", "part", *TILE]
    # Spark takes both for as small as the regions' files, so the join is named
    return corner_tiles(edges, grid).join(edge_tiles(edges, grid).distinct().hint("merge"), keys, "left_anti")


def border_pieces(parts: DataFrame, grid: GridSpec, spans: DataFrame, *keep: str) -> DataFrame:
    """(region_id, part, tile_col, tile_row, row, c0, c1): runs cut at tile borders, of tiles that edges meet.

    A run of a row reaches over whole tiles as well; it only meets the border tiles of its tile row,
    which are an array of a part's tile columns. ``spans`` are the runs of the parts.
    """
    size = F.lit(grid.tile_size)
    row_of_tiles = ["region_id", "part", "tile_row"]
    met = edge_tiles(part_edges(parts), grid).groupBy(*row_of_tiles).agg(F.collect_set("tile_col").alias("border"))
    keyed = spans.withColumn("tile_row", grid.tile_of(F.col("row")))
    first, last = grid.tile_of(F.col("c0")), grid.tile_of(F.col("c1"))
    crossed = F.filter("border", lambda t: t.between(first, last))
    cut = keyed.join(met.hint("merge"), row_of_tiles).select("*", F.explode(crossed).alias("tile_col"))
    return cut.select(
        "region_id", "part", *TILE, "row", *keep,
        F.greatest(F.col("c0"), F.col("tile_col") * size).alias("c0"),
        F.least(F.col("c1"), (F.col("tile_col") + 1) * size - 1).alias("c1"),
    )


def _merged(pieces: DataFrame) -> DataFrame:
    """Pieces of one region's parts with overlaps merged, tile by tile."""
    line = Window.partitionBy("region_id", *TILE, "row").orderBy("c0", "c1")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("c1").over(before)
    opens = F.when(F.col("c0") <= F.col("reach"), F.lit(0)).otherwise(F.lit(1))
    opened = pieces.withColumn("reach", reach).withColumn("opens", opens)
    island = F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    grouped = opened.withColumn("island", island).groupBy("region_id", *TILE, "row", "island")
    return grouped.agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("island")


def mask_hierarchy(parts: DataFrame, grid: GridSpec, merge_parts: bool = False) -> DataFrame:
    """(region_id, part, tile_col, tile_row, runs): the packed masks of parts.

    ``runs`` are (start, length) in the tile's array, and NULL where the tile is whole; a border tile
    without a covered cell has no row. With ``merge_parts`` a region's parts are one mask without the
    column part, in which no cell comes twice.
    """
    whole, pieces = whole_tiles(parts, grid), border_pieces(parts, grid, part_spans(parts, grid))
    keys = ["region_id", "part", *TILE]
    if merge_parts:
        keys = ["region_id", *TILE]
        whole = whole.select(*keys).distinct()
        pieces = _merged(pieces.join(whole.hint("merge"), keys, "left_anti"))
    run = F.struct(
        (grid.cell_index(F.col("c0"), F.col("row")) + 1).cast("int").alias("start"),
        (F.col("c1") - F.col("c0") + 1).cast("int").alias("length"),
    )
    border = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    none = F.lit(None).cast(border.schema["runs"].dataType)
    return border.unionByName(whole.select(*keys, none.alias("runs")))


def covered_cells(packed: DataFrame, grid: GridSpec) -> DataFrame:
    """Adds ``whole`` and ``n_covered``, the cells that a packed mask covers."""
    lengths = F.aggregate("runs", F.lit(0), lambda n, r: n + r["length"])
    whole = F.col("runs").isNull()
    cells = F.when(whole, F.lit(grid.tile_size * grid.tile_size)).otherwise(lengths)
    return packed.select("*", whole.alias("whole"), cells.alias("n_covered"))
