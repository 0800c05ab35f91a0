"""Covered shares of cells: each border cell counts by the part of its area that a region covers.

Every edge adds, to the cells of a row that it crosses, its signed height and the signed area to its
right within the cell. The heights summed along the row, plus the area of the cell itself, are the
cell's covered share; between two crossed cells the share stays the same, so it is one run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions import geometry
from gridcensus.functions.grid import GridSpec
from gridcensus.operators.hierarchy import TILE, border_pieces, whole_tiles
from gridcensus.operators.joins import join_packed

# Shares closer than this to nothing or to a whole cell are rounding errors of the sums.
SLACK = 1e-9


def _signed_edges(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """Edges in cells from the grid's upper left corner; ``side`` makes shells count for and holes against."""
    rings = parts.select("region_id", "part", F.posexplode("rings").alias("ring", "pts"))
    side = F.when(F.col("ring") == 0, 1.0).otherwise(-1.0) * geometry.ring_turn(F.col("pts"))
    edges = rings.select("region_id", "part", side.alias("side"), F.inline(geometry.ring_edges(F.col("pts"))))
    west, north = F.lit(grid.xmin), F.lit(grid.ymax)
    width, height = F.lit(grid.cell_width), F.lit(grid.cell_height)
    return edges.where("y1 <> y2").select(
        "region_id", "part", "side",
        ((F.col("x1") - west) / width).alias("x1"), ((north - F.col("y1")) / height).alias("y1"),
        ((F.col("x2") - west) / width).alias("x2"), ((north - F.col("y2")) / height).alias("y2"),
    )


def _crossed_cells(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, row, col, height, area) of every cell that an edge crosses, summed."""
    rows = _signed_edges(parts, grid).selectExpr(
        "*",
        "greatest(0, int(floor(least(y1, y2)))) as r0",
        f"least({grid.rows - 1}, int(ceil(greatest(y1, y2))) - 1) as r1",
    )
    cut = rows.where("r0 <= r1").selectExpr("*", "explode(sequence(r0, r1)) as row")
    ends = cut.selectExpr(
        "*",
        "greatest(least(y1, y2), double(row)) as top",
        "least(greatest(y1, y2), double(row + 1)) as bottom",
        "(x2 - x1) / (y2 - y1) as slope",
    ).where("top < bottom")
    # a rounded end may not leave the edge's own interval
    spanned = ends.selectExpr(
        "region_id", "part", "row",
        "side * signum(y2 - y1) * (bottom - top) as height",
        "greatest(least(x1, x2), least(x1 + (top - y1) * slope, x1 + (bottom - y1) * slope)) as xa",
        "least(greatest(x1, x2), greatest(x1 + (top - y1) * slope, x1 + (bottom - y1) * slope)) as xb",
    )
    # all that lies left of the grid is one piece, which covers the first cell and those after it
    pieces = spanned.where(f"xa < {grid.cols}").selectExpr(
        "*", f"explode(sequence(greatest(-1, int(floor(xa))), greatest(-1, least({grid.cols - 1}, int(floor(xb)))))) as k"
    )
    shared = pieces.selectExpr(
        "region_id", "part", "row", "k",
        "case when k < 0 then xa else greatest(xa, double(k)) end as a",
        "case when k < 0 then least(xb, 0D) else least(xb, double(k + 1)) end as b",
        "height", "xb - xa as across",
    )
    entries = shared.selectExpr(
        "region_id", "part", "row", "greatest(k, 0) as col",
        "case when across > 0 then height * (b - a) / across else height end as height",
        "case when k < 0 then 1D else k + 1 - (a + b) / 2 end as right",
    )
    return entries.groupBy("region_id", "part", "row", "col").agg(
        F.sum("height").alias("height"), F.sum(F.col("height") * F.col("right")).alias("area")
    )


def share_spans(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, row, c0, c1, share): runs of cells of one covered share, above 0 and up to 1."""
    line = Window.partitionBy("region_id", "part", "row").orderBy("col")
    before = F.coalesce(F.sum("height").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    following = F.coalesce(F.lead("col").over(line), F.lit(grid.cols))
    cells = _crossed_cells(parts, grid).select("*", before.alias("before"), following.alias("following"))
    own = F.struct(F.col("col").alias("c0"), F.col("col").alias("c1"), (F.col("before") + F.col("area")).alias("share"))
    after = F.struct(
        (F.col("col") + 1).alias("c0"), (F.col("following") - 1).alias("c1"), (F.col("before") + F.col("height")).alias("share")
    )
    runs = cells.select("region_id", "part", "row", F.inline(F.array(own, after)))
    share = F.when(F.col("share") > 1 - SLACK, F.lit(1.0)).otherwise(F.col("share"))
    return runs.where((F.col("c0") <= F.col("c1")) & (F.col("share") > SLACK)).withColumn("share", share)


def mask_shares(parts: DataFrame, grid: GridSpec) -> DataFrame:
    """(region_id, part, tile_col, tile_row, runs) with (start, length, share) runs, NULL for whole tiles."""
    keys = ["region_id", "part", *TILE]
    pieces = border_pieces(parts, grid, share_spans(parts, grid), "share")
    run = F.struct(
        (grid.cell_index(F.col("c0"), F.col("row")) + 1).cast("int").alias("start"),
        (F.col("c1") - F.col("c0") + 1).cast("int").alias("length"),
        "share",
    )
    border = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    none = F.lit(None).cast(border.schema["runs"].dataType)
    return border.unionByName(whole_tiles(parts, grid).select(*keys, none.alias("runs")))


def zonal_sum_shares(
    prefix: DataFrame, packed: DataFrame, grid: GridSpec, keys: Sequence[str] = ("region_id",), **limits
) -> DataFrame:
    """(keys, population, covered) from tiles of running sums: each cell's value by its covered share.

    ``covered`` adds up the shares of the data cells. Parts count one by one, as in the Admin-1 job.
    """
    joined = join_packed(prefix, packed, grid, **limits)
    size = F.lit(grid.tile_size)

    def weighted(running: str):
        def add(so_far, run):
            first = run["start"] - 1
            last = F.get(running, first + run["length"] - 1)
            before = F.when(first % size == 0, F.lit(0.0)).otherwise(F.get(running, first - 1))
            return so_far + run["share"] * (last - before)

        return F.aggregate("runs", F.lit(0.0), add)

    whole = F.col("runs").isNull()
    people = F.when(whole, F.col("total")).otherwise(weighted("sums"))
    covered = F.when(whole, F.col("n_data").cast("double")).otherwise(weighted("counts"))
    sums = joined.select(*keys, people.alias("population"), covered.alias("covered")).where("covered > 0")
    return sums.groupBy(*keys).agg(F.sum("population").alias("population"), F.sum("covered").alias("covered"))
