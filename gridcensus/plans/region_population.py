"""Population of named regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import truncate_long
from gridcensus.operators import mask, prefix, regions as region_ops, states, tiles as tile_ops, zonal
from gridcensus.operators.joins import cut_lineage
from gridcensus.plans.inputs import cell_spans, choose, is_packed, packed_masks


def region_population(
    regions: DataFrame,
    raster: DataFrame,
    sources: DataFrame,
    grid: GridSpec,
    *,
    source_grid: GridSpec | None = None,
    include: Sequence[int] | DataFrame | None = None,
    exclude: Sequence[int] | DataFrame | None = None,
    partitions: int | None = None,
    **limits,
) -> DataFrame:
    """(location_name, population) of the regions some source tile meets; equal names add up.

    A cell counts once in a region however many of its parts cover it. raster: cells, packed tiles or
    tiles of running sums, on ``grid`` or on ``source_grid``. Tiles are summed without a row per cell.
    """
    raster, sources = choose(raster, sources, include, exclude, partitions)

    parts = region_ops.explode_parts(regions.select("region_id", "geom"))
    on = source_grid or grid
    if is_packed(raster):
        raster, packed, limits["mask_bytes"] = packed_masks(raster, parts, grid, on, merge_parts=True)
        if "sums" in raster.columns:
            sums = prefix.zonal_sum_prefix(raster, packed, on, **limits)
        else:
            sums = states.merge_moments(states.tile_states(raster, packed, on, bins=0, **limits))
    else:
        spans = cut_lineage(cell_spans(parts, grid, on, merge_parts=True))
        sums = zonal.zonal_sum(mask.mask_cells(raster, spans, on, **limits))
    visited = zonal.visited_regions(
        region_ops.region_tile_candidates(parts, grid), tile_ops.source_tile_keys(sources, grid)
    )
    named = (
        regions.select("region_id", "location_name")
        .join(visited, "region_id")
        .join(sums, "region_id", "left")
    )
    return (
        named.groupBy("location_name")
        .agg(F.sum(F.coalesce("population", F.lit(0.0))).alias("population"))
        .select("location_name", truncate_long(F.col("population")).alias("population"))
    )
