"""Population, density and value statistics of first-level administrative regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.functions.values import density, truncate_long
from gridcensus.operators import area, counts, mask, regions as region_ops, sketches, states, tiles as tile_ops, zonal
from gridcensus.operators.joins import cut_lineage, mask_tasks
from gridcensus.plans.inputs import cell_spans, choose, is_packed, packed_masks
from gridcensus.sinks import reports

KEYS = ["adm1_code", "adm0_a3"]
STATS = ["zmin", "zmax", "mean", "median", "mode", "stddev"]


def admin1_population(
    regions: DataFrame,
    raster: DataFrame,
    sources: DataFrame,
    grid: GridSpec,
    *,
    drop_antimeridian: bool = True,
    keep_empty: bool = False,
    exact_mode: bool = False,
    source_grid: GridSpec | None = None,
    include: Sequence[int] | DataFrame | None = None,
    exclude: Sequence[int] | DataFrame | None = None,
    partitions: int | None = None,
    **limits,
) -> DataFrame:
    """One row per (adm1_code, adm0_a3) that some source tile meets; features of one key count as one.

    regions: region_id, adm1_code, adm0_a3, geom. raster: cells or packed tiles on ``grid``, or on
    ``source_grid``, whose cell nearest to a job cell's centre then stands for it.
    sources: src, xmin, ymin, xmax, ymax. Every part of a region counts its own cells.
    Median and mode are read from the 64-bin sketch, and packed tiles are summed up as states per region
    and tile, without a row per cell. ``exact_mode`` takes both from the values instead: the raster is moved
    to stack the sources of a tile, and counts of the distinct values of each region and tile are shuffled.
    """
    raster, sources = choose(raster, sources, include, exclude, partitions)
    regions = region_ops.merge_equal_keys(regions, KEYS)

    parts = region_ops.explode_parts(regions)
    counted = region_ops.drop_antimeridian(parts) if drop_antimeridian else parts
    summary = _summary(raster, counted, grid, source_grid or grid, exact_mode, limits)

    visited = zonal.visited_regions(
        region_ops.region_tile_candidates(counted, grid), tile_ops.source_tile_keys(sources, grid)
    )
    single = regions.select("region_id", *KEYS)
    outcome = (
        single.join(visited, "region_id", "left" if keep_empty else "inner")
        .join(summary, "region_id", "left")
        .join(area.region_areas(parts), "region_id")
    )
    people = F.coalesce("population", F.lit(0.0))
    return outcome.select(
        "region_id",
        *KEYS,
        truncate_long(people).alias("population"),
        density(people, F.col("area")).alias("density"),
        density(people, F.col("area_km2")).alias("density_km2"),
        F.coalesce("n_tiles", F.lit(0)).alias("n_tiles"),
        F.coalesce("n_cells", F.lit(0)).alias("n_cells"),
        *STATS,
        "distribution",
    )


def _summary(
    raster: DataFrame, parts: DataFrame, grid: GridSpec, on: GridSpec, exact: bool, limits: dict
) -> DataFrame:
    """(region_id, population, n_cells, statistics, distribution) of the parts' cells."""
    packed = is_packed(raster)
    if exact and not packed:
        raster = raster.withColumns({"tile_col": on.tile_of(F.col("col")), "tile_row": on.tile_of(F.col("row"))})
    if packed or exact:
        raster, masks, n_bytes = packed_masks(raster, parts, grid, on, merge_parts=False)
        masks, limits = masks.drop("part"), {**limits, "mask_bytes": n_bytes}
    if exact:
        held = raster.schema["cells"].dataType.elementType if packed else raster.schema["value"].dataType
        counted = counts.tile_counts(raster, masks, on, **limits)
        summary = counts.count_statistics(counted, mask_tasks(raster.sparkSession, n_bytes))
        summary = summary.withColumns({c: F.col(c).cast(held) for c in ("zmin", "zmax", "median", "mode")})
        return summary.join(counts.count_distributions(counted, zonal.DISTRIBUTION_BINS), "region_id", "left")
    if packed:
        merged = states.merge_states(states.tile_states(raster, masks, on, zonal.DISTRIBUTION_BINS, **limits))
        return sketches.sketch_statistics(merged, wanted=("median", "mode"))
    spans = cell_spans(parts, grid, on, merge_parts=False)
    spans = cut_lineage(spans.select("region_id", "tile_col", "tile_row", "row", "c0", "c1"))
    masked = mask.mask_cells(raster, spans, on, **limits).select("region_id", "value")
    summary = masked.groupBy("region_id").agg(
        F.sum("value").alias("population"),
        F.count("value").alias("n_cells"),
        *zonal.statistics(),
        F.histogram_numeric("value", F.lit(zonal.DISTRIBUTION_BINS)).alias("distribution"),
    )
    return sketches.sketch_statistics(summary, wanted=("median", "mode"))


def write_reports(result: DataFrame, regions: DataFrame, output: str) -> None:
    """CSV, GeoJSON lines and quantile breaks. The summary is computed once for all three."""
    stable = cut_lineage(result)
    reports.write_admin_csv(stable, output)
    shapes = region_ops.merge_equal_keys(regions, KEYS).select("adm1_code", "geom")
    reports.write_admin_geojson(region_ops.attach_regions(stable, shapes), output)
    reports.write_quantile_json(stable, output)
