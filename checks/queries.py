"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import GRID
from gridcensus.functions import colors, projections, values
from gridcensus.functions.grid import GridSpec, zoom_tile
from gridcensus.operators import (
    area,
    curve,
    families,
    hierarchy,
    histograms,
    mask,
    mosaic as mosaic_ops,
    prefix,
    pyramid as pyramid_ops,
    quality,
    regions as region_ops,
    resample,
    shares,
    sketches,
    states,
    tiles as tile_ops,
    zonal,
)
from gridcensus.operators.joins import BROADCAST_ROWS, cut_lineage, shared_folder
from gridcensus.plans import admin_population, region_population as named, render_pyramid as render, render_refresh as again
from gridcensus.schemas import ADMIN1_PROPERTIES
from gridcensus.sinks.map_tiles import shade_tiles
from gridcensus.sinks import reports
from gridcensus.sources import catalog, geojson, rasters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE = "store/rasters"
OUTPUT = "out"
# target grid of the resampling queries: coarser, and off the source grid by half a cell
COARSE = GridSpec(-180.0 + 0.50088, -90.0, 180.0, 90.0 - 0.25, 1.5, 1.5, 16)
BASE_ZOOM, TILE = 4, 16


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r(column: Column | str, digits: int) -> Column:
    """Rounded, with no negative zero."""
    return F.round(column, digits) + F.lit(0.0)


# --- sources ---------------------------------------------------------------------------------


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    nation = fx.table(spark, sf, "nation")
    return nation.select(
        F.col("n_name").alias("code"), F.concat(F.lit("Country "), F.col("n_name")).alias("name")
    )


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per customer, in lower case; every tenth asks for an unknown code."""
    customer, nation = fx.table(spark, sf, "customer"), fx.table(spark, sf, "nation")
    code = F.when(F.col("c_custkey") % 10 == 3, F.lit("atlantis")).otherwise(F.lower("n_name"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", code.alias("code")
    )


@query
def catalog_lookup(spark, sf):
    customer, nation = fx.table(spark, sf, "customer"), fx.table(spark, sf, "nation")
    named_codes = _catalog(spark, sf)
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("code"))
        .join(named_codes, "code")
        .groupBy("code", "name")
        .agg(F.count(F.lit(1)).alias("n_requests"))
    )


@query
def resolve_codes(spark, sf):
    return catalog.resolve_codes(_requests(spark, sf), _catalog(spark, sf), strict=False).select(
        "c_custkey", "code", "name", "known"
    )


@query
def sources_of_codes(spark, sf):
    """Every supplier is a raster of its nation: all rasters of the nations that end in A."""
    supplier, nation = fx.table(spark, sf, "supplier"), fx.table(spark, sf, "nation")
    numbered = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("int").alias("src"), F.lower("n_name").alias("code")
    )
    codes = [row["n_name"] for row in nation.where("n_name like '%A'").select("n_name").collect()]
    return catalog.sources_of(numbered, codes)


@query
def source_url(spark, sf):
    return _requests(spark, sf).select(
        "c_custkey", catalog.source_url(BASE, F.col("code")).alias("url")
    )


@query
def raster_scan(spark, sf):
    """Only the tiles that some region needs."""
    parts = region_ops.explode_parts(fx.regions(spark, sf))
    wanted = region_ops.region_tile_candidates(parts, GRID)
    scanned = tile_ops.scan_windows(fx.tiles(spark, sf), wanted)
    data = F.filter("cells", lambda v: v.isNotNull())
    total = F.aggregate(data, F.lit(0.0), lambda a, v: a + v)
    return scanned.select(
        "src", "tile_col", "tile_row",
        F.size(data).alias("n_data"), r(total, 3).alias("total"),
    )


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def raster_scan_ranges(spark, sf):
    """The same from a table stored along the curve, of which only the regions' key ranges are read."""
    wanted = region_ops.region_tile_candidates(_parts(spark, sf), GRID)
    path = _new_folder(spark, "curve")
    curve.save_curve_tiles(fx.tiles(spark, sf), path, GRID.tile_size)
    stored = curve.read_curve_tiles(spark, path, curve.key_ranges(wanted))
    scanned = tile_ops.scan_windows(stored, wanted)
    data = F.filter("cells", lambda v: v.isNotNull())
    total = F.aggregate(data, F.lit(0.0), lambda a, v: a + v)
    return scanned.select("src", "tile_col", "tile_row", F.size(data).alias("n_data"), r(total, 3).alias("total"))


@query
def country_include(spark, sf):
    wanted = _catalog(spark, sf).where(F.col("code").endswith("1"))
    requests = _requests(spark, sf).withColumn("code", F.upper("code"))
    return catalog.include(requests, wanted).select("c_custkey", "code")


@query
def country_exclude(spark, sf):
    unwanted = _catalog(spark, sf).where(F.col("code").endswith("1"))
    requests = _requests(spark, sf).withColumn("code", F.upper("code"))
    return catalog.exclude(requests, unwanted).select("c_custkey", "code")


@query
def country_attrs(spark, sf):
    """Headerless CSV lines of name, code and join attribute."""
    line = F.concat_ws(
        ",",
        F.col("c_name"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")),
        F.when(F.col("c_custkey") % 7 == 0, F.lit("ISO_A3")).otherwise(F.lit("SU_A3")),
    )
    lines = fx.table(spark, sf, "customer").select(line.alias("value"))
    return catalog.parse_attributes(lines)


def _feature_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as GeoJSON features: polygons where one part is all, and a point per region."""
    regions = fx.regions(spark, sf)
    properties = F.struct("adm1_code", "adm0_a3").alias("properties")
    kind = F.lit("Feature").alias("type")
    single = F.size("geom") == 1

    def feature(name: str, coordinates: Column) -> Column:
        shape = F.struct(F.lit(name).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(kind, shape.alias("geometry"), properties))

    polygon = feature("Polygon", F.element_at("geom", 1))
    line = F.when(single, polygon).otherwise(feature("MultiPolygon", F.col("geom")))
    point = feature("Point", F.array(F.lit(1.5), F.lit(2.5)))
    return regions.select("region_id", F.explode(F.array(line, point)).alias("value"))


@query
def geojson_regions(spark, sf):
    parsed = geojson.parse_features(_feature_lines(spark, sf), ADMIN1_PROPERTIES)
    vertices = F.flatten(F.flatten("geom"))
    xs = F.aggregate(vertices, F.lit(0.0), lambda a, v: a + F.element_at(v, 1))
    ys = F.aggregate(vertices, F.lit(0.0), lambda a, v: a + F.element_at(v, 2))
    return parsed.select(
        "region_id", "adm1_code", "adm0_a3",
        F.size("geom").alias("n_parts"),
        F.size(F.flatten("geom")).alias("n_rings"),
        F.size(vertices).alias("n_vertices"),
        r(xs, 6).alias("sum_x"), r(ys, 6).alias("sum_y"),
    )


@query
def admin0_regions(spark, sf):
    """Countries written as lines of features and read again, one multipolygon each."""
    regions = region_ops.merge_equal_keys(fx.regions(spark, sf), ["adm0_a3"])
    shape = F.struct(F.lit("MultiPolygon").alias("type"), F.col("geom").alias("coordinates")).alias("geometry")
    feature = F.struct(F.lit("Feature").alias("type"), shape, F.struct("adm0_a3").alias("properties"))
    path = _new_folder(spark, "admin0")
    regions.select(F.to_json(feature).alias("value")).write.text(path)
    read = geojson.read_admin0(spark, path, strict=True, lines=True)
    vertices = F.flatten(F.flatten("geom"))
    xs = F.aggregate(vertices, F.lit(0.0), lambda a, v: a + F.element_at(v, 1))
    counted = read.select("region_id", "adm0_a3", F.size("geom").alias("n_parts"), F.size(vertices).alias("n_vertices"), r(xs, 6).alias("sum_x"))
    return counted.groupBy("adm0_a3", "n_parts", "n_vertices", "sum_x").agg(F.count_distinct("region_id").alias("n_regions"))


# --- projections and scalar functions --------------------------------------------------------


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return region_ops.explode_parts(fx.regions(spark, sf))


@query
def region_parts(spark, sf):
    return _parts(spark, sf).select(
        "region_id", "adm1_code", "part", F.size("rings").alias("n_rings"),
        "xmin", "ymin", "xmax", "ymax",
    )


@query
def band_select(spark, sf):
    banded = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array("l_quantity", "l_extendedprice", "l_tax").alias("bands"),
    )
    return rasters.select_band(banded)


@query
def nodata_filter(spark, sf):
    """Cells on a few diagonals hold NaN instead of NULL; both are no data."""
    raw = fx.cells(spark, sf).withColumn(
        "value",
        F.when((F.col("col") + F.col("row")) % 19 == 0, F.lit(float("nan"))).otherwise(F.col("value")),
    )
    data = raw.where(values.is_data(F.col("value")))
    return data.groupBy("src").agg(
        F.count("value").alias("n_data"), F.sum("value").alias("total")
    )


def _grids(spark: SparkSession, sf: str) -> DataFrame:
    """A grid per part: cell and tile sizes vary, some origins are off by a share of a cell."""
    key = F.col("p_partkey")
    cell = F.lit(1.0) / (key % 12 + 1)
    off = F.when(key % 6 == 0, cell * F.lit(0.50088)).otherwise(F.lit(0.0))
    return fx.table(spark, sf, "part").select(
        key.alias("grid_id"),
        (F.lit(-180.0) + key % 40 * 7 + off).alias("xmin"),
        (F.lit(-90.0) + key % 9 * 3).alias("ymin"),
        F.lit(180.0).alias("xmax"),
        F.lit(90.0).alias("ymax"),
        cell.alias("cell_width"),
        cell.alias("cell_height"),
        ((key % 4 + 1) * 64).cast("int").alias("tile_size"),
    )


COUNTS = ("layout_cols", "layout_rows", "cols", "rows")


@query
def grid_layout(spark, sf):
    return quality.derive_layouts(_grids(spark, sf)).select("grid_id", "tile_size", *COUNTS)


@query
def tile_key(spark, sf):
    """Cell centres back to cells, tiles and positions in the tile."""
    centres = fx.cells(spark, sf).select(
        "src", GRID.center_x(F.col("col")).alias("x"), GRID.center_y(F.col("row")).alias("y")
    )
    placed = centres.select("src", GRID.col_at(F.col("x")).alias("col"), GRID.row_at(F.col("y")).alias("row"))
    return placed.select(
        "src", "col", "row",
        GRID.tile_of(F.col("col")).alias("tile_col"),
        GRID.tile_of(F.col("row")).alias("tile_row"),
        GRID.cell_index(F.col("col"), F.col("row")).cast("int").alias("idx"),
    )


@query
def tile_extent(spark, sf):
    keys = fx.cells(spark, sf).select(
        GRID.tile_of(F.col("col")).alias("tile_col"), GRID.tile_of(F.col("row")).alias("tile_row")
    ).distinct()
    extent = GRID.tile_extent(F.col("tile_col"), F.col("tile_row"))
    return keys.select("*", *[side.alias(name) for name, side in extent.items()])


@query
def source_tile_keys(spark, sf):
    extents = tile_ops.source_extents(fx.cells(spark, sf), GRID)
    return tile_ops.source_tile_keys(extents, GRID)


@query
def resample_nearest(spark, sf):
    return resample.resample_nearest(
        fx.cells(spark, sf), GRID, resample.grid_axes(COARSE)
    ).select("src", "col", "row", "value")


@query
def resample_bilinear(spark, sf):
    sampled = resample.resample_bilinear(fx.cells(spark, sf), GRID, resample.grid_axes(COARSE))
    return sampled.select("src", "col", "row", r("value", 6).alias("value"))


@query
def mercator_xy(spark, sf):
    """Region vertices to Web Mercator and back."""
    points = _vertices(spark, sf)
    x, y = projections.mercator_x(F.col("x")), projections.mercator_y(F.col("y"))
    return points.select(
        "region_id", "part", "ring", "i",
        r(x, 3).alias("mx"), r(y, 3).alias("my"),
        r(projections.mercator_lon(x), 6).alias("lon"),
        r(projections.mercator_lat(y), 6).alias("lat"),
    )


@query
def zoom_tile_key(spark, sf):
    positions = fx.cells(spark, sf).select("col", "row").distinct()
    lat = GRID.center_y(F.col("row"))
    x = projections.mercator_x(GRID.center_x(F.col("col")))
    y = projections.mercator_y(lat)
    columns = []
    for zoom in (3, 6, 12):
        col, row = zoom_tile(x, y, zoom)
        columns += [col.alias(f"x{zoom}"), row.alias(f"y{zoom}")]
    return positions.select("col", "row", *columns)


@query
def region_centroid(spark, sf):
    return area.part_centroids(_parts(spark, sf)).select(
        "region_id", "part",
        r("centroid_x", 6).alias("centroid_x"), r("centroid_y", 6).alias("centroid_y"),
    )


@query
def utm_zone(spark, sf):
    return area.part_zones(_parts(spark, sf)).select("region_id", "part", "utm_zone", "south")


def _vertices(spark: SparkSession, sf: str) -> DataFrame:
    rings = _parts(spark, sf).select("region_id", "part", F.posexplode("rings").alias("ring", "pts"))
    flat = rings.select("region_id", "part", "ring", F.posexplode("pts").alias("i", "v"))
    return flat.select(
        "region_id", "part", "ring", "i",
        F.element_at("v", 1).alias("x"), F.element_at("v", 2).alias("y"),
    )


@query
def utm_project(spark, sf):
    return area.utm_vertices(_parts(spark, sf)).select(
        "region_id", "part", "ring", "i", "utm_zone",
        r("easting", 2).alias("easting"), r("northing", 2).alias("northing"),
    )


@query
def region_area(spark, sf):
    return area.region_areas(_parts(spark, sf)).select(
        "region_id", r("area", 1).alias("area"), r("area_km2", 2).alias("area_km2")
    )


@query
def density(spark, sf):
    sums = zonal.zonal_sum(_masked_parts(spark, sf))
    areas = area.region_areas(_parts(spark, sf))
    people = F.col("population")
    return sums.join(areas, "region_id").select(
        "region_id",
        r(values.density(people, F.col("area")) * 1e6, 6).alias("density_e6"),
        r(values.density(people, F.col("area_km2")), 9).alias("density_km2"),
    )


@query
def truncate_long(spark, sf):
    """Positive and negative numbers lose their fraction towards zero."""
    price = F.col("l_extendedprice") * (F.lit(0.05) - F.col("l_discount"))
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        values.truncate_long(price).alias("whole"),
    )


@query
def color_classify(spark, sf):
    merged = mosaic_ops.mosaic_cells(fx.cells(spark, sf))
    return merged.select("col", "row", colors.classify(F.col("value")).alias("color"))


@query
def color_classify_alt(spark, sf):
    cells = fx.cells(spark, sf)
    orange = colors.classify(F.col("value"), colors.ORANGE_NINE, colors.GLOBAL_BREAKS)
    blue = colors.classify(F.col("value"), colors.BLUE_NINE, colors.TWOFOLD_BREAKS)
    return cells.select("src", "col", "row", orange.alias("orange"), blue.alias("blue"))


@query
def tile_path(spark, sf):
    tiles = fx.cells(spark, sf).select(
        "src", GRID.tile_of(F.col("col")).alias("tile_col"), GRID.tile_of(F.col("row")).alias("tile_row")
    ).distinct()
    path = colors.tile_path(OUTPUT, F.col("src"), F.col("tile_col"), F.col("tile_row"))
    return tiles.select("src", "tile_col", "tile_row", path.alias("path"))


# --- filters, joins and spatial predicates ---------------------------------------------------


@query
def antimeridian_filter(spark, sf):
    return region_ops.drop_antimeridian(_parts(spark, sf)).select("region_id", "part", "xmin", "xmax")


@query
def tile_region_candidates(spark, sf):
    return region_ops.tile_candidates(region_ops.drop_antimeridian(_parts(spark, sf)), GRID)


@query
def tile_multiregion_candidates(spark, sf):
    return region_ops.region_tile_candidates(_parts(spark, sf), GRID)


def _masked_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Data cells under every part; a cell under two parts comes twice."""
    spans = mask.clip_spans(mask.part_spans(_parts(spark, sf), GRID), GRID)
    return mask.mask_cells(fx.cells(spark, sf), spans.drop("tile_row"), GRID)


def _masked_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Data cells under every region, once each."""
    spans = mask.region_spans(mask.part_spans(_parts(spark, sf), GRID))
    return mask.mask_cells(fx.cells(spark, sf), mask.clip_spans(spans, GRID), GRID)


@query
def mask_spans(spark, sf):
    """Every covered cell of every part, with data or without."""
    return mask.part_spans(_parts(spark, sf), GRID).select(
        "region_id", "part", "row", F.explode(F.sequence("c0", "c1")).alias("col")
    )


@query
def mask_hierarchy(spark, sf):
    """Whole tiles, and the covered cells of border tiles, by part."""
    packed = hierarchy.mask_hierarchy(_parts(spark, sf), GRID)
    return hierarchy.covered_cells(packed, GRID).drop("runs")


@query
def cell_in_region(spark, sf):
    """Cells each source shares with each part."""
    return _masked_parts(spark, sf).groupBy("region_id", "part", "src").agg(
        F.count("value").alias("n_cells"),
        F.sum("value").alias("total"),
        F.sum(F.col("col").cast("bigint") * 1000 + F.col("row")).alias("place_sum"),
    )


@query
def attach_region(spark, sf):
    regions = fx.regions(spark, sf)
    sums = zonal.zonal_sum(_masked_parts(spark, sf)).join(
        regions.select("region_id", "adm1_code"), "region_id"
    )
    features = regions.select("adm1_code", "adm0_a3", "geom")
    attached = region_ops.attach_regions(sums.drop("region_id"), features)
    return attached.select(
        "adm1_code", "adm0_a3", "population", F.size("geom").alias("n_parts")
    )


@query
def tile_source_pairs(spark, sf):
    keys = tile_ops.source_tile_keys(fx.sources(spark, sf), GRID)
    pairs = tile_ops.pair_tiles(keys, fx.tiles(spark, sf))
    return pairs.select(
        "src", "tile_col", "tile_row",
        F.size(F.filter("cells", lambda v: v.isNotNull())).alias("n_data"),
    )


# --- aggregations ----------------------------------------------------------------------------


@query
def zonal_sum(spark, sf):
    return zonal.zonal_sum(_masked_regions(spark, sf))


@query
def zonal_sum_tiles(spark, sf):
    """The same from packed tiles."""
    spans = mask.region_spans(mask.part_spans(_parts(spark, sf), GRID))
    masked = mask.mask_tiles(fx.tiles(spark, sf), mask.clip_spans(spans, GRID), GRID)
    return zonal.zonal_sum(masked)


@query
def zonal_sum_prefix(spark, sf):
    """The same from tiles of running sums, under masks with whole tiles."""
    packed = hierarchy.mask_hierarchy(_parts(spark, sf), GRID, merge_parts=True)
    return prefix.zonal_sum_prefix(prefix.prefix_tiles(fx.tiles(spark, sf), GRID.tile_size), packed, GRID)


@query
def zonal_sum_shares(spark, sf):
    """Border cells count by the share of their area that a part covers."""
    running = prefix.prefix_tiles(fx.tiles(spark, sf), GRID.tile_size)
    sums = shares.zonal_sum_shares(running, shares.mask_shares(_parts(spark, sf), GRID), GRID, ["region_id", "part"])
    return sums.select("region_id", "part", r("population", 6).alias("population"), r("covered", 6).alias("covered"))


def _sketch_totals(df: DataFrame, key: str, *carried: str) -> DataFrame:
    """What a sketch keeps exactly: counts and weighted sums, within its number of bins."""
    bins = F.col("distribution")
    count = F.aggregate(bins, F.lit(0.0), lambda a, b: a + b["y"])
    total = F.aggregate(bins, F.lit(0.0), lambda a, b: a + b["x"] * b["y"])
    return df.select(
        key, *carried,
        count.cast("bigint").alias("n_cells"), r(total, 3).alias("weighted"),
        (F.size(bins) <= zonal.DISTRIBUTION_BINS).alias("bins_ok"),
    )


@query
def zonal_summary(spark, sf):
    """Bins are approximate; what holds of every sketch is compared."""
    stats = zonal.zonal_stats(_masked_parts(spark, sf)).select("region_id", "zmin", "zmax")
    summary = zonal.zonal_summary(_masked_parts(spark, sf)).join(stats, "region_id")
    inside = F.forall("distribution", lambda b: (b["x"] >= F.col("zmin")) & (b["x"] <= F.col("zmax")))
    return _sketch_totals(summary.withColumn("inside", inside), "region_id", "population", "inside").drop("weighted")


@query
def zonal_summary_totals(spark, sf):
    summary = zonal.zonal_summary(_masked_parts(spark, sf))
    return _sketch_totals(summary, "region_id", "population")


@query
def zonal_histogram(spark, sf):
    """Bins of each source's values; 256 bins hold all distinct values here, so they are exact."""
    by_source = zonal.zonal_summary(_masked_parts(spark, sf), keys=["src"], bins=256)
    bins = by_source.select("src", F.inline("distribution"))
    return bins.select("src", F.col("x").alias("value"), F.col("y").cast("bigint").alias("n_cells"))


@query
def histogram_merge(spark, sf):
    """Sketches of each (region, tile row, source), stored and then merged by region."""
    masked = _masked_parts(spark, sf).withColumn("tile_row", GRID.tile_of(F.col("row")))
    partial = zonal.zonal_summary(masked, keys=["region_id", "tile_row", "src"])
    merged = histograms.merge_distributions(partial, "region_id")
    return _sketch_totals(merged, "region_id")


@query
def zonal_stats(spark, sf):
    stats = zonal.zonal_stats(_masked_parts(spark, sf))
    return stats.select(
        "region_id", "population", "n_cells", "zmin", "zmax", r("mean", 6).alias("mean"),
        "median", "mode", r("stddev", 6).alias("stddev"),
    )


SKETCH_BREAKS = 8


@query
def sketch_stats(spark, sf):
    """Statistics and breaks from sketches of tiles, stored apart and merged, held against the values.

    A quantile's rank may be off by half the values of the two bins around it, so by the share of the
    fullest bin at most; the sketch's deviation is at most the exact one.
    """
    packed = cut_lineage(hierarchy.mask_hierarchy(_parts(spark, sf), GRID))
    cells = cut_lineage(fx.cells(spark, sf))
    tiles = tile_ops.pack_tiles(cells, GRID.tile_size)
    merged = states.merge_states(states.tile_states(tiles, packed, GRID))
    read = sketches.sketch_statistics(merged.drop("mean", "stddev"), SKETCH_BREAKS)
    points = F.concat(F.array("median"), "breaks")
    read = cut_lineage(read.select("*", points.alias("points")))
    ranks = [(below, i) for i in range(SKETCH_BREAKS + 1) for below in (True, False)]
    value = F.col("value")
    counts = [
        F.count(F.when(value < F.get("points", F.lit(i)) if below else value <= F.get("points", F.lit(i)), 1)).alias(f"{'lt' if below else 'le'}{i}")
        for below, i in ranks
    ]
    # the points go with the spans, so no row of a cell is moved to them; such a row is some four times as wide
    # Spark takes the spans for as small as the regions' file and would broadcast them, so the join is named
    pointed = mask.part_spans(_parts(spark, sf), GRID).join(read.select("region_id", "points").hint("merge"), "region_id")
    spans = mask.clip_spans(pointed, GRID).drop("tile_row")
    masked = mask.mask_cells(cells, spans, GRID, broadcast_rows=BROADCAST_ROWS // 4)
    exact = masked.groupBy("region_id").agg(F.avg(value).alias("avg"), F.stddev_pop(value).alias("dev"), *counts)
    tolerance = F.array_max(F.transform("distribution", lambda b: b["y"])) + 1e-6
    wanted = [0.5, *[(i + 1) / SKETCH_BREAKS for i in range(SKETCH_BREAKS)]]
    near = F.lit(True)
    for i, share in enumerate(wanted):
        rank = F.col("n_cells") * share
        near = near & (F.col(f"lt{i}") - tolerance <= rank) & (rank <= F.col(f"le{i}") + tolerance)
    fullest = F.exists("distribution", lambda b: b["x"] == F.col("mode"))
    ends = (F.col("median") >= F.col("zmin")) & (F.element_at("breaks", -1) <= F.col("zmax"))
    return read.join(exact, "region_id").select(
        "region_id", "n_cells", "zmin", "zmax", r("mean", 6).alias("mean"),
        (F.abs(F.col("mean") - F.col("avg")) <= 1e-6).alias("mean_ok"),
        (F.col("stddev") <= F.col("dev") + 1e-6).alias("stddev_ok"),
        near.alias("ranks_ok"), fullest.alias("mode_ok"), ends.alias("ends_ok"),
    )


def _older(tiles: DataFrame) -> DataFrame:
    """The tiles as they were: a third of the sources had fewer people, in some places no data at all."""
    was = F.transform("cells", lambda v: F.when(v % 7 != 0, v - 1))
    return tiles.withColumn("cells", F.when(F.col("src") % 3 == 0, was).otherwise(F.col("cells")))


@query
def zonal_refresh(spark, sf):
    """States of older tiles brought up to date by the tiles of the changed sources alone."""
    packed = cut_lineage(hierarchy.mask_hierarchy(_parts(spark, sf), GRID))
    tiles = fx.tiles(spark, sf)
    path = _new_folder(spark, "states")
    states.stored_states(_older(tiles), packed, GRID).write.parquet(path)
    stored = spark.read.parquet(path)
    fresh = states.refresh_states(stored, tiles.where("src % 3 = 0"), packed, GRID)
    merged = states.merge_states(fresh)
    exact = merged.select("region_id", "population", "zmin", "zmax", r("stddev", 6).alias("stddev"))
    return _sketch_totals(merged, "region_id").drop("bins_ok").join(exact, "region_id")


@query
def zonal_combine(spark, sf):
    masked = _masked_parts(spark, sf).withColumn("tile_row", GRID.tile_of(F.col("row")))
    partial = zonal.zonal_sum(masked, ["region_id", "tile_col", "tile_row", "src"])
    return zonal.combine_sums(partial)


@query
def zonal_outcome(spark, sf):
    regions = fx.regions(spark, sf)
    parts = region_ops.drop_antimeridian(region_ops.explode_parts(regions))
    spans = mask.clip_spans(mask.part_spans(parts, GRID), GRID)
    sums = zonal.zonal_sum(mask.mask_cells(fx.cells(spark, sf), spans, GRID))
    visited = zonal.visited_regions(
        region_ops.region_tile_candidates(parts, GRID),
        tile_ops.source_tile_keys(fx.sources(spark, sf), GRID),
    )
    return zonal.zonal_outcome(regions, visited, sums)


@query
def mosaic(spark, sf):
    return mosaic_ops.mosaic_cells(fx.cells(spark, sf)).select("col", "row", "value")


@query
def mosaic_tiles(spark, sf):
    """The same from packed tiles, unpacked again to compare."""
    merged = mosaic_ops.mosaic_tiles(fx.tiles(spark, sf), GRID)
    return tile_ops.unpack_tiles(merged, GRID.tile_size).select("col", "row", "value")


@query
def quantile_breaks(spark, sf):
    """Breaks of totals over all orders, each weighing one; the Admin-1 report has those of regions."""
    orders = fx.table(spark, sf, "orders").select(
        "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey")
    )
    breaks = zonal.quantile_breaks(orders, ["o_totalprice", "o_custkey"])
    both = breaks.select(F.posexplode(F.arrays_zip("o_totalprice", "o_custkey")).alias("i", "b"))
    return both.select(
        "i", F.col("b.o_totalprice").alias("price"), F.col("b.o_custkey").alias("custkey")
    )


@query
def layer_summary(spark, sf):
    return mosaic_ops.layer_summary(fx.cells(spark, sf), GRID)


@query
def pyramid(spark, sf):
    """Five levels over the merged cells, the finest on the one-degree grid itself."""
    merged = mosaic_ops.mosaic_cells(fx.cells(spark, sf))
    levels = pyramid_ops.pyramid(merged, BASE_ZOOM, 0, TILE)
    # means of means end on halves of the last digit; the shift settles which way those round
    return levels.select("zoom", "col", "row", r(F.col("value") + F.lit(1e-9), 6).alias("value"))


@query
def tile_pack(spark, sf):
    text = F.transform("cells", lambda v: F.coalesce(v.cast("bigint").cast("string"), F.lit("-")))
    return fx.tiles(spark, sf).select(
        "src", "tile_col", "tile_row", F.array_join(text, " ").alias("cells")
    )


@query
def tile_unpack(spark, sf):
    return tile_ops.unpack_tiles(fx.tiles(spark, sf), GRID.tile_size).select(
        "src", "col", "row", "value"
    )


# --- quality and distribution ----------------------------------------------------------------


@query
def grid_align_check(spark, sf):
    """All grids against the grid of cell size 1 that starts at -173."""
    reference = GridSpec(-173.0, -87.0, 180.0, 90.0, 1.0, 1.0, 64)
    checked = quality.check_alignment(_grids(spark, sf), reference)
    return checked.select(
        "grid_id", "x_size_ok", "y_size_ok", "x_aligned", "y_aligned", "aligned",
        r("x_offset", 4).alias("x_offset"),
    )


def _swept_grids(spark: SparkSession, sf: str) -> DataFrame:
    """A grid per part; sizes and origins creep by less than the tolerance, over the borders of buckets."""
    key = F.col("p_partkey")
    cell = F.lit(1.0) / (key % 12 + 1) * (F.lit(1.0) + (key % 5) * F.lit(0.004))
    x = key % 40 * 7 + (key % 3) * F.lit(0.004) - F.lit(0.004) + F.when(key % 6 == 0, F.lit(0.3)).otherwise(F.lit(0.0))
    return fx.table(spark, sf, "part").select(
        key.alias("grid_id"), (x * cell).alias("xmin"), ((key % 9 * 3 + F.lit(0.25)) * cell).alias("ymin"),
        cell.alias("cell_width"), cell.alias("cell_height"),
    )


@query
def grid_families(spark, sf):
    """Families of all grids, none compared with all others."""
    return families.grid_families(_swept_grids(spark, sf), "grid_id").select("grid_id", "family", "n_grids")


@query
def grid_layout_check(spark, sf):
    """Declared layouts: every seventh has a tile column too many, every eleventh a row of cells,
    every thirteenth an extent that stretches its cells."""
    key, due = F.col("grid_id"), quality.derive_layouts(_grids(spark, sf))
    declared = due.withColumns(
        {
            "layout_cols": F.col("layout_cols") + F.when(key % 7 == 0, 1).otherwise(0),
            "rows": F.col("rows") + F.when(key % 11 == 0, 1).otherwise(0),
            "layout_xmax": F.col("xmin")
            + F.col("cols") * F.col("cell_width") * F.when(key % 13 == 0, 1.01).otherwise(1.0),
            "layout_ymin": F.col("ymax") - F.col("rows") * F.col("cell_height"),
        }
    )
    return quality.check_layouts(declared).select(
        "grid_id", "tiles_ok", "cells_ok", "cell_width_ok", "cell_height_ok"
    )


@query
def rebalance_tiles(spark, sf):
    keys = fx.cells(spark, sf).select(
        "src",
        GRID.tile_of(F.col("col")).alias("tile_col"),
        GRID.tile_of(F.col("row")).alias("tile_row"),
        "value",
    )
    work = keys.groupBy("src", "tile_col", "tile_row").agg(F.count("value").alias("n_data"))
    return tile_ops.rebalance(work)


# --- jobs and their sinks --------------------------------------------------------------------


def _admin(spark: SparkSession, sf: str) -> DataFrame:
    return _admin_of(spark, sf, fx.cells(spark, sf))


def _admin_of(spark: SparkSession, sf: str, raster: DataFrame, **options) -> DataFrame:
    """With exact modes, as SQL has no sketches; some regions share both codes."""
    return admin_population.admin1_population(
        fx.shared_regions(spark, sf), raster, fx.sources(spark, sf), GRID, exact_mode=True, **options
    )


@query
def admin1_population(spark, sf):
    return _admin_rows(_admin(spark, sf))


@query
def admin1_population_tiles(spark, sf):
    """The same from packed tiles."""
    return _admin_rows(_admin_of(spark, sf, fx.tiles(spark, sf)))


@query
def admin1_population_offgrid(spark, sf):
    """Packed tiles on a grid half a cell off the job's; they stay packed."""
    return _admin_rows(_admin_of(spark, sf, fx.tiles(spark, sf), source_grid=fx.OFF_GRID))


def _admin_rows(result: DataFrame) -> DataFrame:
    return result.select(
        "adm1_code", "adm0_a3", "population",
        r(F.col("density") * 1e6, 6).alias("density_e6"),
        r("density_km2", 9).alias("density_km2"),
        "n_tiles", "n_cells", "zmin", "zmax", r("mean", 6).alias("mean"),
        "median", "mode", r("stddev", 6).alias("stddev"),
    )


@query
def admin1_population_sketch(spark, sf):
    """The default mode on packed tiles: sums and moments are exact, median and mode lie within the values."""
    result = admin_population.admin1_population(
        fx.shared_regions(spark, sf), fx.tiles(spark, sf), fx.sources(spark, sf), GRID
    )
    inside = lambda c: F.col(c).between(F.col("zmin"), F.col("zmax"))
    count = F.aggregate("distribution", F.lit(0.0), lambda n, b: n + b["y"]).cast("bigint")
    return result.select(
        "adm1_code", "adm0_a3", "population", r(F.col("density") * 1e6, 6).alias("density_e6"),
        r("density_km2", 9).alias("density_km2"), "n_tiles", "n_cells", "zmin", "zmax", r("mean", 6).alias("mean"),
        r("stddev", 6).alias("stddev"), inside("median").alias("median_ok"), inside("mode").alias("mode_ok"),
        count.alias("n_in_sketch"),
    )


@query
def admin_csv(spark, sf):
    return reports.admin_csv(_admin(spark, sf), digits=6)


@query
def admin_geojson(spark, sf):
    """Report features read back by the region reader."""
    shapes = region_ops.merge_equal_keys(fx.shared_regions(spark, sf), admin_population.KEYS)
    shapes = shapes.select("adm1_code", "geom")
    features = reports.admin_geojson(region_ops.attach_regions(_admin(spark, sf), shapes))
    regions = geojson.parse_features(
        features.withColumn("text", F.col("value")), ADMIN1_PROPERTIES
    )
    return regions.select(
        F.get_json_object("text", "$.type").alias("type"),
        F.get_json_object("text", "$.geometry.type").alias("geometry_type"),
        "adm1_code", "adm0_a3",
        F.get_json_object("text", "$.properties.population").cast("bigint").alias("population"),
        F.get_json_object("text", "$.properties.stats.zmax").cast("double").alias("zmax"),
        F.size("geom").alias("n_parts"),
        F.size(F.flatten(F.flatten("geom"))).alias("n_vertices"),
    )


@query
def quantile_json(spark, sf):
    """The report's JSON read back, one row per break."""
    text = reports.quantile_json(_admin(spark, sf))
    parsed = text.select(
        F.from_json("value", "population array<double>, density array<double>").alias("j")
    )
    both = parsed.select(
        F.posexplode(F.arrays_zip("j.population", "j.density")).alias("i", "b")
    )
    return both.select(
        "i", F.col("b.population").alias("population"), r(F.col("b.density") * 1e6, 6).alias("density_e6")
    )


@query
def region_population(spark, sf):
    return named.region_population(
        fx.regions(spark, sf), fx.cells(spark, sf), fx.sources(spark, sf), GRID
    )


@query
def region_population_offgrid(spark, sf):
    return named.region_population(
        fx.regions(spark, sf), fx.tiles(spark, sf), fx.sources(spark, sf), GRID, source_grid=fx.OFF_GRID
    )


@query
def region_population_prefix(spark, sf):
    """From tiles of running sums."""
    running = prefix.prefix_tiles(fx.tiles(spark, sf), GRID.tile_size)
    return named.region_population(fx.regions(spark, sf), running, fx.sources(spark, sf), GRID)


@query
def region_population_resized(spark, sf):
    """Packed tiles of smaller cells; they stay packed, the regions' runs are cut and moved."""
    return named.region_population(
        fx.regions(spark, sf), fx.tiles(spark, sf), fx.sources(spark, sf), GRID, source_grid=fx.RESIZED
    )


@query
def region_csv(spark, sf):
    result = named.region_population(
        fx.regions(spark, sf), fx.tiles(spark, sf), fx.sources(spark, sf), GRID
    )
    return reports.region_csv(result)


@query
def render_pyramid(spark, sf):
    return render.render_pyramid(
        fx.cells(spark, sf), GRID, base_zoom=BASE_ZOOM, tile_size=TILE
    )


def _tile_text(tiles: DataFrame) -> DataFrame:
    shades = F.array_join(F.transform("rgba", lambda c: c.cast("string")), " ")
    return tiles.select("zoom", "tile_col", "tile_row", "path", shades.alias("rgba"))


@query
def render_tiles(spark, sf):
    cells = fx.cells(spark, sf)
    return _tile_text(render.render_tiles(cells, GRID, OUTPUT, base_zoom=BASE_ZOOM, tile_size=TILE))


@query
def render_tiles_fine(spark, sf):
    """Pixels finer than the raster, by way of packed tiles."""
    packed = fx.tiles(spark, sf)
    return _tile_text(
        render.render_tiles(packed, GRID, OUTPUT, base_zoom=BASE_ZOOM + 1, tile_size=TILE)
    )


@query
def render_refresh(spark, sf):
    """Levels rendered from older tiles and brought up to date where tiles of the west changed."""
    tiles, zoom = fx.tiles(spark, sf), BASE_ZOOM + 1
    west = F.col("tile_col") < 8
    before = _older(tiles.where(west)).unionByName(tiles.where(~west))
    stored = cut_lineage(render.tile_levels(before, GRID, zoom, 0, TILE))
    changed = tiles.where(west & (F.col("src") % 3 == 0))
    fresh = again.refresh_levels(stored, tiles, changed, GRID, base_zoom=zoom, tile_size=TILE)
    return _tile_text(shade_tiles(fresh, OUTPUT))
