"""Nothing is lost without an error, and plans read the raster as they should."""

import json
import random

import micro
import pytest
from micro import GRID, block, square
from pyspark.sql import functions as F

from gridcensus.functions.grid import GLOBAL_100M, GridSpec
from gridcensus.functions.values import nodata_to_null
from gridcensus.operators import histograms, joins, mask, quality, regions as region_ops, tiles as tile_ops, zonal
from gridcensus.plans.admin_population import admin1_population, write_reports
from gridcensus.operators.reading import read_axes, shifted_grid
from gridcensus.plans.region_population import region_population
from gridcensus.schemas import ADMIN1_PROPERTIES
from gridcensus.sources import catalog, geojson, rasters

GOOD = {
    "type": "Feature",
    "geometry": {"type": "Polygon", "coordinates": [square(0, 0, 2)]},
    "properties": {"adm1_code": "A", "adm0_a3": "X"},
}


def with_coordinates(coordinates):
    return json.dumps(GOOD | {"geometry": {"type": "Polygon", "coordinates": coordinates}})


BROKEN = {
    "well-formed": '{"type": "Feature", "geometry": {"type": "Poly',
    "rings": with_coordinates([[[0, 0], [1], [1, 1]]]),
    "broken rings": with_coordinates("none"),
    "has broken": with_coordinates([[[0, 0], [1, "x"], [1, 1], [0, 0]]]),
}


@pytest.mark.parametrize("message", sorted(BROKEN))
def test_broken_lines_fail_strict_reads_and_are_counted(spark, tmp_path, message):
    path = tmp_path / "lines.geojson"
    path.write_text("\n".join([json.dumps(GOOD), "", BROKEN[message]]))
    with pytest.raises(Exception, match=message):
        geojson.read_admin1(spark, str(path), strict=True, lines=True).select("region_id").collect()
    assert geojson.read_admin1(spark, str(path), lines=True).count() == 1
    counts = geojson.count_dropped(spark.read.text(str(path)), ADMIN1_PROPERTIES).head()
    assert counts["n_dropped"] == 1


def test_a_truncated_collection_fails_every_read(spark, tmp_path):
    path = tmp_path / "regions.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [GOOD]})[:-20])
    for strict in (True, False):
        with pytest.raises(Exception, match="(?i)malformed|corrupt"):
            geojson.read_admin0(spark, str(path), strict=strict).collect()


def test_unknown_codes_fail_whatever_is_selected(spark):
    codes = spark.createDataFrame([("AAA", "First")], "code string, name string")
    asked = spark.createDataFrame([("aaa",), ("zzz",)], "code string")
    with pytest.raises(Exception, match="unknown country code ZZZ"):
        catalog.resolve_codes(asked, codes).select("code").collect()


def test_a_code_brings_all_its_rasters(spark):
    sources = spark.createDataFrame([(1, "DJI"), (2, "DJI"), (3, "ERI"), (4, "SOM")], "src int, code string")
    assert catalog.source_ids(sources, ["dji", "ERI"]) == [1, 2, 3]
    chosen = catalog.include(sources, catalog.sources_of(sources, ["DJI"]), "src")
    assert {r["src"] for r in chosen.collect()} == {1, 2}


def test_many_hot_keys_keep_their_slices(spark):
    raster = spark.range(3000).selectExpr("id % 30 as k", "id")
    masks = spark.range(30).selectExpr("id as k", "id * 2 as m")
    joined = joins.join_masks(raster, masks, ["k"], ["id"], broadcast_rows=1, rows_per_slice=40)
    assert joined.count() == 3000
    assert [r["slices"] for r in joins.hot_keys(raster, ["k"], 40).collect()] == [3] * 30


def test_infinite_cells_and_marks_are_no_data(spark, tmp_path):
    cells = micro.cells(spark, [(0, 180, 85, 3.0), (0, 181, 85, float("inf")), (0, 182, 85, -9999.0)])
    path = str(tmp_path / "cells")
    cells.write.parquet(path)
    read = {r["col"]: r["value"] for r in rasters.read_cells(spark, path, nodata=-9999.0).collect()}
    assert read == {180: 3.0, 181: None, 182: None}
    packed = cells.select(F.transform(F.array("value"), lambda v: nodata_to_null(v, -9999.0)).alias("v"))
    assert sorted(packed.select(F.explode("v")).na.drop().collect()) == [(3.0,)]
    spans = mask.clip_spans(mask.part_spans(region_ops.explode_parts(micro.regions(spark, {"a": [[square(0, 0, 10)]]})), GRID), GRID)
    for masked in (mask.mask_cells(cells, spans, GRID), mask.mask_tiles(tile_ops.pack_tiles(cells, 16), spans, GRID)):
        assert zonal.zonal_sum(masked).head()["population"] == 3.0 - 9999.0


def test_masks_take_one_row_per_region_and_tile(spark):
    named = {"wide": [[square(-100, -50, 96)]], "twice": [[square(0, 0, 16)], [square(4, 4, 8)]]}
    spans = mask.clip_spans(mask.part_spans(region_ops.explode_parts(micro.regions(spark, named)), GRID), GRID)
    packed = mask.pack_masks(spans.drop("part"), GRID)
    rows = packed.collect()
    assert len({(r["region_id"], r["tile_col"], r["tile_row"]) for r in rows}) == len(rows)
    inside = [r for r in rows if r["region_id"] == 0 and r["runs"] is None]
    assert len(inside) >= 16 and spans.count() > 4 * len(rows)
    assert all(r["runs"] is not None for r in rows if r["region_id"] == 1)



def inputs(spark):
    named = {"a": [[square(-10, -10, 23)]], "b": [[square(3, -4, 7)]]}
    data = [(s, c, r, float((c * 5 + r * 3 + s) % 13)) for s in (0, 1) for c in range(165, 200) for r in range(75, 105)]
    regions = micro.regions(spark, named).withColumns(
        {"adm1_code": F.col("region_id").cast("string"), "adm0_a3": F.lit("X"), "location_name": F.col("region_id").cast("string")}
    )
    extents = spark.createDataFrame([(s, -180.0, -90.0, 180.0, 90.0) for s in (0, 1)], "src int, xmin double, ymin double, xmax double, ymax double")
    return regions, micro.cells(spark, data), extents


@pytest.mark.parametrize("off", [(0.5, 0.5), (-0.5, 0.25), (3.0, -2.0)])
def test_shifted_runs_equal_resampling_cell_by_cell(spark, off):
    regions, cells, extents = inputs(spark)
    source = GridSpec(-180.0 + off[0], -90.0 + off[1], 180.0 + off[0], 90.0 + off[1], 1.0, 1.0, 16)
    packed = tile_ops.pack_tiles(cells, 16)
    found = admin1_population(regions, packed, extents, GRID, source_grid=source, exact_mode=True)
    expected = {}
    x0, y0 = -10, -10
    for region, low, side in ((0, (x0, y0), 23), (1, (3, -4), 7)):
        total = 0.0
        for s, c, r, v in [(x["src"], x["col"], x["row"], x["value"]) for x in cells.collect()]:
            for jc in range(c - 5, c + 6):
                for jr in range(r - 5, r + 6):
                    x, y = -180 + jc + 0.5, 90 - jr - 0.5
                    if int((x - source.xmin) // 1) == c and int((source.ymax - y) // 1) == r:
                        if low[0] < x < low[0] + side and low[1] < y < low[1] + side:
                            total += v
        expected[str(region)] = int(total)
    assert {r["adm1_code"]: r["population"] for r in found.collect()} == expected
    named = region_population(regions, packed, extents, GRID, source_grid=source)
    assert {r["location_name"]: r["population"] for r in named.collect()} == expected


def test_grids_of_another_cell_size_do_not_shift():
    everywhere = (-180.0, -90.0, 180.0, 90.0)
    assert shifted_grid(GRID, GridSpec(*everywhere, 0.5, 0.5, 16), everywhere) is None
    assert shifted_grid(GRID, GRID, everywhere) == GRID


def test_three_arc_second_cells_shift_as_one_piece():
    """A cell of exactly 1/1200 degree drifts by a thousandth of a cell over the globe, which moves no centre."""
    source = GridSpec(28.0, -3.0, 31.0, -1.0, 1 / 1200, 1 / 1200, 512)
    same = shifted_grid(GLOBAL_100M, source, (28.1, -2.9, 30.9, -1.1))
    assert same is not None and same.cols == source.cols
    across, _ = read_axes(GLOBAL_100M, source)
    west, east = (int((x + 180) / GLOBAL_100M.cell_width) for x in (28.1, 30.9))
    assert across.shift_over(west, east) == across.source_of(west) - west


def test_features_of_one_key_are_one_row(spark, tmp_path):
    named = {"a": [[square(0, 0, 2)]], "b": [[square(10, 0, 2)]], "c": [[square(20, 0, 2)]]}
    regions = micro.regions(spark, named).withColumns(
        {"adm1_code": F.when(F.col("region_id") < 2, "Z").otherwise("Y"), "adm0_a3": F.lit("X")}
    )
    cells = micro.cells(spark, block(0, 180, 80, 30, 10))
    extents = spark.createDataFrame([(0, -180.0, -90.0, 180.0, 90.0)], "src int, xmin double, ymin double, xmax double, ymax double")
    result = admin1_population(regions, cells, extents, GRID)
    assert {(r["adm1_code"], r["population"], r["n_cells"]) for r in result.collect()} == {("Z", 8, 8), ("Y", 4, 4)}
    write_reports(result, regions, str(tmp_path / "report"))
    differing = regions.withColumn("adm0_a3", F.col("region_id").cast("string"))
    with pytest.raises(Exception, match="several regions share Z"):
        write_reports(admin1_population(differing, cells, extents, GRID), differing, str(tmp_path / "other"))


def test_the_job_reads_a_stored_raster_once_and_only_near_its_regions(spark, tmp_path):
    regions, cells, extents = inputs(spark)
    path = str(tmp_path / "tiles")
    tile_ops.save_tiles(tile_ops.pack_tiles(cells, 16), path, 16)
    jobs = (
        admin1_population(regions, rasters.read_tiles(spark, path), extents, GRID),
        region_population(regions, rasters.read_tiles(spark, path), extents, GRID),
    )
    for job in jobs:
        plan = job._jdf.queryExecution().executedPlan().toString().split("\n")
        scans = [i for i, line in enumerate(plan) if "FileScan" in line and "cells#" in line]
        assert len(scans) == 1
        scan = plan[scans[0]]
        assert "GreaterThanOrEqual(tile_col,10)" in scan and "tile_col#" in scan
        # tiles meet their masks where they are read
        assert any("BroadcastHashJoin" in line for line in plan[scans[0] - 4 : scans[0]])


def test_sketches_of_many_keys_merge_in_a_stream(spark):
    rng = random.Random(1)
    rows = [(k, [(float(rng.randrange(40)), 1.0) for _ in range(5)]) for k in [None, *range(30)] for _ in range(20)]
    rng.shuffle(rows)
    partials = spark.createDataFrame(rows, "k int, distribution array<struct<x:double,y:double>>").repartition(7)
    merged = {r["k"]: r["distribution"] for r in histograms.merge_distributions(partials, "k", bins=8).collect()}
    assert len(merged) == 31
    for k, bins in merged.items():
        own = [b for key, bs in rows if key == k for b in bs]
        assert len(bins) <= 8 and sum(b["y"] for b in bins) == len(own)
        assert sum(b["x"] * b["y"] for b in bins) == pytest.approx(sum(x for x, _ in own))


def test_layout_checks_fail_where_a_layout_is_wrong(spark):
    good = (0, -180.0, -90.0, 180.0, 90.0, 1.0, 1.0, 16, 23, 12, 368, 192, 188.0, -102.0)
    names = "id int, xmin double, ymin double, xmax double, ymax double, cell_width double, cell_height double, tile_size int"
    names += ", layout_cols int, layout_rows int, cols int, rows int, layout_xmax double, layout_ymin double"
    wide = (1, *good[1:8], 24, *good[9:])
    stretched = (2, *good[1:12], 190.0, -102.0)
    rows = quality.check_layouts(spark.createDataFrame([good, wide, stretched], names)).orderBy("id").collect()
    flags = [(r["tiles_ok"], r["cells_ok"], r["cell_width_ok"], r["cell_height_ok"]) for r in rows]
    assert flags == [(True, True, True, True), (False, True, True, True), (True, True, False, True)]
