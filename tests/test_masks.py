import micro
import pytest
from micro import GRID, block, plan, ring, square

from gridcensus.functions.grid import GridSpec
from gridcensus.operators import joins, mask, regions as region_ops, tiles as tile_ops, zonal
from gridcensus.plans.admin_population import admin1_population
from gridcensus.plans.region_population import region_population


def spans_of(spark, named, merged=False, grid=GRID):
    parts = region_ops.explode_parts(micro.regions(spark, named))
    spans = mask.part_spans(parts, grid)
    return mask.region_spans(spans) if merged else spans


def covered(spans):
    """Covered (row, col) pairs, repeated where spans overlap."""
    return sorted(
        (r["row"], c) for r in spans.collect() for c in range(r["c0"], r["c1"] + 1)
    )


def test_square_covers_its_cells(spark):
    got = covered(spans_of(spark, {"a": [[square(10, 20, 3)]]}))
    assert got == [(r, c) for r in (67, 68, 69) for c in (190, 191, 192)]


def test_l_shape(spark):
    shape = ring(0, 0, (0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3))
    assert covered(spans_of(spark, {"a": [[shape]]})) == [
        (87, 180), (88, 180), (89, 180), (89, 181), (89, 182), (89, 183),
    ]


def test_hole_is_left_out(spark):
    got = covered(spans_of(spark, {"a": [[square(0, 0, 5), square(1, 1, 3)]]}))
    assert len(got) == 25 - 9 and (87, 182) not in got


def test_closed_and_open_rings_agree(spark):
    shell = square(0, 0, 5)
    assert covered(spans_of(spark, {"a": [[shell + shell[:1]]]})) == covered(
        spans_of(spark, {"a": [[shell]]})
    )


def test_neighbours_share_no_cell_even_on_cell_centres(spark):
    west, east = ring(0.5, 0.5, (0, 0), (3, 0), (3, 3), (0, 3)), ring(3.5, 0.5, (0, 0), (3, 0), (3, 3), (0, 3))
    both = covered(spans_of(spark, {"w": [[west]], "e": [[east]]}))
    assert len(both) == len(set(both)) == 18


def test_overlapping_parts_count_twice_by_part_and_once_by_region(spark):
    named = {"a": [[square(0, 0, 4)], [square(2, 2, 4)]]}
    by_part, by_region = covered(spans_of(spark, named)), covered(spans_of(spark, named, merged=True))
    assert len(by_part) == 32
    assert len(by_region) == len(set(by_region)) == 28
    assert set(by_part) == set(by_region)


def test_spans_stay_within_the_grid(spark):
    got = covered(spans_of(spark, {"a": [[square(178, 88, 10)]], "b": [[square(-190, -99, 11)]]}))
    assert got == [(0, 358), (0, 359), (1, 358), (1, 359)] + [(r, c) for r in (178, 179) for c in (0,)]


def test_antimeridian_parts_go_and_others_stay(spark):
    named = {
        "east": [[square(170, 0, 10)], [square(150, 0, 5)]],
        "west": [[square(-180, 0, 10)]],
        "inner": [[square(169, 0, 10)]],
    }
    parts = region_ops.drop_antimeridian(region_ops.explode_parts(micro.regions(spark, named)))
    kept = {(r["location_name"], r["part"]) for r in parts.collect()}
    assert kept == {("east", 1), ("inner", 0)}


def test_tile_candidates_include_touch_and_interior(spark):
    # tile (11, 5) is x -4..12, y -6..10; the region's west side touches tile column 11's east side
    named = {"touch": [[square(12, 0, 2)]], "big": [[square(-100, -60, 100)]]}
    parts = region_ops.explode_parts(micro.regions(spark, named))
    rows = region_ops.tile_candidates(parts, GRID).collect()
    touch = {(r["tile_col"], r["tile_row"]) for r in rows if r["region_id"] == 0}
    assert touch == {(11, 5), (12, 5)}
    big = {(r["tile_col"], r["tile_row"]) for r in rows if r["region_id"] == 1}
    cols, rows_ = range(4, 12), range(3, 10)  # its west side touches column 4
    assert big == {(c, r) for c in cols for r in rows_}
    assert len([r for r in rows if r["region_id"] == 1]) == len(big)


@pytest.mark.parametrize("tile_size", [4, 16, 512])
def test_sums_do_not_depend_on_tile_size_or_form(spark, tile_size):
    grid = GridSpec(-180.0, -90.0, 180.0, 90.0, 1.0, 1.0, tile_size)
    named = {"a": [[square(-20, -20, 37)]], "b": [[square(0, 0, 30), square(3, 3, 11)]]}
    data = [(s, c, r, float((c * 7 + r * 3 + s) % 11)) for s in (0, 1) for c in range(150, 215) for r in range(55, 115)]
    cells = micro.cells(spark, data)
    spans = mask.clip_spans(spans_of(spark, named, grid=grid), grid)
    long = zonal.zonal_sum(mask.mask_cells(cells, spans, grid))
    packed = zonal.zonal_sum(mask.mask_tiles(tile_ops.pack_tiles(cells, tile_size), spans, grid))
    expected = {}
    for s, c, r, v in data:
        x, y = c - 180 + 0.5, 90 - r - 0.5
        if -20 < x < 17 and -20 < y < 17:
            expected[0] = expected.get(0, 0) + v
        if 0 < x < 30 and 0 < y < 30 and not (3 < x < 14 and 3 < y < 14):
            expected[1] = expected.get(1, 0) + v
    for form in (long, packed):
        assert {r["region_id"]: r["population"] for r in form.collect()} == expected


def test_regions_that_tile_the_world_sum_to_the_total(spark):
    named = {
        f"{x},{y}": [[ring(x, y, (0, 0), (60, 0), (60, 45), (0, 45))]]
        for x in range(-180, 180, 60)
        for y in range(-90, 90, 45)
    }
    data = [(0, c, r, float(c + r)) for c in range(0, 360, 7) for r in range(0, 180, 5)]
    spans = mask.clip_spans(spans_of(spark, named), GRID)
    sums = zonal.zonal_sum(mask.mask_cells(micro.cells(spark, data), spans, GRID)).collect()
    assert sum(r["population"] for r in sums) == sum(v for *_, v in data)


def test_large_masks_meet_hot_tiles_in_slices(spark):
    """Beyond the broadcast bound, with nearly all rows on one key, the result is the same."""
    data = block(0, 180, 80, 10, 10) + [(s, 185, 85, 1.0) for s in range(1, 400)]
    cells = micro.cells(spark, data)
    named = {"a": [[square(0, 0, 10)]], "b": [[square(3, 2, 5)]]}
    spans = mask.clip_spans(spans_of(spark, named), GRID)
    small = zonal.zonal_sum(mask.mask_cells(cells, spans, GRID))
    masked = mask.mask_cells(cells, spans, GRID, broadcast_rows=1, rows_per_slice=50)
    assert "slice" in masked._jdf.queryExecution().analyzed().toString()
    key = lambda r: r["region_id"]
    assert sorted(zonal.zonal_sum(masked).collect(), key=key) == sorted(small.collect(), key=key)

    tiles = tile_ops.pack_tiles(cells, GRID.tile_size)
    packed = mask.mask_tiles(tiles, spans, GRID, broadcast_rows=1, rows_per_slice=256 * 20)
    assert sorted(zonal.zonal_sum(packed).collect(), key=key) == sorted(small.collect(), key=key)


def test_hot_keys_are_few(spark):
    raster = spark.range(1000).selectExpr("if(id < 700, 0, id) as k")
    hot = joins.hot_keys(raster, ["k"], 100).collect()
    assert [(r["k"], r["slices"]) for r in hot] == [(0, 7)]


def test_spatial_joins_are_equi_joins(spark):
    named = {"a": [[square(0, 0, 10)]]}
    spans = joins.cut_lineage(mask.clip_spans(spans_of(spark, named), GRID))
    cells = micro.cells(spark, block(0, 180, 80, 10, 10))
    for masked in (
        mask.mask_cells(cells, spans, GRID),
        mask.mask_cells(cells, spans, GRID, broadcast_rows=1),
        mask.mask_tiles(tile_ops.pack_tiles(cells, 16), spans, GRID),
    ):
        assert "NestedLoop" not in plan(masked) and "Cartesian" not in plan(masked)
    assert "BroadcastHashJoin" in plan(mask.mask_cells(cells, spans, GRID))


def job_inputs(spark):
    """Two sources; a region on their border, one without data, one outside, one at the antimeridian."""
    named = {
        "border": [[square(-2, 0, 4)]],
        "empty": [[square(20, 0, 4)]],
        "outside": [[square(100, 50, 4)]],
        "edge": [[square(176, 0, 4)]],
        "double": [[square(5, 0, 4)], [square(7, 0, 4)]],
    }
    data = block(0, 170, 80, 10, 10, 2.0) + block(1, 180, 80, 20, 10, 3.0)
    data += [(1, 201, 87, None), (1, 202, 87, float("nan"))] + block(1, 356, 80, 4, 10, 5.0)
    extents = micro.sources(spark, (0, -10, 0, 0, 10), (1, 0, 0, 24, 10), (2, 170, 0, 180, 10))
    return micro.regions(spark, named), micro.cells(spark, data), extents


def test_admin_job(spark):
    regions, cells, extents = job_inputs(spark)
    rows = {r["adm1_code"]: r for r in admin1_population(regions, cells, extents, GRID).collect()}
    assert set(rows) == {"A0", "A1", "A4"}
    assert rows["A0"]["population"] == 8 * 2 + 8 * 3
    # the sketch has eight values at 2 and eight at 3, so its median lies halfway; the values' own is 2
    assert rows["A0"]["mode"] == 2.0 and rows["A0"]["median"] == 2.5
    exact = {r["adm1_code"]: r for r in admin1_population(regions, cells, extents, GRID, exact_mode=True).collect()}
    assert exact["A0"]["mode"] == 2.0 and exact["A0"]["median"] == 2.0
    assert (rows["A0"]["zmin"], rows["A0"]["zmax"], rows["A0"]["stddev"]) == (2.0, 3.0, 0.5)
    assert sum(b["y"] for b in rows["A0"]["distribution"]) == 16
    assert rows["A1"]["population"] == 0 and rows["A1"]["density"] == 0.0 and rows["A1"]["zmin"] is None
    assert rows["A4"]["population"] == (16 + 16) * 3


def test_admin_job_keeps_all_regions_on_request(spark):
    regions, cells, extents = job_inputs(spark)
    rows = admin1_population(
        regions, cells, extents, GRID, keep_empty=True, drop_antimeridian=False, exact_mode=False
    ).collect()
    by_code = {r["adm1_code"]: r for r in rows}
    assert set(by_code) == {"A0", "A1", "A2", "A3", "A4"}
    assert by_code["A2"]["n_tiles"] == 0 and by_code["A3"]["population"] == 16 * 5
    assert by_code["A0"]["mode"] == 2.0


def test_admin_job_selects_sources(spark):
    regions, cells, extents = job_inputs(spark)
    only = admin1_population(regions, cells, extents, GRID, include=[0]).collect()
    assert {r["adm1_code"]: r["population"] for r in only}["A0"] == 16
    without = admin1_population(regions, cells, extents, GRID, exclude=[0]).collect()
    assert {r["adm1_code"]: r["population"] for r in without}["A0"] == 24


@pytest.mark.parametrize("packed", [False, True])
def test_region_job(spark, packed):
    regions, cells, extents = job_inputs(spark)
    raster = tile_ops.pack_tiles(cells, GRID.tile_size) if packed else cells
    rows = region_population(regions, raster, extents, GRID).collect()
    got = {r["location_name"]: r["population"] for r in rows}
    assert got == {"border": 40, "empty": 0, "edge": 16 * 5, "double": 24 * 3}


def test_region_job_adds_equal_names(spark):
    regions, cells, extents = job_inputs(spark)
    renamed = regions.selectExpr(
        "region_id", "if(region_id in (0, 4), 'same', location_name) as location_name", "geom"
    )
    rows = region_population(renamed, cells, extents, GRID).collect()
    assert {r["location_name"]: r["population"] for r in rows}["same"] == 40 + 72


@pytest.mark.parametrize("packed", [False, True])
def test_jobs_bring_rasters_on_another_grid_to_theirs(spark, packed):
    """Half-degree cells, off by half a cell and a bit: each job cell reads the one at its centre."""
    source = GridSpec(-180.0 + 0.25044, -90.0, 180.0, 90.0 - 0.1, 0.5, 0.5, 8)
    data = [(0, c, r, float((c * 7 + r) % 23)) for c in range(330, 400) for r in range(150, 200)]
    cells = micro.cells(spark, data)
    raster = tile_ops.pack_tiles(cells, source.tile_size) if packed else cells
    regions = micro.regions(spark, {"a": [[square(-5, 0, 11)]]})
    extents = micro.sources(spark, (0, -15, -10, 20, 15))
    known = {(c, r): v for _, c, r, v in data}
    expected = 0.0
    for x in range(-5, 6):
        for y in range(0, 11):
            c = int((x + 0.5 - source.xmin) // 0.5)
            r = int((source.ymax - (y + 0.5)) // 0.5)
            expected += known[(c, r)]
    options = {"source_grid": source, "partitions": 3}
    admin = admin1_population(regions, raster, extents, GRID, **options).head()
    named = region_population(regions, raster, extents, GRID, **options).head()
    assert admin["population"] == named["population"] == int(expected)
    assert admin["n_cells"] == 121
