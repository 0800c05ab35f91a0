import json

import micro
import pytest
from micro import GRID, block, square
from pyspark.sql import functions as F

from gridcensus.functions import projections
from gridcensus.operators import area, histograms, regions as region_ops
from gridcensus.operators.quality import check_alignment
from gridcensus.functions.grid import GridSpec
from gridcensus.plans.admin_population import admin1_population, write_reports
from gridcensus.plans.region_population import region_population
from gridcensus.schemas import ADMIN1_PROPERTIES
from gridcensus.sinks import map_tiles, reports
from gridcensus.plans.render_pyramid import render_tiles
from gridcensus.sources import catalog, geojson


def feature(kind, coordinates, **properties):
    return {
        "type": "Feature",
        "geometry": {"type": kind, "coordinates": coordinates},
        "properties": properties,
    }


FEATURES = [
    feature("Polygon", [square(0, 0, 2)], adm1_code="P-1", adm0_a3="AAA", extra=1),
    feature("MultiPolygon", [[square(5, 5, 2)], [square(9, 9, 1)]], adm1_code="M-1", adm0_a3="BBB"),
    feature("Point", [1.0, 2.0], adm1_code="X-1", adm0_a3="CCC"),
    feature("Polygon", [square(3, 3, 1)], adm0_a3="DDD"),
]


def shapes(regions):
    return {r["adm1_code"]: [len(rings) for rings in r["geom"]] for r in regions.collect()}


def test_feature_collection(spark, tmp_path):
    path = tmp_path / "regions.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    regions = geojson.read_admin1(spark, str(path))
    assert shapes(regions) == {"P-1": [1], "M-1": [1, 1]}
    assert regions.select("region_id").distinct().count() == 2
    first = regions.where("adm1_code = 'P-1'").head()["geom"]
    assert first == [[square(0, 0, 2)]]


def test_feature_lines_and_dropped_features(spark, tmp_path):
    path = tmp_path / "lines.geojson"
    path.write_text("\n".join(json.dumps(f) for f in FEATURES))
    assert shapes(geojson.read_feature_lines(spark, str(path), ADMIN1_PROPERTIES)) == {
        "P-1": [1], "M-1": [1, 1],
    }
    counts = geojson.count_dropped(spark.read.text(str(path)), ADMIN1_PROPERTIES).head()
    assert (counts["n_polygonal"], counts["n_dropped"]) == (3, 1)
    with pytest.raises(Exception, match="lacks a required property"):
        geojson.read_feature_lines(spark, str(path), ADMIN1_PROPERTIES, strict=True).collect()


def test_attach_fails_on_repeated_keys(spark):
    summary = spark.createDataFrame([("A", 1.0)], "adm1_code string, population double")
    twice = spark.createDataFrame([("A", 1), ("A", 2)], "adm1_code string, x int")
    with pytest.raises(Exception, match="several regions share A"):
        region_ops.attach_regions(summary, twice).collect()


def test_catalog(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("AAA,First\nBBB,Second\n")
    codes = catalog.read_catalog(spark, str(path))
    asked = spark.createDataFrame([("aaa",), ("zzz",)], "code string")
    lenient = {r["code"]: r["known"] for r in catalog.resolve_codes(asked, codes, strict=False).collect()}
    assert lenient == {"AAA": True, "ZZZ": False}
    with pytest.raises(Exception, match="unknown country code ZZZ"):
        catalog.resolve_codes(asked, codes).collect()
    assert [r["code"] for r in catalog.include(codes, ["AAA"]).collect()] == ["AAA"]
    assert [r["code"] for r in catalog.exclude(codes, ["AAA"]).collect()] == ["BBB"]
    numbered = spark.createDataFrame([(3, "AAA"), (8, "BBB")], "src int, code string")
    assert catalog.source_ids(numbered, ["bbb", "AAA"]) == [8, 3]
    with pytest.raises(ValueError, match="ZZZ"):
        catalog.source_ids(numbered, ["AAA", "zzz"])
    url = asked.select(catalog.source_url("base", F.col("code")).alias("u")).head()["u"]
    assert url == "base/AAA/aaa_ppp_2020.tif"


def test_attributes(spark, tmp_path):
    path = tmp_path / "attributes.csv"
    path.write_text("First,AAA,SU_A3\nSecond,BBB,ISO_A3\n")
    rows = catalog.read_attributes(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("First", "AAA", "SU_A3"), ("Second", "BBB", "ISO_A3")]


def test_utm_and_mercator(spark):
    point = spark.createDataFrame([(3.0, 45.0)], "lon double, lat double")
    zone = projections.utm_zone(F.col("lon"))
    e, n = projections.utm_coordinates(F.col("lon"), F.col("lat"), zone, F.lit(False))
    row = point.select(zone.alias("z"), e.alias("e"), n.alias("n")).head()
    assert row["z"] == 31 and row["e"] == pytest.approx(500000.0)
    assert row["n"] == pytest.approx(4982950.400, abs=1e-3)
    x, y = projections.mercator_x(F.col("lon")), projections.mercator_y(F.col("lat"))
    back = point.select(
        projections.mercator_lon(x).alias("lon"), projections.mercator_lat(y).alias("lat")
    ).head()
    assert (back["lon"], back["lat"]) == (pytest.approx(3.0), pytest.approx(45.0))


def test_area_takes_holes_off(spark):
    whole = {"a": [[square(0, 45, 1)]]}
    holed = {"a": [[square(0, 45, 1), square(0.25, 45.25, 0.5)]]}
    areas = [
        area.region_areas(region_ops.explode_parts(micro.regions(spark, n))).head()
        for n in (whole, holed)
    ]
    # one degree square at 45 N on the ellipsoid, projected: close to 8 700 square kilometres
    assert areas[0]["area_km2"] == pytest.approx(8710, rel=0.01)
    assert areas[1]["area_km2"] == pytest.approx(areas[0]["area_km2"] * 0.75, rel=0.001)
    assert areas[0]["area"] == pytest.approx(areas[0]["area_km2"] * 1000)


def test_centroid_of_a_square_with_a_hole(spark):
    holed = {"a": [[square(0, 0, 4), square(2, 2, 2)[::-1]]]}
    row = area.part_centroids(region_ops.explode_parts(micro.regions(spark, holed))).head()
    assert row["centroid_x"] == pytest.approx((16 * 2 - 4 * 3) / 12)


def test_alignment_reports_the_offset(spark):
    grids = spark.createDataFrame(
        [(-170.0, -90.0, 1.0, 1.0), (-170.0 + 0.50088, -90.0, 1.0, 1.0), (-170.0, -90.0, 0.9, 0.9)],
        "xmin double, ymin double, cell_width double, cell_height double",
    )
    rows = check_alignment(grids, GridSpec(-180.0, -90.0, 180.0, 90.0, 1.0, 1.0, 16)).collect()
    assert [r["aligned"] for r in rows] == [True, False, False]
    assert rows[1]["x_offset"] == pytest.approx(1 - 0.50088)


def test_merged_sketches(spark):
    values = [(k, v, float(v % 40)) for k in (1, 2) for v in range(400)]
    table = spark.createDataFrame(values, "k int, i int, value double")
    partial = table.groupBy("k", (F.col("i") % 7).alias("m")).agg(
        F.histogram_numeric("value", F.lit(64)).alias("distribution")
    )
    merged = histograms.merge_distributions(partial, "k").collect()
    assert len(merged) == 2
    for row in merged:
        assert [(b["x"], b["y"]) for b in row["distribution"]] == [(float(v), 10.0) for v in range(40)]


def test_merging_bins_keeps_count_and_mean():
    import numpy as np

    rng = np.random.default_rng(1)
    x, y = rng.random(300), rng.integers(1, 9, 300).astype(float)
    a, b = histograms.merge_bins(x, y, 64)
    assert len(a) == 64 and (np.diff(a) > 0).all()
    assert b.sum() == pytest.approx(y.sum()) and (a * b).sum() == pytest.approx((x * y).sum())


def test_reports(spark, tmp_path):
    named = {"a, b": [[square(0, 0, 4)]], "none": [[square(20, 0, 4)]]}
    regions = micro.regions(spark, named)
    cells = micro.cells(spark, block(0, 180, 80, 10, 10, 2.5) + [(0, 201, 87, None)])
    extents = micro.sources(spark, (0, 0, 0, 24, 10))
    result = admin1_population(regions, cells, extents, GRID)
    output = str(tmp_path / "report")
    write_reports(result, regions, output)

    table = spark.read.option("header", True).csv(output + ".csv")
    assert tuple(table.columns) == reports.ADMIN_HEADER
    rows = {r["adm1_code"]: r for r in table.collect()}
    assert rows["A0"]["population"] == "40" and rows["A0"]["mean"] == "2.5"
    assert rows["A1"]["population"] == "0" and rows["A1"]["min"] == "null"

    lines = [json.loads(r["value"]) for r in spark.read.text(output + ".geojson").collect()]
    by_code = {f["properties"]["adm1_code"]: f for f in lines}
    assert by_code["A0"]["geometry"] == {"type": "MultiPolygon", "coordinates": [[square(0, 0, 4)]]}
    assert by_code["A0"]["properties"]["stats"]["zmax"] == 2.5
    assert by_code["A1"]["properties"]["stats"] is None

    text = "\n".join(r["value"] for r in spark.read.text(output + "_quantile.json").collect())
    breaks = json.loads(text)
    assert breaks["population"] == [0.0] * 5 + [40.0] * 5 and len(breaks["density"]) == 10

    named_result = region_population(regions, cells, extents, GRID)
    reports.write_region_csv(named_result, str(tmp_path / "regions.csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "regions.csv"))
    assert {r["location_name"]: r["population"] for r in back.collect()} == {"a, b": "40", "none": "0"}


def test_map_tiles_are_written_by_zoom(spark, tmp_path):
    cells = micro.cells(spark, block(0, 180, 80, 10, 10, 3.0))
    path = str(tmp_path / "map")
    map_tiles.write_map_tiles(render_tiles(cells, GRID, path, base_zoom=3, tile_size=16), path)
    assert {r["zoom"] for r in spark.read.parquet(path).select("zoom").collect()} == {0, 1, 2, 3}
