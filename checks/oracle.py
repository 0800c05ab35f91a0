"""SQL for the queries, on the same tables."""

from __future__ import annotations

from checks.fixtures import (
    AREAS,
    CANDIDATES,
    CELLS,
    MASK,
    MOSAIC,
    OFF_GRID_CELLS,
    PARTS,
    RESIZED_CELLS,
    SHARED_VERTICES,
    SOURCES,
    VERTICES,
    with_views,
)

ORACLE: dict[str, str] = {}


def oracle(name: str, *views: str, body: str) -> None:
    ORACLE[name] = with_views(*views, body=body) if views else body


# --- sources ---------------------------------------------------------------------------------

REQUESTS = """requests as (
 select c_custkey, case when c_custkey%10=3 then 'atlantis' else lower(n_name) end as code
 from customer join nation on c_nationkey=n_nationkey)"""

oracle(
    "catalog_lookup",
    body="""select n_name as code, 'Country '||n_name as name, count(*) as n_requests
 from customer join nation on c_nationkey=n_nationkey group by 1,2""",
)
oracle(
    "resolve_codes",
    REQUESTS,
    body="""select c_custkey, upper(code) as code,
 case when n_name is not null then 'Country '||n_name end as name, n_name is not null as known
 from requests left join nation on upper(code)=n_name""",
)
oracle(
    "source_url",
    REQUESTS,
    body="select c_custkey, 'store/rasters/'||upper(code)||'/'||code||'_ppp_2020.tif' as url from requests",
)
oracle(
    "country_include",
    REQUESTS,
    body="""select c_custkey, upper(code) as code from requests
 where upper(code) in (select n_name from nation where n_name like '%1')""",
)
oracle(
    "country_exclude",
    REQUESTS,
    body="""select c_custkey, upper(code) as code from requests
 where upper(code) not in (select n_name from nation where n_name like '%1')""",
)
oracle(
    "country_attrs",
    body="""select c_name as name, 'C'||cast(c_custkey as varchar) as code,
 case when c_custkey%7=0 then 'ISO_A3' else 'SU_A3' end as join_attribute from customer""",
)
oracle(
    "sources_of_codes",
    body="""select distinct n_name as code, cast(s_suppkey as int) as src
 from supplier join nation on s_nationkey=n_nationkey where n_name like '%A'""",
)
oracle(
    "geojson_regions",
    VERTICES,
    body="""select region_id, adm1_code, adm0_a3,
 cast(count(distinct part) as int) as n_parts,
 cast(count(distinct part*10+ring) as int) as n_rings, cast(count(*) as int) as n_vertices,
 round(sum(x),6)+0e0 as sum_x, round(sum(y),6)+0e0 as sum_y from vertices group by 1,2,3""",
)
oracle(
    "raster_scan",
    CELLS, VERTICES, SOURCES, CANDIDATES,
    body="""select c.src, c.col//16 as tile_col, c.row//16 as tile_row,
 cast(count(c.value) as int) as n_data, coalesce(sum(c.value),0) as total
 from cells c join (select distinct tile_col, tile_row from candidates) w
 on c.col//16=w.tile_col and c.row//16=w.tile_row group by 1,2,3""",
)

ORACLE["raster_scan_ranges"] = ORACLE["raster_scan"]
oracle(
    "admin0_regions",
    VERTICES,
    body="""select adm0_a3, cast(count(distinct region_id*10+part) as int) as n_parts, cast(count(*) as int) as n_vertices,
 round(sum(x),6)+0e0 as sum_x, cast(1 as bigint) as n_regions from vertices group by 1""",
)

# --- projections and scalar functions --------------------------------------------------------

oracle(
    "region_parts",
    VERTICES,
    body="""select region_id, adm1_code, part, cast(count(distinct ring) as int) as n_rings,
 min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from vertices group by 1,2,3""",
)
oracle(
    "band_select",
    body="select l_orderkey, l_linenumber, l_quantity as value from lineitem",
)
oracle(
    "nodata_filter",
    CELLS,
    body="""select src, count(*) as n_data, sum(value) as total from cells
 where value is not null and (col+row)%19<>0 group by 1""",
)

GRIDS = """grids as (
 select p_partkey as grid_id,
  -180e0+p_partkey%40*7
   +case when p_partkey%6=0 then 1e0/(p_partkey%12+1)*0.50088e0 else 0e0 end as xmin,
  -90e0+p_partkey%9*3 as ymin, 180e0 as xmax, 90e0 as ymax, 1e0/(p_partkey%12+1) as cell,
  cast((p_partkey%4+1)*64 as int) as tile_size from part),
layouts as (
 select *, cast(floor((xmax-xmin)/cell+0.5e0) as int) as grid_cols,
  cast(floor((ymax-ymin)/cell+0.5e0) as int) as grid_rows,
  cast(ceil(floor((xmax-xmin)/cell+0.5e0)/tile_size) as int) as layout_cols,
  cast(ceil(floor((ymax-ymin)/cell+0.5e0)/tile_size) as int) as layout_rows from grids)"""

oracle(
    "grid_layout",
    GRIDS,
    body="""select grid_id, tile_size, layout_cols, layout_rows, layout_cols*tile_size as cols,
 layout_rows*tile_size as rows from layouts""",
)
oracle(
    "grid_layout_check",
    GRIDS,
    body="""select grid_id, grid_id%7<>0 as tiles_ok, grid_id%11<>0 as cells_ok,
 grid_id%13<>0 as cell_width_ok, grid_id%11<>0 as cell_height_ok from layouts""",
)
oracle(
    "grid_families",
    body="""with recursive grids as (
 select p_partkey as grid_id, cell, (p_partkey%40*7+p_partkey%3*0.004e0-0.004e0+case when p_partkey%6=0 then 0.3e0 else 0e0 end)*cell as xmin,
  (p_partkey%9*3+0.25e0)*cell as ymin
 from (select p_partkey, 1e0/(p_partkey%12+1)*(1e0+p_partkey%5*0.004e0) as cell from part) p),
phased as (select *, xmin/cell-floor(xmin/cell) as px, ymin/cell-floor(ymin/cell) as py from grids),
shapes as (select cell, px, py, min(grid_id) as id, count(*) as n from phased group by 1,2,3),
near as (
 select a.id as a, b.id as b from shapes a join shapes b on abs(ln(a.cell)-ln(b.cell))<=0.01e0
  and least(abs(a.px-b.px), 1-abs(a.px-b.px))<=0.01e0 and least(abs(a.py-b.py), 1-abs(a.py-b.py))<=0.01e0),
reached as (select a, b from near union select r.a, n.b from reached r join near n on r.b=n.a),
named as (select a, min(b) as family from reached group by 1),
sizes as (select family, sum(n) as n_grids from named join shapes on a=id group by 1)
select g.grid_id, f.family, cast(s.n_grids as bigint) as n_grids from phased g
 join shapes h on g.cell=h.cell and g.px=h.px and g.py=h.py join named f on h.id=f.a join sizes s on f.family=s.family""",
)
oracle(
    "grid_align_check",
    GRIDS,
    body="""select grid_id, cell between 0.99e0 and 1.01e0 as x_size_ok, cell between 0.99e0 and 1.01e0 as y_size_ok,
 x<=0.01e0 as x_aligned, y<=0.01e0 as y_aligned,
 cell between 0.99e0 and 1.01e0 and x<=0.01e0 and y<=0.01e0 as aligned, round(x,4)+0e0 as x_offset
 from (select grid_id, cell, abs((xmin+173)/cell-round((xmin+173)/cell)) as x,
  abs((ymin+87)/cell-round((ymin+87)/cell)) as y from grids) g""",
)
oracle(
    "tile_key",
    CELLS,
    body="""select src, col, row, cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row,
 cast(row%16*16+col%16 as int) as idx from cells""",
)
oracle(
    "tile_extent",
    CELLS,
    body="""select distinct cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row,
 -180e0+col//16*16 as xmin, 90e0-(row//16+1)*16 as ymin, -180e0+(col//16+1)*16 as xmax,
 90e0-row//16*16 as ymax from cells""",
)
oracle(
    "source_tile_keys",
    CELLS, SOURCES.replace("sources as (", "declared as (", 1).split("source_keys as (")[0].rstrip().rstrip(","),
    body="""select src, tile_col, tile_row from tile_keys t join
 (select src, min(col) as c0, max(col) as c1, min(row) as r0, max(row) as r1 from cells group by 1) s
 on tile_col between c0//16 and c1//16 and tile_row between r0//16 and r1//16""",
)

COARSE_X, COARSE_Y, COARSE_STEP = repr(-180.0 + 0.50088), "89.75", "1.5e0"

oracle(
    "resample_nearest",
    CELLS,
    body=f"""select c.src, x.t as col, y.t as row, c.value
 from cells c
 join (select cast(range as int) as t, floor({COARSE_X}e0+(range+0.5e0)*{COARSE_STEP}+180) as s from range(240)) x
  on c.col=x.s
 join (select cast(range as int) as t, floor(90-({COARSE_Y}e0-(range+0.5e0)*{COARSE_STEP})) as s from range(120)) y
  on c.row=y.s""",
)


def axis(name: str, position: str, size: int) -> str:
    """Neighbours of every target of one axis with their weights."""
    return f"""{name} as (
 select t, cast(floor(f)+k as int) as s, case k when 0 then 1-(f-floor(f)) else f-floor(f) end as w
 from (select cast(range as int) as t, {position}-0.5e0 as f from range({size})) a
 cross join (values (0),(1)) as n(k)
 where case k when 0 then 1-(f-floor(f)) else f-floor(f) end > 0)"""


BILINEAR = """sampled as (
 select c.src, x.t as col, y.t as row, sum(x.w*y.w*c.value)/sum(x.w*y.w) as value
 from cells c join ax x on c.col=x.s join ay y on c.row=y.s where c.value is not null
 group by 1,2,3)"""

oracle(
    "resample_bilinear",
    CELLS,
    axis("ax", f"({COARSE_X}e0+(range+0.5e0)*{COARSE_STEP}+180)", 240),
    axis("ay", f"(90-({COARSE_Y}e0-(range+0.5e0)*{COARSE_STEP}))", 120),
    BILINEAR,
    body="select src, col, row, round(value,6)+0e0 as value from sampled",
)
oracle(
    "mercator_xy",
    VERTICES,
    body="""select region_id, part, ring, i, round(mx,3)+0e0 as mx, round(my,3)+0e0 as my,
 round(mx*180/20037508.342789244e0,6)+0e0 as lon,
 round(degrees(2*atan(exp(my/6378137e0))-pi()/2),6)+0e0 as lat
 from (select *, 20037508.342789244e0*x/180 as mx, 6378137e0*ln(tan(pi()/4+radians(y)/2)) as my
  from vertices) v""",
)

_ZOOM = ",\n ".join(
    f"""case when abs(my)<=20037508.342789244e0 then cast(least({2**z - 1},
  floor((mx+20037508.342789244e0)/40075016.685578488e0*{2**z})) as int) end as x{z},
 case when abs(my)<=20037508.342789244e0 then cast(least({2**z - 1},
  floor((20037508.342789244e0-my)/40075016.685578488e0*{2**z})) as int) end as y{z}"""
    for z in (3, 6, 12)
)
oracle(
    "zoom_tile_key",
    CELLS,
    body=f"""select col, row, {_ZOOM} from (
 select col, row, 20037508.342789244e0*(-180e0+(col+0.5e0))/180 as mx,
  6378137e0*ln(tan(pi()/4+radians(90e0-(row+0.5e0))/2)) as my
 from (select distinct col, row from cells) d) p""",
)
oracle(
    "region_centroid",
    VERTICES, AREAS,
    body="""select region_id, part, round(cx,6)+0e0 as centroid_x, round(cy,6)+0e0 as centroid_y
 from centroids""",
)
oracle("utm_zone", VERTICES, AREAS, body="select region_id, part, utm_zone, south from zones")
oracle(
    "utm_project",
    VERTICES, AREAS,
    body="""select region_id, part, ring, i, utm_zone, round(e+500000,2)+0e0 as easting,
 round(n+case when south then 10000000 else 0 end,2)+0e0 as northing from utm""",
)
oracle(
    "region_area",
    VERTICES, AREAS,
    body="select region_id, round(area,1)+0e0 as area, round(area_km2,2)+0e0 as area_km2 from areas",
)
oracle(
    "density",
    CELLS, VERTICES, MASK, AREAS,
    body="""select s.region_id, round(population/area*1e6,6)+0e0 as density_e6,
 round(population/area_km2,9)+0e0 as density_km2
 from (select region_id, sum(value) as population from masked group by 1) s
 join areas a on s.region_id=a.region_id""",
)
oracle(
    "truncate_long",
    body="""select l_orderkey, l_linenumber, l_partkey,
 cast(trunc(l_extendedprice*(0.05e0-l_discount)) as bigint) as whole from lineitem""",
)


def color_case(value: str, colors: list[int], breaks: list[int]) -> str:
    """Colour of the first break not below a value; later classes share the last colour."""
    pairs = [(b, colors[min(i, len(colors) - 1)]) for i, b in enumerate(breaks)]
    whens = " ".join(f"when {value}<={b} then {c}" for b, c in pairs)
    return f"cast(case when {value} is null then 0 {whens} else {pairs[-1][1]} end as bigint)"


MAP = [0, 0xFFF7FBFF, 0xECE7F2FF, 0xD0D1E6FF, 0xA6BDDBFF, 0x74A9CFFF, 0x3690C0FF, 0x0570B0FF, 0x034E7BFF]
ORANGE = [0, 0xFEE6CEFF, 0xFDD0A2FF, 0xFDAE6BFF, 0xFD8D3CFF, 0xF16913FF, 0xD94801FF, 0xA63603FF, 0x7F2704FF]
BLUE = [0, 0xDFECF8, 0xC8DDF0, 0xA3CCE3, 0x73B3D8, 0x4A97C9, 0x2879B9, 0x0D58A1, 0x08306B]
BREAKS = [1, 2, 5, 10, 20, 50, 100, 200, 1000]
TWOFOLD = [1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1025, 2048]

oracle(
    "color_classify",
    CELLS, MOSAIC,
    body=f"select col, row, {color_case('value', MAP, BREAKS)} as color from mosaic",
)
oracle(
    "color_classify_alt",
    CELLS,
    body=f"""select src, col, row, {color_case('value', ORANGE, BREAKS)} as orange,
 {color_case('value', BLUE, TWOFOLD)} as blue from cells""",
)
oracle(
    "tile_path",
    CELLS,
    body="""select distinct src, cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row,
 'out/'||src||'/'||(col//16)||'/'||(row//16)||'.png' as path from cells""",
)

# --- filters, joins and spatial predicates ---------------------------------------------------

oracle(
    "antimeridian_filter",
    VERTICES, PARTS,
    body="select region_id, part, xmin, xmax from kept",
)
oracle(
    "tile_region_candidates",
    VERTICES, PARTS, SOURCES, CANDIDATES,
    body="""select c.region_id, c.part, tile_col, tile_row from candidates c join kept k
 on c.region_id=k.region_id and c.part=k.part""",
)
oracle(
    "tile_multiregion_candidates",
    VERTICES, SOURCES, CANDIDATES,
    body="select distinct region_id, tile_col, tile_row from candidates",
)
oracle(
    "mask_spans",
    VERTICES,
    body="""select e.region_id, e.part, p.row, p.col
 from (select cast(a.range as int) as col, cast(b.range as int) as row
  from range(360) a cross join range(180) b) p
 join edges e on ((e.y1 > 90-p.row-0.5e0) <> (e.y2 > 90-p.row-0.5e0))
  and (-180+p.col+0.5e0) < (e.x2-e.x1)*((90-p.row-0.5e0)-e.y1)/nullif(e.y2-e.y1,0)+e.x1
 group by 1,2,3,4 having count(*)%2=1""",
)
oracle(
    "mask_hierarchy",
    VERTICES, SOURCES, CANDIDATES,
    body="""select c.region_id, c.part, c.tile_col, c.tile_row, w.part is not null as whole,
 cast(count(*) as int) as n_covered
 from (select e.region_id, e.part, cast(p.col//16 as int) as tile_col, cast(p.row//16 as int) as tile_row
  from (select a.range as col, b.range as row from range(360) a cross join range(180) b) p
  join edges e on ((e.y1 > 90-p.row-0.5e0) <> (e.y2 > 90-p.row-0.5e0))
   and (-180+p.col+0.5e0) < (e.x2-e.x1)*((90-p.row-0.5e0)-e.y1)/nullif(e.y2-e.y1,0)+e.x1
  group by e.region_id, e.part, p.col, p.row having count(*)%2=1) c
 left join (select * from corner_tiles except select * from edge_tiles) w
  on c.region_id=w.region_id and c.part=w.part and c.tile_col=w.tile_col and c.tile_row=w.tile_row
 group by 1,2,3,4,5""",
)
oracle(
    "cell_in_region",
    CELLS, VERTICES, MASK,
    body="""select region_id, part, src, count(*) as n_cells, sum(value) as total,
 cast(sum(col*1000+row) as bigint) as place_sum from masked group by 1,2,3""",
)
oracle(
    "attach_region",
    CELLS, VERTICES, MASK,
    body="""select v.adm1_code, v.adm0_a3, m.population, v.n_parts from
 (select region_id, sum(value) as population from masked group by 1) m join
 (select region_id, adm1_code, adm0_a3, cast(count(distinct part) as int) as n_parts
  from vertices group by 1,2,3) v on m.region_id=v.region_id""",
)
oracle(
    "tile_source_pairs",
    CELLS, SOURCES,
    body="""select k.src, k.tile_col, k.tile_row, cast(count(c.value) as int) as n_data
 from source_keys k join cells c on c.src=k.src and c.col//16=k.tile_col and c.row//16=k.tile_row
 group by 1,2,3""",
)

# --- aggregations ----------------------------------------------------------------------------

UNION_SUMS = """select region_id, sum(value) as population, count(*) as n_cells from
 (select distinct region_id, src, col, row, value from masked) m group by 1"""

oracle("zonal_sum", CELLS, VERTICES, MASK, body=UNION_SUMS)
oracle("zonal_sum_tiles", CELLS, VERTICES, MASK, body=UNION_SUMS)
oracle("zonal_sum_prefix", CELLS, VERTICES, MASK, body=UNION_SUMS)

# the area of a cell to the right of each edge, from the integral of its width; shells for, holes against
COVERED = """sided as (
 select e.*, case when ring=0 then 1e0 else -1e0 end
  *sign(sum(x1*y2-x2*y1) over (partition by region_id, part, ring)) as side from edges e),
banded as (
 select *, greatest(least(90-y1,90-y2), row) as top, least(greatest(90-y1,90-y2), row+1) as bottom
 from (select *, unnest(range(cast(floor(least(90-y1,90-y2)) as int), cast(ceil(greatest(90-y1,90-y2)) as int))) as row
  from sided where y1<>y2) s),
widths as (
 select region_id, part, col, row, side*sign(y1-y2)*(bottom-top) as h,
  col+1-(x1+180+(top-(90-y1))*(x2-x1)/(y1-y2)) as ua, col+1-(x1+180+(bottom-(90-y1))*(x2-x1)/(y1-y2)) as ub
 from banded cross join (select range as col from range(360)) c where col+1 > least(x1,x2)+180),
integrals as (
 select *, case when ua<=0 then 0 when ua<1 then ua*ua/2 else ua-0.5e0 end as ia,
  case when ub<=0 then 0 when ub<1 then ub*ub/2 else ub-0.5e0 end as ib from widths),
covered as (
 select region_id, part, col, row,
  sum(h*case when abs(ub-ua)<1e-12 then greatest(0e0, least(1e0, ua)) else (ib-ia)/(ub-ua) end) as share
 from integrals group by 1,2,3,4)"""
oracle(
    "zonal_sum_shares",
    CELLS, VERTICES, COVERED,
    body="""select region_id, part, round(sum(value*share),6)+0e0 as population, round(sum(share),6)+0e0 as covered
 from covered a join cells c on a.col=c.col and a.row=c.row where value is not null and share>1e-9 group by 1,2""",
)
oracle(
    "zonal_summary",
    CELLS, VERTICES, MASK,
    body="""select region_id, sum(value) as population, count(*) as n_cells, true as bins_ok, true as inside
 from masked group by 1""",
)
oracle(
    "zonal_summary_totals",
    CELLS, VERTICES, MASK,
    body="""select region_id, sum(value) as population, count(*) as n_cells,
 round(sum(value),3) as weighted, true as bins_ok from masked group by 1""",
)
oracle(
    "zonal_histogram",
    CELLS, VERTICES, MASK,
    body="select src, value, count(*) as n_cells from masked group by 1,2",
)
oracle(
    "histogram_merge",
    CELLS, VERTICES, MASK,
    body="""select region_id, count(*) as n_cells, round(sum(value),3) as weighted, true as bins_ok
 from masked group by 1""",
)

STATS = """stats as (
 select s.*, m.value as mode from (
  select region_id, sum(value) as population, count(*) as n_cells, min(value) as zmin,
   max(value) as zmax, avg(value) as mean, quantile_disc(value, 0.5) as median,
   stddev_pop(value) as stddev from counted group by 1) s
 join (select region_id, value, row_number() over (partition by region_id order by n desc, value) as nth
  from (select region_id, value, count(*) as n from counted group by 1,2) c) m
 on s.region_id=m.region_id and m.nth=1)"""

oracle(
    "zonal_stats",
    CELLS, VERTICES, MASK, "counted as (select * from masked)", STATS,
    body="""select region_id, population, n_cells, zmin, zmax, round(mean,6)+0e0 as mean, median, mode,
 round(stddev,6)+0e0 as stddev from stats""",
)
oracle(
    "sketch_stats",
    CELLS, VERTICES, MASK,
    body="""select region_id, count(*) as n_cells, min(value) as zmin, max(value) as zmax,
 round(avg(value),6)+0e0 as mean, true as mean_ok, true as stddev_ok, true as ranks_ok, true as mode_ok,
 true as ends_ok from masked group by 1""",
)
oracle(
    "zonal_refresh",
    CELLS, VERTICES, MASK,
    body="""select region_id, count(*) as n_cells, sum(value) as population, round(sum(value),3) as weighted,
 min(value) as zmin, max(value) as zmax, round(stddev_pop(value),6)+0e0 as stddev from masked group by 1""",
)
oracle(
    "zonal_combine",
    CELLS, VERTICES, MASK,
    body="""select region_id, sum(value) as population, count(*) as n_cells,
 count(distinct (col//16)*1000000+(row//16)*1000+src) as n_partials from masked group by 1""",
)

KEPT_MASK = """counted as (
 select m.* from masked m join kept k on m.region_id=k.region_id and m.part=k.part)"""
VISITED = """visited as (
 select c.region_id, count(*) as n_tiles from
  (select distinct c.region_id, tile_col, tile_row from candidates c join kept k
   on c.region_id=k.region_id and c.part=k.part) c
  join source_keys s on c.tile_col=s.tile_col and c.tile_row=s.tile_row group by 1)"""

oracle(
    "zonal_outcome",
    CELLS, VERTICES, PARTS, MASK, KEPT_MASK, SOURCES, CANDIDATES, VISITED,
    body="""select r.region_id, case when n_tiles is null then 'absent' when n_cells is null then 'empty'
  else 'value' end as outcome, coalesce(n_tiles,0) as n_tiles, coalesce(n_cells,0) as n_cells,
 coalesce(population,0) as population
 from (select distinct region_id from vertices) r
 left join visited v on r.region_id=v.region_id
 left join (select region_id, count(*) as n_cells, sum(value) as population from counted group by 1) s
  on r.region_id=s.region_id""",
)
oracle("mosaic", CELLS, MOSAIC, body="select col, row, value from mosaic")
oracle("mosaic_tiles", CELLS, MOSAIC, body="select col, row, value from mosaic")

SHARES = "[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]"
oracle(
    "quantile_breaks",
    body=f"""select cast(generate_subscripts(p,1)-1 as int) as i, unnest(p) as price, unnest(q) as custkey
 from (select quantile_disc(o_totalprice, {SHARES}) as p,
  quantile_disc(cast(o_custkey as double), {SHARES}) as q from orders) b""",
)
oracle(
    "layer_summary",
    CELLS,
    body="""select count(distinct src) as n_sources, count(*) as n_cells, count(value) as n_data,
 sum(value) as total, -180e0+min(col) as xmin, 90e0-(max(row)+1) as ymin, -180e0+max(col)+1 as xmax,
 90e0-min(row) as ymax, cast(min(col)//16 as int) as min_tile_col,
 cast(max(col)//16 as int) as max_tile_col, cast(min(row)//16 as int) as min_tile_row,
 cast(max(row)//16 as int) as max_tile_row,
 cast(ceil(count(*)*8/134217728e0) as bigint) as n_partitions from cells""",
)


def levels(base: str, top: int = 4) -> str:
    """Levels from ``top`` down to 0 from a base of (col, row, value)."""
    chain = [f"l{top} as (select col, row, value from {base})"]
    for z in reversed(range(top)):
        chain.append(
            f"l{z} as (select cast(col//2 as int) as col, cast(row//2 as int) as row,"
            f" avg(value) as value from l{z + 1} group by 1,2)"
        )
    union = " union all ".join(
        f"select {z} as zoom, col, row, value from l{z}" for z in range(top + 1)
    )
    chain.append(f"levels as ({union})")
    return ",\n".join(chain)


oracle(
    "pyramid",
    CELLS, MOSAIC, levels("mosaic"),
    body="select zoom, col, row, round(value+1e-9,6)+0e0 as value from levels",
)
oracle(
    "tile_pack",
    CELLS,
    body="""select t.src, t.tile_col, t.tile_row,
 string_agg(coalesce(cast(cast(c.value as bigint) as varchar),'-'),' ' order by i.range) as cells
 from (select distinct src, cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row from cells) t
 cross join range(256) i
 left join cells c on c.src=t.src and c.col=t.tile_col*16+i.range%16 and c.row=t.tile_row*16+i.range//16
 group by 1,2,3""",
)
oracle("tile_unpack", CELLS, body="select src, col, row, value from cells where value is not null")
oracle(
    "rebalance_tiles",
    CELLS,
    body="""select src, cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row,
 count(value) as n_data from cells group by 1,2,3""",
)

# --- jobs and their sinks --------------------------------------------------------------------

ADMIN = (
    CELLS, SHARED_VERTICES, PARTS, MASK, KEPT_MASK, SOURCES, CANDIDATES, VISITED, AREAS, STATS,
    """admin as (
 select f.adm1_code, f.adm0_a3, v.region_id,
  cast(trunc(coalesce(s.population,0)) as bigint) as population,
  coalesce(s.population,0)/a.area as density, coalesce(s.population,0)/a.area_km2 as density_km2,
  v.n_tiles, coalesce(s.n_cells,0) as n_cells, zmin, zmax, mean, median, mode, stddev
 from visited v
 join (select distinct region_id, adm1_code, adm0_a3 from vertices) f on v.region_id=f.region_id
 join areas a on v.region_id=a.region_id left join stats s on v.region_id=s.region_id)""",
)

ADMIN_ROWS = """select adm1_code, adm0_a3, population, round(density*1e6,6)+0e0 as density_e6,
 round(density_km2,9)+0e0 as density_km2, n_tiles, n_cells, zmin, zmax, round(mean,6)+0e0 as mean,
 median, mode, round(stddev,6)+0e0 as stddev from admin"""
oracle("admin1_population", *ADMIN, body=ADMIN_ROWS)
oracle("admin1_population_tiles", *ADMIN, body=ADMIN_ROWS)
oracle("admin1_population_offgrid", OFF_GRID_CELLS, *ADMIN[1:], body=ADMIN_ROWS)
oracle(
    "admin1_population_sketch",
    *ADMIN,
    body="""select adm1_code, adm0_a3, population, round(density*1e6,6)+0e0 as density_e6,
 round(density_km2,9)+0e0 as density_km2, n_tiles, n_cells, zmin, zmax, round(mean,6)+0e0 as mean,
 round(stddev,6)+0e0 as stddev, case when n_cells>0 then true end as median_ok,
 case when n_cells>0 then true end as mode_ok, case when n_cells>0 then n_cells end as n_in_sketch from admin""",
)


def text(value: str) -> str:
    return f"coalesce(cast(round({value},6) as varchar),'null')"


oracle(
    "admin_csv",
    *ADMIN,
    body=f"""select adm1_code, adm0_a3, cast(population as varchar) as population,
 cast(cast(trunc(density) as bigint) as varchar) as density, {text('zmin')} as min,
 {text('zmax')} as max, {text('mean')} as mean, {text('median')} as median, {text('mode')} as mode,
 {text('stddev')} as stddev from admin""",
)
oracle(
    "admin_geojson",
    *ADMIN,
    body="""select 'Feature' as type, 'MultiPolygon' as geometry_type, a.adm1_code, a.adm0_a3, population,
 zmax, n_parts, n_vertices from admin a join
 (select region_id, cast(count(distinct part) as int) as n_parts, cast(count(*) as int) as n_vertices
  from vertices group by 1) v on a.region_id=v.region_id""",
)
oracle(
    "quantile_json",
    *ADMIN,
    body=f"""select cast(generate_subscripts(p,1)-1 as int) as i, unnest(p) as population,
 round(unnest(d)*1e6,6)+0e0 as density_e6
 from (select quantile_disc(cast(population as double), {SHARES}) as p,
  quantile_disc(density, {SHARES}) as d from admin) b""",
)

REGION = """select v.location_name, cast(trunc(coalesce(population,0)) as bigint) as population
 from (select distinct region_id, location_name from vertices) v
 join (select distinct c.region_id from candidates c
  join source_keys k on c.tile_col=k.tile_col and c.tile_row=k.tile_row) t on v.region_id=t.region_id
 left join (select region_id, sum(value) as population from
  (select distinct region_id, src, col, row, value from masked) m group by 1) s
 on v.region_id=s.region_id"""

oracle("region_population", CELLS, VERTICES, MASK, SOURCES, CANDIDATES, body=REGION)
oracle("region_csv", CELLS, VERTICES, MASK, SOURCES, CANDIDATES, body=REGION)
oracle("region_population_offgrid", OFF_GRID_CELLS, VERTICES, MASK, SOURCES, CANDIDATES, body=REGION)

oracle("region_population_prefix", CELLS, VERTICES, MASK, SOURCES, CANDIDATES, body=REGION)
oracle("region_population_resized", RESIZED_CELLS, VERTICES, MASK, SOURCES, CANDIDATES, body=REGION)

H = "20037508.342789244e0"


def render(zoom: int) -> tuple[str, ...]:
    """Pixels of all levels from a base zoom with 16-pixel tiles."""
    n = 16 << zoom
    lon = f"(((range+0.5e0)*(2*{H}/{n})-{H})*180/{H})"
    lat = f"degrees(2*atan(exp(({H}-(range+0.5e0)*(2*{H}/{n}))/6378137e0))-pi()/2)"
    return (
        CELLS,
        axis("ax", f"({lon}+180)", n),
        axis("ay", f"(90-{lat})", n),
        BILINEAR,
        "warped as (select col, row, arg_min(value, src) as value from sampled group by 1,2)",
        levels("warped", zoom),
        f"pixels as (select zoom, col, row, {color_case('round(value,6)', MAP, BREAKS)} as color from levels)",
    )


RENDERED_TILES = """select t.zoom, t.tile_col, t.tile_row,
 'out/'||t.zoom||'/'||t.tile_col||'/'||t.tile_row||'.png' as path,
 string_agg(cast(coalesce(p.color,0) as varchar),' ' order by i.range) as rgba
 from (select distinct zoom, cast(col//16 as int) as tile_col, cast(row//16 as int) as tile_row from pixels) t
 cross join range(256) i
 left join pixels p on p.zoom=t.zoom and p.col=t.tile_col*16+i.range%16 and p.row=t.tile_row*16+i.range//16
 group by 1,2,3,4"""

oracle("render_pyramid", *render(4), body="select zoom, col, row, color from pixels")
oracle("render_tiles", *render(4), body=RENDERED_TILES)
oracle("render_tiles_fine", *render(5), body=RENDERED_TILES)
oracle("render_refresh", *render(5), body=RENDERED_TILES)
