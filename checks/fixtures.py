"""Rasters and regions derived from the given tables, in Spark and as SQL text.

Cells: a one-degree world grid with one source per nation, summed from ``lineitem``.
Regions: one per supplier. Part 0 is an L, with a square hole for every fifth region; odd regions
have a triangle as well, and every seventh a square that overlaps the L. Some touch the
antimeridian. Vertices stay off the cell centres.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.grid import GridSpec
from gridcensus.operators.tiles import pack_tiles

GRID = GridSpec(-180.0, -90.0, 180.0, 90.0, 1.0, 1.0, 16)
# the same cells read as a grid that lies half a cell off the job's, as country rasters do
OFF_GRID = GridSpec(-179.5, -89.5, 180.5, 90.5, 1.0, 1.0, 16)
# the same cells read as a grid of smaller cells that covers a part of the world
RESIZED = GridSpec(-160.0, -80.0, 164.0, 82.0, 0.9, 0.9, 16)

L_SHELL = ((0, 0), (35, 0), (35, 8), (15, 8), (15, 18), (0, 18))
L_HOLE = ((3, 3), (9, 3), (9, 6), (3, 6))
TRIANGLE = ((20, 12), (34, 12), (27, 21))
SQUARE = ((5, 5), (25, 5), (25, 14), (5, 14))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    placed = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).selectExpr(
        "cast(s_nationkey as int) as src",
        "cast((l_partkey * 37 + l_linenumber * 11 + l_orderkey) % 360 as int) as col",
        "cast((l_orderkey * 13 + l_suppkey * 7) % 180 as int) as row",
        "l_quantity",
    )
    summed = placed.groupBy("src", "col", "row").agg(F.sum("l_quantity").alias("v"))
    return summed.selectExpr("src", "col", "row", "case when (col + row) % 17 <> 0 then v end as value")


def _ring(offsets: tuple[tuple[int, int], ...]) -> str:
    corners = ", ".join(f"array({dx}D, {dy}D)" for dx, dy in offsets)
    return f"transform(array({corners}), v -> array(x + v[0], y + v[1]))"


GEOMETRY = f"""filter(array(
  case when k % 5 = 0 then array({_ring(L_SHELL)}, {_ring(L_HOLE)}) else array({_ring(L_SHELL)}) end,
  case when k % 2 = 1 then array({_ring(TRIANGLE)}) end,
  case when k % 7 = 0 then array({_ring(SQUARE)}) end), part -> part is not null)"""


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as k",
        "s_name",
        "s_nationkey",
        """case when s_suppkey % 25 = 24 then 145D when s_suppkey % 25 = 12 then -180D
           else -170.25D + (s_suppkey * 17 % 61) * 5 end as x""",
        "-80.25D + (s_suppkey * 7 % 29) * 5 as y",
    )
    return placed.selectExpr(
        "cast(k as int) as region_id",
        "s_name as location_name",
        "concat('A-', k) as adm1_code",
        "concat('N', s_nationkey) as adm0_a3",
        f"{GEOMETRY} as geom",
    )


def shared_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions, where every tenth has both codes of the one before it."""
    key = F.col("region_id") - F.when(F.col("region_id") % 10 == 9, 1).otherwise(0)
    return regions(spark, sf_dir).withColumns(
        {
            "adm1_code": F.concat(F.lit("A-"), key.cast("string")),
            "adm0_a3": F.concat(F.lit("N"), (key % 25).cast("string")),
        }
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared extents: every nation with suppliers has a grid of the whole world."""
    return (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_nationkey").cast("int").alias("src"))
        .distinct()
        .select(
            "src",
            F.lit(GRID.xmin).alias("xmin"),
            F.lit(GRID.ymin).alias("ymin"),
            F.lit(GRID.xmax).alias("xmax"),
            F.lit(GRID.ymax).alias("ymax"),
        )
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tiles(cells(spark, sf_dir), GRID.tile_size)


# --- the same as SQL -------------------------------------------------------------------------

CELLS = """cells as (
 select src, col, row, case when (col+row)%17=0 then cast(null as double) else v end as value from (
  select cast(s.s_nationkey as int) as src,
   cast((l.l_partkey*37+l.l_linenumber*11+l.l_orderkey)%360 as int) as col,
   cast((l.l_orderkey*13+l.l_suppkey*7)%180 as int) as row, sum(l.l_quantity) as v
  from lineitem l join supplier s on l.l_suppkey=s.s_suppkey group by 1,2,3) t)"""

_SHAPES = ", ".join(
    f"({shape},{ring},{i},{dx},{dy})"
    for shape, ring, offsets in ((0, 0, L_SHELL), (0, 1, L_HOLE), (1, 0, TRIANGLE), (2, 0, SQUARE))
    for i, (dx, dy) in enumerate(offsets)
)

# the job grid's cell (col, row) reads the cell (col, row + 1) of the grid half a cell off
OFF_GRID_CELLS = CELLS.replace("cells as", "own_cells as", 1) + """,
cells as (select src, col, row-1 as row, value from own_cells where row>0)"""

# the job's columns and rows read the cells that their centres lie in
RESIZED_CELLS = CELLS.replace("cells as", "own_cells as", 1) + """,
cells as (
 select c.src, x.t as col, y.t as row, c.value from own_cells c
 join (select cast(range as int) as t, cast(floor((-180+range+0.5e0+160)/0.9e0+1e-6) as int) as s from range(360)) x
  on c.col=x.s
 join (select cast(range as int) as t, cast(floor((82-(90-range-0.5e0))/0.9e0+1e-6) as int) as s from range(180)) y
  on c.row=y.s)"""


def _vertices_sql(key: str, adm0: str, part: str) -> str:
    return f"""vertices as (
 select cast({key} as int) as region_id, s_name as location_name,
  'A-'||cast({key} as varchar) as adm1_code, 'N'||cast({adm0} as varchar) as adm0_a3,
  cast({part} as int) as part,
  ring, i,
  case when k%25=24 then 145.0e0 when k%25=12 then -180.0e0 else -170.25e0+(k*17%61)*5 end + dx as x,
  -80.25e0+(k*7%29)*5+dy as y
 from (select s_suppkey as k, s_name, s_nationkey from supplier) s
 cross join (values {_SHAPES}) as v(shape,ring,i,dx,dy)
 where (shape=0 and (ring=0 or k%5=0)) or (shape=1 and k%2=1) or (shape=2 and k%7=0)),
edges as (
 select region_id, part, ring, x as x1, y as y1,
  coalesce(lead(x) over w, first_value(x) over w) as x2,
  coalesce(lead(y) over w, first_value(y) over w) as y2
 from vertices window w as (partition by region_id, part, ring order by i))"""


_PART = "case shape when 0 then 0 when 1 then 1 else 1+k%2 end"
VERTICES = _vertices_sql("k", "s_nationkey", _PART)
# regions that share both codes are one region of all their parts
_FIRST = "(k-case when k%10=9 then 1 else 0 end)"
SHARED_VERTICES = _vertices_sql(_FIRST, f"{_FIRST}%25", f"{_PART}+case when k%10=9 then 3 else 0 end")

# parts by bounding box, and those the antimeridian rule keeps
PARTS = """parts as (
 select region_id, part, min(x) as xmin, max(x) as xmax, min(y) as ymin, max(y) as ymax
 from vertices group by 1,2),
kept as (
 select * from parts
 where not (xmin<=180 and xmax>=180) and not (xmin<=-180 and xmax>=-180))"""

# positions inside parts by crossing parity, then the data cells at those positions
MASK = """covered as (
 select p.col, p.row, e.region_id, e.part
 from (select distinct col, row from cells where value is not null) p join edges e
  on ((e.y1 > 90-p.row-0.5e0) <> (e.y2 > 90-p.row-0.5e0))
  and (-180+p.col+0.5e0) < (e.x2-e.x1)*((90-p.row-0.5e0)-e.y1)/nullif(e.y2-e.y1,0)+e.x1
 group by 1,2,3,4 having count(*)%2=1),
masked as (
 select m.region_id, m.part, c.src, c.col, c.row, c.value
 from cells c join covered m on c.col=m.col and c.row=m.row where c.value is not null)"""

SOURCES = """sources as (
 select distinct cast(s_nationkey as int) as src, -180e0 as xmin, -90e0 as ymin,
  180e0 as xmax, 90e0 as ymax from supplier),
tile_keys as (
 select tile_col, tile_row, tile_col*16-180 as txmin, 90-(tile_row+1)*16 as tymin,
  (tile_col+1)*16-180 as txmax, 90-tile_row*16 as tymax
 from (select cast(range as int) as tile_col from range(23)) a
 cross join (select cast(range as int) as tile_row from range(12)) b),
source_keys as (
 select src, tile_col, tile_row from sources s join tile_keys t
  on t.txmin < s.xmax and t.txmax > s.xmin and t.tymin < s.ymax and t.tymax > s.ymin)"""

# tiles a part meets: an edge hits the closed tile, or the part holds its lower left corner
CANDIDATES = """edge_tiles as (
 select e.region_id, e.part, t.tile_col, t.tile_row from edges e join tile_keys t
  on not (e.x1=e.x2 and (e.x1<t.txmin or e.x1>t.txmax))
  and not (e.y1=e.y2 and (e.y1<t.tymin or e.y1>t.tymax))
  and greatest(0e0,
    least((t.txmin-e.x1)/nullif(e.x2-e.x1,0),(t.txmax-e.x1)/nullif(e.x2-e.x1,0)),
    least((t.tymin-e.y1)/nullif(e.y2-e.y1,0),(t.tymax-e.y1)/nullif(e.y2-e.y1,0)))
   <= least(1e0,
    greatest((t.txmin-e.x1)/nullif(e.x2-e.x1,0),(t.txmax-e.x1)/nullif(e.x2-e.x1,0)),
    greatest((t.tymin-e.y1)/nullif(e.y2-e.y1,0),(t.tymax-e.y1)/nullif(e.y2-e.y1,0)))),
corner_tiles as (
 select e.region_id, e.part, t.tile_col, t.tile_row from edges e join tile_keys t
  on ((e.y1 > t.tymin) <> (e.y2 > t.tymin))
  and t.txmin < (e.x2-e.x1)*(t.tymin-e.y1)/nullif(e.y2-e.y1,0)+e.x1
 group by 1,2,3,4 having count(*)%2=1),
candidates as (select * from edge_tiles union select * from corner_tiles)"""

MOSAIC = """mosaic as (
 select col, row, arg_min(value, src) as value from cells where value is not null group by 1,2)"""

# regions' areas: every part in the UTM zone of its centroid
AREAS = """moments as (
 select region_id, part, ring, sum(x1*y2-x2*y1) as a, sum((x1+x2)*(x1*y2-x2*y1)) as mx,
  sum((y1+y2)*(x1*y2-x2*y1)) as my from edges group by 1,2,3),
centroids as (
 select region_id, part, sum(side*sign(a)*mx)/6/(sum(side*sign(a)*a)/2) as cx,
  sum(side*sign(a)*my)/6/(sum(side*sign(a)*a)/2) as cy
 from (select *, case when ring=0 then 1e0 else -1e0 end as side from moments) m group by 1,2),
zones as (
 select region_id, part, cx, cy,
  cast(greatest(1, least(60, floor((cx+180)/6)+1)) as int) as utm_zone, cy<0 as south from centroids),
utm1 as (
 select v.region_id, v.part, v.ring, v.i, z.utm_zone, z.south, sin(radians(v.y)) as s,
  radians(v.x-(z.utm_zone*6e0-183e0)) as d
 from vertices v join zones z on v.region_id=z.region_id and v.part=z.part),
utm2 as (
 select *, 0.5e0*ln((1+s)/(1-s))-0.0818191908426215e0*0.5e0*
  ln((1+0.0818191908426215e0*s)/(1-0.0818191908426215e0*s)) as psi from utm1),
utm3 as (select *, (exp(psi)-exp(-psi))/2 as t from utm2),
utm4 as (
 select *, atan2(t, cos(d)) as xi,
  0.5e0*ln((1+sin(d)/sqrt(1+t*t))/(1-sin(d)/sqrt(1+t*t))) as eta from utm3),
utm as (
 select region_id, part, ring, i, utm_zone, south,
  0.9996e0*6367449.145823415e0*(eta
   +8.377318206244698e-4*cos(2*xi)*(exp(2*eta)-exp(-2*eta))/2
   +7.608527773572307e-7*cos(4*xi)*(exp(4*eta)-exp(-4*eta))/2
   +1.197645503329453e-9*cos(6*xi)*(exp(6*eta)-exp(-6*eta))/2) as e,
  0.9996e0*6367449.145823415e0*(xi
   +8.377318206244698e-4*sin(2*xi)*(exp(2*eta)+exp(-2*eta))/2
   +7.608527773572307e-7*sin(4*xi)*(exp(4*eta)+exp(-4*eta))/2
   +1.197645503329453e-9*sin(6*xi)*(exp(6*eta)+exp(-6*eta))/2) as n from utm4),
areas as (
 select region_id, sum(case when ring=0 then m2 else -m2 end)/1000 as area,
  sum(case when ring=0 then m2 else -m2 end)/1e6 as area_km2 from (
  select region_id, part, ring, abs(sum(e*n2-e2*n))/2 as m2 from (
   select *, coalesce(lead(e) over w, first_value(e) over w) as e2,
    coalesce(lead(n) over w, first_value(n) over w) as n2
   from utm window w as (partition by region_id, part, ring order by i)) q
  group by 1,2,3) r group by 1)"""


def with_views(*views: str, body: str) -> str:
    return "with " + ",\n".join(views) + "\n" + body
