"""Small hand-made rasters and regions."""

from gridcensus.functions.grid import GridSpec

GRID = GridSpec(-180.0, -90.0, 180.0, 90.0, 1.0, 1.0, 16)


def ring(x, y, *offsets):
    return [[float(x + dx), float(y + dy)] for dx, dy in offsets]


def square(x, y, side):
    return ring(x, y, (0, 0), (side, 0), (side, side), (0, side))


def regions(spark, named):
    """From {name: geom}, with ids in the order of names."""
    rows = [(i, name, f"A{i}", "X", geom) for i, (name, geom) in enumerate(named.items())]
    schema = (
        "region_id int, location_name string, adm1_code string, adm0_a3 string,"
        " geom array<array<array<array<double>>>>"
    )
    return spark.createDataFrame(rows, schema)


def cells(spark, rows):
    return spark.createDataFrame(rows, "src int, col int, row int, value double")


def block(src, col, row, width, height, value=1.0):
    """A block of equal cells from its upper left cell."""
    return [(src, c, r, value) for c in range(col, col + width) for r in range(row, row + height)]


def sources(spark, *extents):
    """From (src, xmin, ymin, xmax, ymax)."""
    rows = [(s, float(a), float(b), float(c), float(d)) for s, a, b, c, d in extents]
    return spark.createDataFrame(rows, "src int, xmin double, ymin double, xmax double, ymax double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
