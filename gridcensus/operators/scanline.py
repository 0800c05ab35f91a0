"""Even-odd scanline conversion of polygon edges into runs of lattice points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def scanline_runs(
    edges: DataFrame,
    keys: Sequence[str],
    *,
    x0: float, dx: float, n_cols: int,
    y0: float, dy: float, n_rows: int,
) -> DataFrame:
    """Inclusive runs (keys, row, c0, c1) of the points (x0 + c*dx, y0 - row*dy) inside polygons.

    The rule is even-odd and half-open: a point is inside where an odd number of edges pass to
    its right, so a point on a border shared by two polygons belongs to one of them. All rings
    under one key count together, which makes holes.
    """
    keyed = ", ".join(keys)
    first = f"greatest(0, int(floor(({y0!r}D - greatest(y1, y2)) / {dy!r}D)))"
    last = f"least({n_rows - 1}, int(ceil(({y0!r}D - least(y1, y2)) / {dy!r}D)))"
    rows = edges.where("y1 <> y2").selectExpr(
        *keys, "x1", "y1", "x2", "y2",
        f"explode(case when {first} <= {last} then sequence({first}, {last}) end) as row",
    )
    lines = rows.selectExpr(*keys, "row", "x1", "y1", "x2", "y2", f"{y0!r}D - row * {dy!r}D as y")
    crossings = lines.where("(y1 > y) <> (y2 > y)").selectExpr(
        *keys, "row", "(x2 - x1) * (y - y1) / (y2 - y1) + x1 as x"
    )
    line = f"over (partition by {keyed}, row order by x)"
    pairs = crossings.selectExpr(
        *keys, "row", "x as xa", f"lead(x) {line} as xb", f"row_number() {line} as nth"
    ).where("nth % 2 = 1 and xb is not null")
    return pairs.selectExpr(
        *keys, "row",
        f"greatest(0, int(ceil((xa - {x0!r}D) / {dx!r}D))) as c0",
        f"least({n_cols - 1}, int(ceil((xb - {x0!r}D) / {dx!r}D)) - 1) as c1",
    ).where("c0 <= c1")
