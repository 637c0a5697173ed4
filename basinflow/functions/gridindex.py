"""Grid index arithmetic.

Conventions: indices are 1-based; ``row`` counts from the north, ``sn`` from the south, ``col`` and
``we`` from the west. A fine (routing) grid holds ``dxy`` by ``dxy`` cells per land cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.functions.crs import NWM_LCC, LambertConformal, lcc_inverse


@dataclass(frozen=True)
class Grid:
    """A regular north-up grid, described by its outer west and north edges."""

    xmin: float
    ymax: float
    res: float
    ncol: int
    nrow: int

    @property
    def xmax(self) -> float:
        return self.xmin + self.ncol * self.res

    @property
    def ymin(self) -> float:
        return self.ymax - self.nrow * self.res

    @classmethod
    def from_cells(cls, grid_cells: DataFrame, res: float) -> Grid:
        """Measure the extent of a grid template from its cell centres (one aggregate row)."""
        e = grid_extent(grid_cells, res).first()
        return cls(xmin=e.xmin, ymax=e.ymax, res=res, ncol=e.ncol, nrow=e.nrow)


def grid_extent(grid_cells: DataFrame, res: float, by: Sequence[str] = ()) -> DataFrame:
    """Outer edges and size ``(xmin, xmax, ymin, ymax, ncol, nrow)`` of grids of cell centres."""
    sides = [
        (F.min("x") - res / 2).alias("xmin"), (F.max("x") + res / 2).alias("xmax"),
        (F.min("y") - res / 2).alias("ymin"), (F.max("y") + res / 2).alias("ymax"),
    ]
    edges = grid_cells.groupBy(*by).agg(*sides) if by else grid_cells.agg(*sides)
    return edges.withColumns({
        "ncol": F.round((F.col("xmax") - F.col("xmin")) / res).cast("int"),
        "nrow": F.round((F.col("ymax") - F.col("ymin")) / res).cast("int"),
    })


@dataclass(frozen=True)
class IndexBounds:
    """Inclusive 1-based index ranges: ``i`` to the east, ``j`` in the grid's own row order."""

    imin: int
    imax: int
    jmin: int
    jmax: int

    @property
    def width(self) -> int:
        return self.imax - self.imin + 1

    @property
    def height(self) -> int:
        return self.jmax - self.jmin + 1

    def staggered(self, x: bool = False, y: bool = False) -> IndexBounds:
        """The range on a staggered grid: one more on each staggered axis."""
        return IndexBounds(self.imin, self.imax + int(x), self.jmin, self.jmax + int(y))


def _inside(value: Column, inside: Column, outside: str, what: str) -> Column:
    if outside == "raise":
        return F.when(inside, value).otherwise(
            F.raise_error(F.lit(f"{what} lies outside the grid")).cast("int")
        )
    return F.when(inside, value)


def cell_of(x: Column, y: Column, grid: Grid, outside: str = "raise") -> tuple[Column, Column]:
    """``(row, col)`` of a point. Points on the far east and south edges belong to the last cell."""
    col = F.when(x == grid.xmax, F.lit(grid.ncol)).otherwise(
        (F.floor((x - grid.xmin) / grid.res) + 1).cast("int")
    )
    row = F.when(y == grid.ymin, F.lit(grid.nrow)).otherwise(
        (F.floor((F.lit(grid.ymax) - y) / grid.res) + 1).cast("int")
    )
    inside = x.between(grid.xmin, grid.xmax) & y.between(grid.ymin, grid.ymax)
    return _inside(row, inside, outside, "point"), _inside(col, inside, outside, "point")


def flip_row(row: Column, nrow: int) -> Column:
    """Turn a row counted from one side into the row counted from the other."""
    return F.lit(nrow) - row + 1


def cell_centre(row: Column, col: Column, grid: Grid) -> tuple[Column, Column]:
    """``(x, y)`` of a cell centre."""
    return (
        F.lit(grid.xmin) + (col - 0.5) * grid.res,
        F.lit(grid.ymax) - (row - 0.5) * grid.res,
    )


def corner_extent(
    corners: DataFrame, grid: Grid, by: Sequence[str] = (), outside: str = "raise"
) -> DataFrame:
    """Smallest index range holding all corner points ``(x, y)``, one row per ``by`` key."""
    row, col = cell_of(F.col("x"), F.col("y"), grid, outside)
    located = corners.select(*by, row.alias("row"), col.alias("col"))
    sides = [
        F.min("col").alias("w"), F.max("col").alias("e"),
        F.min("row").alias("row_min"), F.max("row").alias("row_max"),
    ]
    extent = located.groupBy(*by).agg(*sides) if by else located.agg(*sides)
    return extent.withColumns({
        "s": flip_row(F.col("row_max"), grid.nrow),
        "n": flip_row(F.col("row_min"), grid.nrow),
    })


def bbox_bounds(
    corners: DataFrame, grid: Grid, dxy: int = 4, by: Sequence[str] = (), outside: str = "raise"
) -> DataFrame:
    """Index bounds of the box spanned by corner points on the land and routing grids.

    Four rows per key: routing and land grid, each counted south-to-north and north-to-south.
    """
    ext = corner_extent(corners, grid, by, outside)

    def bounds(name: str, lo: str, hi: str, fine: bool) -> Column:
        def low(c: str) -> Column:
            return (F.col(c) - 1) * dxy + 1 if fine else F.col(c)

        def high(c: str) -> Column:
            return F.col(c) * dxy if fine else F.col(c)

        return F.struct(
            F.lit(name).alias("grid"),
            low("w").cast("int").alias("imin"), high("e").cast("int").alias("imax"),
            low(lo).cast("int").alias("jmin"), high(hi).cast("int").alias("jmax"),
            F.lit(1).alias("index_start"),
        )

    rows = F.array(
        bounds("hyd_sn", "s", "n", True), bounds("hyd_ns", "row_min", "row_max", True),
        bounds("geo_sn", "s", "n", False), bounds("geo_ns", "row_min", "row_max", False),
    )
    return ext.select(*by, F.inline(rows))


def as_bounds(bounds: DataFrame) -> dict[str, IndexBounds]:
    """The four rows of one box as Python values, for use as literal predicates."""
    rows = bounds.limit(5).collect()
    if len(rows) != 4:
        raise ValueError("expected the four rows of a single box")
    return {r.grid: IndexBounds(r.imin, r.imax, r.jmin, r.jmax) for r in rows}


def buffered_envelope(
    corners: DataFrame,
    grid: Grid,
    cell_buffer: int = 2,
    by: Sequence[str] = (),
    crs: LambertConformal = NWM_LCC,
    outside: str = "raise",
) -> DataFrame:
    """Lon/lat envelope of the corner cells, widened by ``cell_buffer`` cells on each side."""
    ext = corner_extent(corners, grid, by, outside)
    lons, lats = [], []
    for row, col in _box_corners(cell_buffer):
        x, y = cell_centre(row, col, grid)
        lon, lat = lcc_inverse(x, y, crs)
        lons.append(lon)
        lats.append(lat)
    inside = (
        (F.col("w") - cell_buffer >= 1) & (F.col("e") + cell_buffer <= grid.ncol)
        & (F.col("row_min") - cell_buffer >= 1) & (F.col("row_max") + cell_buffer <= grid.nrow)
    )
    if outside == "raise":
        ext = ext.withColumn("w", _inside(F.col("w"), inside, outside, "buffered box"))
    else:
        ext = ext.filter(inside)
    return ext.select(
        *by,
        F.least(*lons).alias("lon_min"), F.greatest(*lons).alias("lon_max"),
        F.least(*lats).alias("lat_min"), F.greatest(*lats).alias("lat_max"),
    )


def _box_corners(buffer: int) -> list[tuple[Column, Column]]:
    south, north = F.col("row_max") + buffer, F.col("row_min") - buffer
    west, east = F.col("w") - buffer, F.col("e") + buffer
    return [(south, west), (north, west), (north, east), (south, east)]


def corner_lonlat(
    corners: DataFrame, grid: Grid, cell_buffer: int = 0, by: Sequence[str] = (),
    crs: LambertConformal = NWM_LCC,
) -> DataFrame:
    """Lon/lat of the four (optionally buffered) corner cells: id 1..4 = SW, NW, NE, SE."""
    ext = corner_extent(corners, grid, by)
    points = []
    for ident, (row, col) in enumerate(_box_corners(cell_buffer), start=1):
        x, y = cell_centre(row, col, grid)
        lon, lat = lcc_inverse(x, y, crs)
        points.append(F.struct(F.lit(ident).alias("id"), lon.alias("lon"), lat.alias("lat")))
    return ext.select(*by, F.inline(F.array(*points)))


def plain_number(value: Column) -> Column:
    """The shortest text that stands for a double, without exponent and trailing zeros."""
    text = F.regexp_replace(value.cast("double").cast("string"), r"\.0(?=E|$)", "")
    parts = [F.regexp_extract(text, r"^(-?)(\d)(?:\.(\d+))?E(-?\d+)$", i) for i in (1, 2, 3, 4)]
    digits, power = F.concat(parts[1], parts[2]), F.coalesce(parts[3].try_cast("int"), F.lit(0))
    zeros = F.repeat(F.lit("0"), F.abs(power))
    padded = F.concat(digits, F.substring(zeros, F.length(parts[2]) + 1, F.length(zeros)))
    point = F.when(F.length(parts[2]) > power, F.concat(
        F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits))
    )).otherwise(padded)
    small = F.concat(F.lit("0."), F.substring(zeros, F.lit(2), F.length(zeros)), digits)
    plain = F.concat(parts[0], F.when(power < 0, small).otherwise(point))
    return F.when(text.contains("E"), plain).otherwise(text)


def geotransform(
    axis_cells: DataFrame, x_res: float, y_res: float, dxy: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """``x0 dx 0 y0 0 dy`` text from the first cell centre (lowest ``i`` and ``j``) of a window.

    Half a step is taken off x and half a step of the y resolution is *added* to y.
    """
    first = [F.min_by("x", "i").alias("x"), F.min_by("y", "j").alias("y")]
    origin = axis_cells.groupBy(*by).agg(*first) if by else axis_cells.agg(*first)
    dx, dy = x_res / dxy, y_res / dxy
    text = F.concat_ws(
        " ",
        plain_number(F.col("x") - dx / 2), plain_number(F.lit(dx)), F.lit("0"),
        plain_number(F.col("y") + dy / 2), F.lit("0"), plain_number(F.lit(dy)),
    )
    return origin.select(*by, text.alias("GeoTransform"))
