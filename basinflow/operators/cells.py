"""Chunked grids and their cells.

``chunks`` hold one stored block each: ``(var, time, y0, x0, ny, nx, data)`` with 1-based origin and
row-major data. ``cells`` are single values ``(var, time, j, i, value)``. Blocks are pruned and cut
as arrays; cells are unfolded only after that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.functions.crs import NWM_LCC, LambertConformal, with_lonlat
from basinflow.functions.gridindex import IndexBounds
from basinflow.functions.timestamps import ntz, slice_bounds
from basinflow.operators.joins import lookup_join


def time_slice(
    df: DataFrame, start: str | datetime, end: str | datetime, column: str = "time"
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; a date-only end covers that whole day."""
    first, last, inclusive = slice_bounds(start, end)
    t = F.col(column)
    upper = t <= ntz(last) if inclusive else t < ntz(last)
    return df.filter((t >= ntz(first)) & upper)


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack datasets along time."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def squeeze(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Drop dimensions of length one; any other length is an error."""
    sizes = df.agg(*[
        F.when(F.min(d) == F.max(d), F.lit(1)).otherwise(F.lit(0)).alias(d) for d in dims
    ]).first()
    wrong = [d for d in dims if sizes[d] != 1]
    if wrong:
        raise ValueError(f"cannot squeeze dimensions with other than one value: {wrong}")
    return df.drop(*dims)


# Dimension names of the stored forcing and of the result.
FORCING_DIMS = {"valid_time": "time", "south_north": "y", "west_east": "x"}


def conform_dims(
    df: DataFrame, rename: Mapping[str, str] = FORCING_DIMS, drop: Sequence[str] = ()
) -> DataFrame:
    """Squeeze singleton dimensions, then rename the others."""
    if drop:
        df = squeeze(df, drop)
    return df.withColumnsRenamed(dict(rename))


def rechunk(df: DataFrame, by: str = "time") -> DataFrame:
    """Keep the rows of one ``by`` value together; values too big for one partition are split."""
    return df.hint("rebalance", by)


def with_coords(cells: DataFrame, grid_cells: DataFrame) -> DataFrame:
    """Attach the stored ``x, y, lon, lat`` of each cell of a grid template."""
    template = grid_cells.select("j", "i", "x", "y", "lon", "lat")
    return lookup_join(cells, template, ["j", "i"])


def with_axis_coords(
    cells: DataFrame, xs: DataFrame, ys: DataFrame, crs: LambertConformal = NWM_LCC
) -> DataFrame:
    """Attach ``x, y`` from the axis tables ``(i, x)`` and ``(j, y)`` and the ``lon, lat`` they give.

    Axes are as long as a grid side; lon and lat are calculated in place, so a 2-D coordinate table is
    neither stored nor joined.
    """
    placed = lookup_join(cells, xs.select("i", "x"), ["i"])
    placed = lookup_join(placed, ys.select("j", "y"), ["j"])
    return with_lonlat(placed, crs)


def _overlaps(b: IndexBounds, imax: Column, jmax: Column) -> Column:
    return (
        (F.col("y0") <= jmax) & (F.col("y0") + F.col("ny") - 1 >= b.jmin)
        & (F.col("x0") <= imax) & (F.col("x0") + F.col("nx") - 1 >= b.imin)
    )


def hyperslab(
    chunks: DataFrame,
    bounds: IndexBounds,
    stag: bool = False,
    reorigin: bool = False,
    max_chunk: tuple[int, int] | None = None,
) -> DataFrame:
    """Cut blocks to an inclusive index range.

    Blocks outside are filtered out by their origin, the others are sliced as arrays. ``max_chunk``
    ``(ny, nx)`` adds lower bounds on the origin which reach the Parquet scan. With ``stag`` the
    table has boolean ``stag_x`` and ``stag_y`` and staggered axes run one index further. With
    ``reorigin`` the result counts from 1.
    """
    imax, jmax = F.lit(bounds.imax), F.lit(bounds.jmax)
    if stag:
        imax = F.when(F.col("stag_x"), imax + 1).otherwise(imax)
        jmax = F.when(F.col("stag_y"), jmax + 1).otherwise(jmax)
    # widest possible range first: plain comparisons with literals can be pushed to the files
    kept = chunks.filter(
        (F.col("y0") <= bounds.jmax + int(stag)) & (F.col("x0") <= bounds.imax + int(stag))
    )
    if max_chunk:
        kept = kept.filter(
            (F.col("y0") > bounds.jmin - max_chunk[0]) & (F.col("x0") > bounds.imin - max_chunk[1])
        )
    kept = kept.filter(_overlaps(bounds, imax, jmax))
    shift = (F.lit(bounds.jmin - 1), F.lit(bounds.imin - 1)) if reorigin else None
    done = cut_blocks(kept, F.lit(bounds.imin), imax, F.lit(bounds.jmin), jmax, shift)
    return done.select(*chunks.columns)


def cut_blocks(
    blocks: DataFrame, imin: Column, imax: Column, jmin: Column, jmax: Column,
    shift: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Blocks cut to ranges that they overlap, all further columns kept; ``shift`` ``(rows, columns)`` is subtracted
    from their origins."""
    # every new name gets its own step: a name assigned and read in one step could mean either
    cut = blocks.withColumns({
        "_j0": F.greatest("y0", jmin),
        "_j1": F.least(F.col("y0") + F.col("ny") - 1, jmax),
        "_i0": F.greatest("x0", imin),
        "_i1": F.least(F.col("x0") + F.col("nx") - 1, imax),
    })
    width = F.col("_i1") - F.col("_i0") + 1
    rows = F.transform(
        F.sequence("_j0", "_j1"),
        lambda j: F.slice(
            F.col("data"),
            ((j - F.col("y0")) * F.col("nx") + F.col("_i0") - F.col("x0") + 1).cast("int"),
            width.cast("int"),
        ),
    )
    rows_off, columns_off = shift or (F.lit(0), F.lit(0))
    cut = cut.withColumn("_data", F.flatten(rows))
    layout = {
        "y0": F.col("_j0") - rows_off, "x0": F.col("_i0") - columns_off,
        "ny": F.col("_j1") - F.col("_j0") + 1, "nx": width, "data": F.col("_data"),
    }
    kinds = dict(blocks.dtypes)
    return cut.select(*[layout[c].cast(kinds[c]).alias(c) if c in layout else c for c in blocks.columns])


def clip_forcing(
    chunks: DataFrame,
    bounds: IndexBounds,
    dims: tuple[str, str] = ("south_north", "west_east"),
    **options: object,
) -> DataFrame:
    """The same index range cut from every forcing file in one distributed read.

    ``dims`` names the row and column dimension: blocks come with ``{dim}_start`` and ``{dim}_size``
    columns and leave as ``y0, x0, ny, nx``. Archive files use the default, real-time files
    ``("y", "x")``.
    """
    rows, cols = dims
    named = chunks.withColumnsRenamed({
        f"{rows}_start": "y0", f"{rows}_size": "ny", f"{cols}_start": "x0", f"{cols}_size": "nx",
    })
    return hyperslab(named, bounds, **options)


def explode_cells(chunks: DataFrame) -> DataFrame:
    """One row per cell; all columns other than the block layout are kept."""
    keep = [c for c in chunks.columns if c not in {"y0", "x0", "ny", "nx", "data"}]
    # the outer form with a filter behind it: for the plain form Spark adds a filter on the array in
    # front, which would compute a cut block twice
    flat = chunks.select(*keep, "y0", "x0", "nx", F.posexplode_outer("data").alias("_p", "value"))
    return flat.filter("_p IS NOT NULL").select(
        *keep,
        (F.col("y0") + F.call_function("div", F.col("_p"), F.col("nx"))).cast("int").alias("j"),
        (F.col("x0") + F.col("_p") % F.col("nx")).cast("int").alias("i"),
        "value",
    )


def chunk_rows(chunks: DataFrame) -> DataFrame:
    """One row per grid row of each block: ``j, x0, nx`` and the row's values as ``data``."""
    keep = [c for c in chunks.columns if c not in {"y0", "x0", "ny", "nx", "data"}]
    offsets = F.sequence(F.lit(0), F.col("ny") - 1)
    flat = chunks.select(*keep, "y0", "x0", "nx", "data", F.explode(offsets).alias("_k"))
    return flat.select(
        *keep, (F.col("y0") + F.col("_k")).alias("j"), "x0", "nx",
        F.slice("data", F.col("_k") * F.col("nx") + 1, F.col("nx")).alias("data"),
    )


# Names of the corner variables (mass, U, V and corner grids), latitudes first.
CORNER_LATS = ("XLAT_M", "XLAT_U", "XLAT_V", "XLAT_C")
CORNER_LONS = ("XLONG_M", "XLONG_U", "XLONG_V", "XLONG_C")


def grid_corners(cells: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """``corner_lats`` and ``corner_lons`` of each dataset: SW, NW, NE, SE for each variable.

    A variable the dataset lacks contributes zeros.
    """
    # one number instead of a pair of columns, so that Spark can aggregate by hashing
    row = F.col("j").cast("bigint") * 2**32
    sn, ns = row + F.col("i"), row - F.col("i")
    names = [*CORNER_LATS, *CORNER_LONS]
    wanted = cells.filter(F.col("var").isin(names))
    corners = wanted.groupBy(*by, "var").agg(
        F.min_by("value", sn).alias("sw"), F.max_by("value", ns).alias("nw"),
        F.max_by("value", sn).alias("ne"), F.min_by("value", ns).alias("se"),
    )
    picked = [
        F.max(F.when(F.col("var") == v, F.col(c))).alias(f"{v}_{c}")
        for v in names for c in ("sw", "nw", "ne", "se")
    ]
    wide = corners.groupBy(*by).agg(*picked)

    def listed(variables: Sequence[str]) -> Column:
        return F.array(*[
            F.coalesce(F.col(f"{v}_{c}"), F.lit(0.0))
            for v in variables for c in ("sw", "nw", "ne", "se")
        ])

    return wide.select(
        *by, listed(CORNER_LATS).alias("corner_lats"), listed(CORNER_LONS).alias("corner_lons")
    )
