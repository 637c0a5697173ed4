"""Queries on grid indices, blocks, polygons and overviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from basinflow.functions import crs, gridindex
from basinflow.functions.gridindex import IndexBounds
from basinflow.operators import boxes as B
from basinflow.operators import cells as C
from basinflow.operators import clip as P
from basinflow.operators import pyramid as PY
from basinflow.operators import quadtree as Q
from basinflow.operators.attrs import grid_attrs as rewrite_attrs
from basinflow.operators.attrs import set_coordinate_attrs, set_crs
from basinflow.operators.cluster import with_zorder
from basinflow.operators.metadata import describe_cells, describe_chunks, describe_table
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.views import with_views
from basinflow.session import scratch_path
from basinflow.sources.sinks import conform
from basinflow.streaming.clip import stream_chunks
from basinflow.streaming.clip import stream_clip as start_clip

SLAB = IndexBounds(imin=10, imax=40, jmin=3, jmax=14)
TILE = 16


def as_double(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.col("value").cast("double"))


# -- projection and index arithmetic ---------------------------------------------------------------

@query(with_views("lcc sites", "SELECT link, round(x, 3) AS x, round(y, 3) AS y FROM sites"))
def lcc_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Every link projected."""
    return V.sites(spark, sf).select(
        "link", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")
    )


@query(with_views("lcc sites", """
    SELECT link, round(lon, 7) AS lon, round(lat, 7) AS lat FROM sites"""))
def lcc_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """Every link projected and back again."""
    lon, lat = crs.lcc_inverse(F.col("x"), F.col("y"))
    return V.sites(spark, sf).select(
        "link", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat")
    )


@query(with_views("lcc chunks cells grid", """
    SELECT j, i, x, y, round(lon, 7) AS lon, round(lat, 7) AS lat FROM grid"""))
def grid_mesh(spark: SparkSession, sf: str) -> DataFrame:
    """2-D lon and lat of the forcing grid from its axes."""
    return V.grid_cells(spark, sf).select(
        "j", "i", "x", "y", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat")
    )


LOCATED = """located AS (
        SELECT link, site, CAST(floor((2000000e0 - y) / 1000) + 1 AS INTEGER) AS "row",
               CAST(floor((x + 2800000e0) / 1000) + 1 AS INTEGER) AS col
        FROM sites)"""
EXTENT = LOCATED + """,
    extent AS (
        SELECT site, min(col) AS w, max(col) AS e, min("row") AS r0, max("row") AS r1,
               4000 - max("row") + 1 AS s, 4000 - min("row") + 1 AS n
        FROM located GROUP BY site)"""


@query(with_views("lcc sites", f""", {LOCATED}
    SELECT link, "row", col, 4000 - "row" + 1 AS sn,
           -2800000e0 + (col - 0.5e0) * 1000 AS x_centre,
           2000000e0 - ("row" - 0.5e0) * 1000 AS y_centre FROM located"""))
def point_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Grid cell of every link, counted from both sides, and its centre."""
    row, col = gridindex.cell_of(F.col("x"), F.col("y"), V.LAND)
    x, y = V.land_centre(F.col("row"), F.col("col"))
    located = V.sites(spark, sf).select("link", row.alias("row"), col.alias("col"))
    return located.select(
        "link", "row", "col", gridindex.flip_row(F.col("row"), V.LAND.nrow).alias("sn"),
        x.alias("x_centre"), y.alias("y_centre"),
    )


@query(with_views("lcc sites", f""", {EXTENT}
    SELECT site, 'hyd_sn' AS grid, (w - 1) * 4 + 1 AS imin, e * 4 AS imax, (s - 1) * 4 + 1 AS jmin,
           n * 4 AS jmax, 1 AS index_start FROM extent
    UNION ALL SELECT site, 'hyd_ns', (w - 1) * 4 + 1, e * 4, (r0 - 1) * 4 + 1, r1 * 4, 1 FROM extent
    UNION ALL SELECT site, 'geo_sn', w, e, s, n, 1 FROM extent
    UNION ALL SELECT site, 'geo_ns', w, e, r0, r1, 1 FROM extent"""))
def bbox_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Index bounds of the box around every site."""
    return gridindex.bbox_bounds(V.sites(spark, sf), V.LAND, by=["site"])


@query(with_views("lcc sites", f""", {EXTENT},
    corners AS (
        SELECT site, unnest([w - 2, w - 2, e + 2, e + 2]) AS col,
               unnest([r1 + 2, r0 - 2, r0 - 2, r1 + 2]) AS "row" FROM extent),
    centres AS (
        SELECT site, -2800000e0 + (col - 0.5e0) * 1000 AS x, 2000000e0 - ("row" - 0.5e0) * 1000 AS y
        FROM corners),
    points AS (
        SELECT site, degrees(atan2(x, rho0 - y)) / n - 97e0 AS lon,
               degrees(2 * atan(pow(rf / sqrt(x * x + (rho0 - y) * (rho0 - y)), 1 / n))) - 90e0 AS lat
        FROM centres, lcc0)
    SELECT site, round(min(lon), 7) AS lon_min, round(max(lon), 7) AS lon_max,
           round(min(lat), 7) AS lat_min, round(max(lat), 7) AS lat_max FROM points GROUP BY site"""))
def buffered_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Lon/lat envelope of every site's box, two cells wider on each side."""
    env = gridindex.buffered_envelope(V.sites(spark, sf), V.LAND, by=["site"])
    return env.select("site", *[
        F.round(c, 7).alias(c) for c in ("lon_min", "lon_max", "lat_min", "lat_max")
    ])


@query(with_views("lcc sites", f""", {EXTENT},
    corners AS (
        SELECT site, unnest([1, 2, 3, 4]) AS id, unnest([w, w, e, e]) AS col,
               unnest([r1, r0, r0, r1]) AS "row" FROM extent),
    centres AS (
        SELECT site, id, -2800000e0 + (col - 0.5e0) * 1000 AS x,
               2000000e0 - ("row" - 0.5e0) * 1000 AS y FROM corners)
    SELECT site, id, round(degrees(atan2(x, rho0 - y)) / n - 97e0, 7) AS lon,
           round(degrees(2 * atan(pow(rf / sqrt(x * x + (rho0 - y) * (rho0 - y)), 1 / n))) - 90e0, 7)
             AS lat
    FROM centres, lcc0"""))
def corner_points(spark: SparkSession, sf: str) -> DataFrame:
    """Lon and lat of the four corner cells of every site's box."""
    corners = gridindex.corner_lonlat(V.sites(spark, sf), V.LAND, by=["site"])
    return corners.select("site", "id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


# -- blocks ----------------------------------------------------------------------------------------

CLIPPED = with_views("chunks cells", """
    SELECT var, time, j - 2 AS j, i - 9 AS i, value FROM cells
    WHERE i BETWEEN 10 AND 40 AND j BETWEEN 3 AND 14""")


@query(with_views("chunks cells", """
    SELECT var, time, j, i, value FROM cells WHERE i BETWEEN 10 AND 40 AND j BETWEEN 3 AND 14"""))
def hyperslab(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of an index range."""
    slab = C.hyperslab(V.chunks(spark, sf), SLAB, max_chunk=V.BLOCK)
    return as_double(C.explode_cells(slab))


@query(with_views("chunks cells", """
    SELECT var, time, label, j, i, value FROM cells
    WHERE i BETWEEN 10 AND 40 + CAST(label % 2 = 0 AS INTEGER)
      AND j BETWEEN 3 AND 14 + CAST(label % 3 = 0 AS INTEGER)"""))
def hyperslab_stag(spark: SparkSession, sf: str) -> DataFrame:
    """The same with some blocks on staggered axes."""
    staggered = V.forcing(spark, sf).withColumns({
        "stag_x": F.col("label") % 2 == 0, "stag_y": F.col("label") % 3 == 0
    })
    slab = C.hyperslab(staggered, SLAB, stag=True, max_chunk=V.BLOCK)
    return as_double(C.explode_cells(slab)).drop("stag_x", "stag_y")


@query(with_views("chunks cells vertices", """
    , boxes AS (
        SELECT s_suppkey AS box, floor(cx - r) AS imin, floor(cx + r) AS imax, floor(cy - r / 2) AS jmin,
               floor(cy + r / 2) AS jmax FROM shape)
    SELECT CAST(box AS BIGINT) AS box, var, time, CAST(j - (jmin - 1) AS INTEGER) AS j,
           CAST(i - (imin - 1) AS INTEGER) AS i, value
    FROM cells JOIN boxes ON i BETWEEN imin AND imax AND j BETWEEN jmin AND jmax"""))
def boxes_hyperslab(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of many index ranges in one pass, counted from 1 in each."""
    shape = V.shapes(spark, sf)
    boxes = shape.select(
        F.col("s_suppkey").alias("box"),
        *[F.floor(v).cast("int").alias(n) for n, v in (
            ("imin", F.col("cx") - F.col("r")), ("imax", F.col("cx") + F.col("r")),
            ("jmin", F.col("cy") - F.col("r") / 2), ("jmax", F.col("cy") + F.col("r") / 2),
        )],
    )
    slabs = B.hyperslabs(V.chunks(spark, sf), boxes, V.BLOCK, reorigin=True)
    return as_double(C.explode_cells(slabs))


@query(CLIPPED)
def forcing_clip(spark: SparkSession, sf: str) -> DataFrame:
    """The index range cut from every forcing file, counted from 1 again."""
    files = V.chunks(spark, sf).withColumnsRenamed({
        "y0": "south_north_start", "ny": "south_north_size",
        "x0": "west_east_start", "nx": "west_east_size",
    })
    return as_double(C.explode_cells(C.clip_forcing(files, SLAB, reorigin=True)))


@query(CLIPPED)
def stream_clip(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stream over the folder the blocks arrive in."""
    schema = PT.StructType([
        PT.StructField("vec_id", PT.LongType()),
        PT.StructField("embedding", PT.ArrayType(PT.FloatType())),
    ])
    arriving = stream_chunks(spark, sf, schema, table="embeddings.parquet")
    v = F.col("vec_id")
    tile = V.div(v, 24)
    blocks = arriving.select(
        F.lit("T2D").alias("var"), (V.ntz(V.BASE_TIME) + V.hours(v % 24)).alias("time"),
        (V.div(tile, 3) * 4 + 1).cast("int").alias("y0"),
        (tile % 3 * 16 + 1).cast("int").alias("x0"),
        F.lit(4).alias("ny"), F.lit(16).alias("nx"), F.col("embedding").alias("data"),
    )
    out = scratch_path(spark, "stream-clip")
    start_clip(
        blocks, SLAB, out, scratch_path(spark, "stream-log"), available_now=True, reorigin=True
    ).awaitTermination()
    return as_double(C.explode_cells(spark.read.parquet(out)))


@query(with_views("lcc chunks cells grid", """
    SELECT time, c.j AS y_index, c.i AS x_index, value, x, y, round(lon, 7) AS lon,
           round(lat, 7) AS lat
    FROM cells c JOIN grid g ON c.j = g.j AND c.i = g.i"""))
def dims_conform(spark: SparkSession, sf: str) -> DataFrame:
    """Singleton dropped, dimensions renamed, coordinates attached."""
    stored = C.explode_cells(V.chunks(spark, sf)).withColumnsRenamed(
        {"time": "valid_time", "j": "south_north", "i": "west_east"}
    ).withColumn("Time", F.lit(0))
    named = C.conform_dims(
        stored, {"valid_time": "time", "south_north": "j", "west_east": "i"}, drop=["Time"]
    )
    placed = as_double(C.with_coords(named, V.grid_cells(spark, sf)))
    return placed.select(
        "time", F.col("j").alias("y_index"), F.col("i").alias("x_index"), "value", "x", "y",
        F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"),
    )


@query(with_views("chunks cells", "SELECT time, j, i, value FROM cells"))
def conformed_write(spark: SparkSession, sf: str) -> DataFrame:
    """Only the columns a target knows, in its order, written and read back."""
    cells = C.explode_cells(V.forcing(spark, sf))
    out = scratch_path(spark, "conformed")
    conform(cells, ["time", "j", "i", "missing", "value"]).write.parquet(out)
    return as_double(spark.read.parquet(out))


def corner_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly grids as datasets with some of the coordinate variables."""
    slab = C.explode_cells(V.chunks(spark, sf))
    value = F.col("value").cast("double")
    variables = F.array_compact(F.array(
        F.struct(F.lit("XLAT_M").alias("var"), value.alias("value")),
        F.struct(F.lit("XLONG_M").alias("var"), (-value).alias("value")),
        F.when(F.col("i") <= 17, F.struct(F.lit("XLAT_U").alias("var"), value.alias("value"))),
        F.when(F.col("j") <= 5, F.struct(F.lit("XLONG_V").alias("var"), (value * 2).alias("value"))),
    ))
    return slab.select(
        F.col("time").cast("string").alias("dataset"), "j", "i", F.inline(variables)
    )


def corner_sql(sign: str, names: list[str]) -> str:
    """SQL list of the corners of four variables, zeros where a variable is absent."""
    present = {"XLAT_M": "i <= 48", "XLAT_U": "i <= 17", "XLONG_M": "i <= 48", "XLONG_V": "j <= 5"}
    factor = {"XLAT_M": "value", "XLAT_U": "value", "XLONG_M": "-value", "XLONG_V": "value * 2"}
    out = []
    for v in names:
        for pick in ("arg_min({}, j * 1000 + i)", "arg_max({}, j * 1000 - i)",
                     "arg_max({}, j * 1000 + i)", "arg_min({}, j * 1000 - i)"):
            if v in present:
                out.append(f"{pick.format(factor[v])} FILTER (WHERE {present[v]})")
            else:
                out.append("0e0")
    return f"[{', '.join(out)}] AS {sign}"


CORNERS = f"""corners AS (
        SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS dataset,
               {corner_sql("lats", ["XLAT_M", "XLAT_U", "XLAT_V", "XLAT_C"])},
               {corner_sql("lons", ["XLONG_M", "XLONG_U", "XLONG_V", "XLONG_C"])}
        FROM cells GROUP BY time)"""


@query(with_views("chunks cells", f""", {CORNERS}
    SELECT dataset, k, lats[k] AS lat, lons[k] AS lon
    FROM corners, (SELECT CAST(unnest(range(1, 17)) AS INTEGER) AS k)"""))
def grid_corners(spark: SparkSession, sf: str) -> DataFrame:
    """Corner lats and lons of every hourly grid."""
    corners = C.grid_corners(corner_cells(spark, sf))
    pairs = corners.select("dataset", F.posexplode(F.arrays_zip("corner_lats", "corner_lons")))
    return pairs.select(
        "dataset", (F.col("pos") + 1).alias("k"), F.col("col.corner_lats").alias("lat"),
        F.col("col.corner_lons").alias("lon"),
    )


def _attr(variable: str, name: str, kind: str, value) -> F.Column:
    return F.struct(
        F.lit(variable).alias("variable"), F.lit(name).alias("name"), F.lit(kind).alias("type"),
        F.array(value).alias("value"),
    )


NUMBER = r"regexp_replace(CAST(CAST({} AS DOUBLE) AS VARCHAR), '\.0$', '')"


@query(with_views("chunks cells", f""", {CORNERS},
    extent AS (
        SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS dataset, min(i) AS w, max(i) AS e, min(j) AS s,
               max(j) AS n FROM cells GROUP BY time)
    SELECT dataset, '' AS variable, 'TITLE' AS name, 'c' AS type, 'grid ' || dataset AS value FROM extent
    UNION ALL SELECT dataset, 'HGT_M', 'units', 'c', 'm' FROM extent
    UNION ALL SELECT dataset, '', 'WEST-EAST_GRID_DIMENSION', 'l', CAST(e - w + 2 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'SOUTH-NORTH_GRID_DIMENSION', 'l', CAST(n - s + 2 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'WEST-EAST_PATCH_END_UNSTAG', 'l', CAST(e - w + 1 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'SOUTH-NORTH_PATCH_END_UNSTAG', 'l', CAST(n - s + 1 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'i_parent_end', 'l', CAST(e - w + 2 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'j_parent_end', 'l', CAST(n - s + 2 AS VARCHAR) FROM extent
    UNION ALL SELECT dataset, '', 'corner_lats', 'f',
        array_to_string(list_transform(lats, lambda v: {NUMBER.format("v")}), ',') FROM corners
    UNION ALL SELECT dataset, '', 'corner_lons', 'f',
        array_to_string(list_transform(lons, lambda v: {NUMBER.format("v")}), ',') FROM corners"""))
def grid_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Size attributes of every hourly grid after the cut: six set, four deleted, corners listed."""
    cells = corner_cells(spark, sf)
    bounds = cells.filter("var = 'XLAT_M'").groupBy("dataset").agg(
        F.min("i").alias("w"), F.max("i").alias("e"), F.min("j").alias("s"), F.max("j").alias("n")
    )
    before = F.array(
        _attr("", "TITLE", "c", F.concat(F.lit("grid "), "dataset")),
        _attr("HGT_M", "units", "c", F.lit("m")),
        _attr("", "WEST-EAST_GRID_DIMENSION", "l", F.lit("4609")),
        _attr("", "WEST-EAST_PATCH_START_STAG", "l", F.lit("1")),
        _attr("", "SOUTH-NORTH_PATCH_END_STAG", "l", F.lit("3841")),
    )
    attrs = bounds.select("dataset", F.inline(before))
    after = rewrite_attrs(attrs, bounds, C.grid_corners(cells))
    return after.withColumn("value", F.array_join("value", ","))


COORDINATES = """(VALUES
        ('x', 'axis', 'c', 'X'), ('x', 'standard_name', 'c', 'projection_x_coordinate'),
        ('x', 'long_name', 'c', 'x-coordinate in projected coordinate system'),
        ('x', 'resolution', 'f', '1000.0'),
        ('y', 'axis', 'c', 'Y'), ('y', 'standard_name', 'c', 'projection_y_coordinate'),
        ('y', 'long_name', 'c', 'y-coordinate in projected coordinate system'),
        ('y', 'resolution', 'f', '1000.0'),
        ('lon', 'units', 'c', 'degrees_east'), ('lon', 'standard_name', 'c', 'longitude'),
        ('lon', 'long_name', 'c', 'longitude'),
        ('lat', 'units', 'c', 'degrees_north'), ('lat', 'standard_name', 'c', 'latitude'),
        ('lat', 'long_name', 'c', 'latitude'),
        ('spatial_ref', 'spatial_ref', 'c', 'EPSG:4326'), ('spatial_ref', 'crs_wkt', 'c', 'EPSG:4326'),
        ('', 'x_dim', 'c', 'x'), ('', 'y_dim', 'c', 'y')) AS a(variable, name, type, value)"""


@query(with_views("chunks", f"""
    SELECT dataset, variable, name, type, value
    FROM (SELECT DISTINCT strftime(time, '%Y-%m-%d %H:%M:%S') AS dataset FROM chunks), {COORDINATES}
    UNION ALL
    SELECT DISTINCT strftime(time, '%Y-%m-%d %H:%M:%S'), var, 'label', 'l', CAST(max(label) AS VARCHAR)
    FROM chunks GROUP BY time, var"""))
def coordinate_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinate and CRS attributes of every hourly dataset."""
    attrs = V.forcing(spark, sf).groupBy(
        F.col("time").cast("string").alias("dataset"), F.col("var").alias("variable")
    ).agg(F.max("label").alias("label")).select(
        "dataset", "variable", F.lit("label").alias("name"), F.lit("l").alias("type"),
        F.array(F.col("label").cast("string")).alias("value"),
    )
    datasets = attrs.select("dataset").distinct()
    described = set_crs(set_coordinate_attrs(attrs, datasets), datasets, "EPSG:4326")
    return described.withColumn("value", F.array_join("value", ","))


@query(with_views("lcc chunks cells grid", f"""
    , origin AS (
        SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS dataset, arg_min(x, i) AS x, arg_min(y, j) AS y
        FROM (SELECT time, c.j, c.i, x, y FROM cells c JOIN grid g ON c.j = g.j AND c.i = g.i)
        GROUP BY time)
    SELECT dataset, 1 AS dxy, {NUMBER.format("x - 500")} || ' 1000 0 ' || {NUMBER.format("y + 500")}
           || ' 0 1000' AS GeoTransform FROM origin
    UNION ALL
    SELECT dataset, 4, {NUMBER.format("x - 125")} || ' 250 0 ' || {NUMBER.format("y + 125")}
           || ' 0 250' FROM origin"""))
def geotransform(spark: SparkSession, sf: str) -> DataFrame:
    """GeoTransform text of every hourly window on the land and routing grids."""
    xs, ys = V.axis_tables(spark, sf)
    # the first row and column of a dataset decide, so blocks are enough: cells are not unfolded
    first = V.chunks(spark, sf).select(
        F.col("time").cast("string").alias("dataset"), F.col("y0").alias("j"), F.col("x0").alias("i")
    ).join(xs, "i").join(ys, "j")
    parts = [
        gridindex.geotransform(first, 1000.0, 1000.0, dxy, by=["dataset"]).select(
            "dataset", F.lit(dxy).alias("dxy"), "GeoTransform"
        )
        for dxy in (1, 4)
    ]
    return C.concat(parts)


# -- polygons --------------------------------------------------------------------------------------

@query(with_views("lcc vertices", """
    , ll AS (SELECT *, -100e0 + x / 4 AS lon, 35e0 + y / 4 AS lat FROM vertices)
    SELECT poly_id, ring, seq,
           round(rf / pow(tan(pi() / 4 + radians(lat) / 2), n) * sin(n * radians(lon + 97e0)), 3) AS x,
           round(rho0 - rf / pow(tan(pi() / 4 + radians(lat) / 2), n) * cos(n * radians(lon + 97e0)), 3)
             AS y
    FROM ll, lcc0"""))
def reproject_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Lon/lat polygons in the grid's projection."""
    projected = crs.reproject_polygons(V.lonlat_polygons(spark, sf))
    return projected.select(
        "poly_id", "ring", "seq", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")
    )


@query(with_views("chunks cells vertices", f"""
    , chosen AS (SELECT * FROM vertices), {V.SQL["edges"]}
    SELECT poly_id, j, i FROM inside"""))
def polygon_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of every polygon."""
    runs = P.polygon_runs(V.polygons(spark, sf), V.grid_height(spark, sf), V.WIDTH)
    return runs.select(
        "poly_id", F.col("row").alias("j"),
        F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("i"),
    )


@query(with_views("chunks cells vertices", f"""
    , chosen AS (SELECT * FROM vertices), {V.SQL["edges"]}
    SELECT poly_id, j, i FROM inside"""))
def cover_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of every polygon, unfolded from its quadtree cover."""
    runs = P.polygon_runs(V.polygons(spark, sf), V.grid_height(spark, sf), V.WIDTH)
    return Q.cover_cells(Q.quadtree_cover(runs))


@query(with_views("chunks cells vertices", f"""
    , chosen AS (SELECT * FROM vertices), {V.SQL["edges"]},
    tall AS (SELECT max(j) AS h FROM cells),
    spots AS (SELECT o_orderkey AS link, CAST(o_orderkey * 3 % h + 1 AS INTEGER) AS j,
                     CAST(o_custkey % {V.WIDTH} + 1 AS INTEGER) AS i FROM orders, tall)
    SELECT poly_id, link FROM spots JOIN inside USING (j, i)"""))
def cover_points(spark: SparkSession, sf: str) -> DataFrame:
    """The polygons that each link's grid cell lies in, joined by quadtree cell."""
    height = V.grid_height(spark, sf)
    cover = Q.quadtree_cover(P.polygon_runs(V.polygons(spark, sf), height, V.WIDTH))
    spots = V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("link"), (F.col("o_orderkey") * 3 % height + 1).cast("int").alias("j"),
        (F.col("o_custkey") % V.WIDTH + 1).cast("int").alias("i"),
    )
    return Q.join_cover(spots, cover).select("poly_id", "link")


@query(with_views("chunks cells vertices", f"""
    , chosen AS (SELECT * FROM vertices), {V.SQL["edges"]}
    SELECT var, time, j, i, value FROM cells JOIN covered USING (j, i)"""))
def polygon_clip(spark: SparkSession, sf: str) -> DataFrame:
    """Forcing inside the union of all polygons."""
    runs = P.union_runs(
        P.polygon_runs(V.polygons(spark, sf), V.grid_height(spark, sf), V.WIDTH)
    )
    return as_double(P.clip(V.chunks(spark, sf), runs, "drop", max_chunk=V.BLOCK))


@query(with_views("chunks cells vertices", f"""
    , chosen AS (SELECT * FROM vertices), {V.SQL["edges"]},
    box AS (SELECT min(j) AS j0, max(j) AS j1, min(i) AS i0, max(i) AS i1 FROM covered)
    SELECT var, time, c.j, c.i, CASE WHEN m.j IS NOT NULL THEN value END AS value
    FROM cells c JOIN box ON c.j BETWEEN j0 AND j1 AND c.i BETWEEN i0 AND i1
    LEFT JOIN covered m ON m.j = c.j AND m.i = c.i"""))
def polygon_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Forcing in the window around all polygons, blank outside them."""
    runs = P.union_runs(
        P.polygon_runs(V.polygons(spark, sf), V.grid_height(spark, sf), V.WIDTH)
    )
    return as_double(P.clip(V.chunks(spark, sf), runs, "mask", max_chunk=V.BLOCK))


# -- overviews, clustering, descriptions -------------------------------------------------------------

LEVELS = f"""lv AS (
        SELECT CAST(unnest(range(0, 1 + CAST(greatest(0, ceil(log2(greatest(max(j), max(i)) / {TILE}.0)))
               AS BIGINT))) AS INTEGER) AS level FROM cells)"""
TILED = f"""level, "row" // {TILE} AS tile_row, col // {TILE} AS tile_col, "row", col, value"""
NEAREST = f"""nearest AS (
        SELECT var, time, level, CAST((j - 1) // pow(2, level) AS INTEGER) AS "row",
               CAST((i - 1) // pow(2, level) AS INTEGER) AS col, value
        FROM cells, lv WHERE (j - 1) % pow(2, level) = 0 AND (i - 1) % pow(2, level) = 0)"""


def forcing_cells(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(C.explode_cells(V.chunks(spark, sf)))


def forcing_levels(spark: SparkSession, sf: str) -> int:
    return PY.overview_levels(V.grid_height(spark, sf), V.WIDTH, TILE)


@query(with_views("chunks cells", f", {LEVELS}, {NEAREST} SELECT var, time, {TILED} FROM nearest"))
def pyramid(spark: SparkSession, sf: str) -> DataFrame:
    """Tiled overviews by nearest cell."""
    return PY.build_pyramid(forcing_cells(spark, sf), forcing_levels(spark, sf), TILE)


@query(with_views("chunks cells", f""", {LEVELS},
    means AS (
        SELECT var, time, level, CAST(floor((j - 1) / pow(2, level)) AS INTEGER) AS "row",
               CAST(floor((i - 1) / pow(2, level)) AS INTEGER) AS col, round(avg(value), 6) AS value
        FROM cells, lv GROUP BY ALL)
    SELECT var, time, {TILED} FROM means"""))
def pyramid_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Tiled overviews by mean."""
    tiles = PY.build_pyramid(forcing_cells(spark, sf), forcing_levels(spark, sf), TILE, "mean")
    return tiles.withColumn("value", F.round("value", 6))


@query(with_views("chunks cells", f""", {LEVELS}, {NEAREST}
    SELECT var, time, {TILED} FROM nearest WHERE level = (SELECT max(level) FROM lv)"""))
def overview_top(spark: SparkSession, sf: str) -> DataFrame:
    """The smallest overview."""
    return PY.read_overview(pyramid(spark, sf))


def spread_sql(v: str) -> str:
    """Bit interleave with one zero bit, in SQL."""
    for shift, mask in [(8, 16711935), (4, 252645135), (2, 858993459), (1, 1431655765)]:
        v = f"(({v} | ({v} << {shift})) & {mask}::BIGINT)"
    return v


@query(f"""WITH boxes AS (
        SELECT c_custkey AS id, c_custkey * 37 % 1000 AS xmin, c_custkey * 91 % 700 AS ymin,
               c_custkey * 37 % 1000 + 5 + c_nationkey AS xmax, c_custkey * 91 % 700 + 3 AS ymax
        FROM customer),
    cell AS (
        SELECT *, least(greatest(CAST(floor(((xmin + xmax) / 2) / 1030e0 * 65536e0) AS BIGINT), 0), 65535) AS cx,
               least(greatest(CAST(floor(((ymin + ymax) / 2) / 710e0 * 65536e0) AS BIGINT), 0), 65535) AS cy
        FROM boxes)
    SELECT id, xmin, ymin, xmax, ymax, {spread_sql("cx")} | ({spread_sql("cy")} << 1) AS z FROM cell""")
def zorder_features(spark: SparkSession, sf: str) -> DataFrame:
    """Z-order number of every customer's box."""
    k = F.col("c_custkey")
    boxes = V.table(spark, sf, "customer").select(
        k.alias("id"), (k * 37 % 1000).alias("xmin"), (k * 91 % 700).alias("ymin"),
        (k * 37 % 1000 + 5 + F.col("c_nationkey")).alias("xmax"), (k * 91 % 700 + 3).alias("ymax"),
    )
    return with_zorder(boxes, (0.0, 0.0, 1030.0, 710.0))


@query(with_views("series chunks cells", """
    SELECT 'events' AS dataset, var AS variable, count(value) AS n, min(value) AS value_min,
           max(value) AS value_max, CAST(min(loc) AS BIGINT) AS j_min, CAST(max(loc) AS BIGINT) AS j_max,
           CAST(1 AS BIGINT) AS i_min, CAST(1 AS BIGINT) AS i_max, min(time) AS time_first,
           max(time) AS time_last
    FROM series GROUP BY var
    UNION ALL
    SELECT 'forcing', var, count(value), min(value), max(value), min(j), max(j), min(i), max(i),
           min(time), max(time) FROM cells GROUP BY var
    UNION ALL
    SELECT 'lineitem', 'l_quantity', count(l_quantity), min(l_quantity), max(l_quantity),
           -1, -1, -1, -1, NULL, NULL FROM lineitem
    UNION ALL
    SELECT 'lineitem', 'l_discount', count(l_discount), min(l_discount), max(l_discount),
           -1, -1, -1, -1, NULL, NULL FROM lineitem"""))
def dataset_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Variables of an event table, a block store and a plain table."""
    events = V.series(spark, sf).select(
        "var", "time", F.col("loc").alias("j"), F.lit(1).cast("bigint").alias("i"), "value"
    )
    forcing = describe_chunks(V.chunks(spark, sf), "forcing")
    plain = describe_table(V.table(spark, sf, "lineitem"), "lineitem", ["l_quantity", "l_discount"])
    described = (
        describe_cells(events, "events").unionByName(forcing)
        .unionByName(plain, allowMissingColumns=True)
    )
    # a plain table has no index extent
    return described.fillna(-1, ["j_min", "j_max", "i_min", "i_max"])
