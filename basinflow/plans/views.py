"""The model's tables, derived from the generic test tables.

Each function returns the Spark view; ``SQL`` holds the same derivation as a common table expression
for the SQL checks.
"""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.crs import lcc_forward
from basinflow.functions.gridindex import Grid, IndexBounds, cell_centre
from basinflow.functions.timestamps import hour_of, hours, ntz, stamp

# Parameters shared by the queries below.
RECT = IndexBounds(imin=11, imax=60, jmin=2, jmax=20)
ENVELOPE = {"lon_min": -115.0, "lon_max": -90.0, "lat_min": 30.0, "lat_max": 42.0}
LAND = Grid(xmin=-2_800_000.0, ymax=2_000_000.0, res=1000.0, ncol=5600, nrow=4000)
BLOCK = (4, 16)
WIDTH = 48
BASE_TIME = datetime(2024, 1, 1)
LISTING_BASE = datetime(2009, 12, 31)


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its files are listed and its footer read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


# -- weights -------------------------------------------------------------------------------------

def weights(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as basins: compact blocks of cells whose weights add up to one per basin."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("IDmask"),
        (F.col("l_partkey") % 90 + F.col("l_suppkey") % 10 + 1).alias("i_index"),
        (div(F.col("l_partkey"), 90) + F.col("l_linenumber")).alias("j_index"),
        "l_quantity",
        F.col("l_discount").alias("regridweight"),
    )
    totals = rows.groupBy("IDmask").agg(F.sum("l_quantity").alias("_total"))
    return rows.join(totals, "IDmask").select(
        "i_index", "j_index", "IDmask",
        (F.col("l_quantity") / F.col("_total")).alias("weight"), "regridweight",
    )


def polys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("polyid"), F.col("p_size").alias("overlaps")
    )


# -- network -------------------------------------------------------------------------------------

def links(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a binary tree of links."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("link"),
        div(k, 2).alias("to"),
        (F.lit(-120.0) + (F.col("o_custkey") % 500) / 10).alias("lon"),
        (F.lit(25.0) + (k % 250) / 10).alias("lat"),
        F.when(k % 5 == 0, F.lpad(div(k, 5).cast("string"), 15, " "))
        .otherwise(F.repeat(F.lit(" "), 15)).alias("gages"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("ascendingIndex"),
        F.when(k % 7 == 0, F.col("o_custkey") % 100).otherwise(F.lit(0).cast("bigint"))
        .alias("NHDWaterbodyComID"),
    )


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Projected link locations, grouped into sites of neighbouring customers."""
    spots = table(spark, sf, "orders").select(
        div(F.col("o_custkey"), 5).alias("site"),
        (F.lit(-120.0) + (F.col("o_custkey") % 500) / 10).alias("lon"),
        (F.lit(25.0) + (F.col("o_orderkey") % 250) / 10).alias("lat"),
        F.col("o_orderkey").alias("link"),
    )
    x, y = lcc_forward(F.col("lon"), F.col("lat"))
    return spots.withColumns({"x": x, "y": y})


def buckets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ComID"), F.lit(0).alias("Basin"),
        F.col("c_custkey").alias("ind"), "c_acctbal",
    )


def lakes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("lake_id"),
        F.floor(F.col("s_acctbal") / 100).cast("int").alias("ascendingIndex"),
    )


def lake_types(spark: SparkSession, sf: str) -> DataFrame:
    """The lowest positive link of each lake is its outlet."""
    return (
        links(spark, sf).filter("NHDWaterbodyComID > 0 AND link > 0")
        .groupBy("NHDWaterbodyComID").agg(F.min("link").alias("LINKID"))
        .select("LINKID", F.lit(1).alias("TYPEL"))
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    e = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf, "embeddings").withColumn("e", e).select(
        F.lpad(F.col("vec_id").cast("string"), 15, " ").alias("stationId"),
        F.col("label").cast("double").alias("R"),
        F.element_at("e", 1).alias("G"), F.element_at("e", 2).alias("tau"),
        F.slice("e", 1, 12).alias("qThresh"),
        F.transform(
            F.sequence(F.lit(0), F.lit(3)), lambda r: F.slice(F.col("e"), r * 12 + 13, 12)
        ).alias("expCoeff"),
    )


def hydrofabric(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Layers and edges: each link is a flowpath draining to the nexus above the next one."""
    base = table(spark, sf, "orders").filter("o_orderkey > 0").select(
        F.col("o_orderkey").alias("n"), div(F.col("o_orderkey"), 2).alias("below"),
        "o_custkey", "o_totalprice",
    ).withColumn("vpu_id", F.substring(F.bin("n"), 1, 3))
    wb = F.concat(F.lit("wb-"), F.col("n").cast("string"))
    nex = F.concat(F.lit("nex-"), F.col("below").cast("string"))
    cat = F.concat(F.lit("cat-"), F.col("n").cast("string"))
    flowpaths = base.select(wb.alias("id"), nex.alias("toid"), "vpu_id", "o_totalprice")
    nexus = base.filter("below > 0").select(
        nex.alias("id"), F.concat(F.lit("wb-"), F.col("below").cast("string")).alias("toid"),
        F.substring(F.bin("below"), 1, 3).alias("vpu_id"),
    ).distinct()
    layers = {
        "flowpaths": flowpaths,
        "nexus": nexus,
        "catchments": base.select(cat.alias("divide_id"), wb.alias("id"), "vpu_id"),
        "attributes": base.select(cat.alias("divide_id"), "vpu_id", "o_custkey"),
        "crosswalk": base.select(wb.alias("id"), "vpu_id", F.col("o_custkey").alias("comid")),
    }
    edges = flowpaths.select("id", "toid", "vpu_id").unionByName(nexus)
    return layers, edges


# -- grids ---------------------------------------------------------------------------------------

def forcing(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as 4 by 16 blocks of an hourly grid 48 columns wide, 24 hours per block."""
    v = F.col("vec_id")
    tile = div(v, 24)
    return table(spark, sf, "embeddings").select(
        F.lit("T2D").alias("var"),
        (ntz(BASE_TIME) + hours(v % 24)).alias("time"),
        (div(tile, 3) * 4 + 1).cast("int").alias("y0"),
        (tile % 3 * 16 + 1).cast("int").alias("x0"),
        F.lit(4).alias("ny"), F.lit(16).alias("nx"),
        F.col("embedding").alias("data"),
        "label",
    )


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return forcing(spark, sf).drop("label")


def axis_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """x and y axes of the forcing grid: 1 km cells counted from the south-west."""
    blocks = chunks(spark, sf).select("y0", "x0", "ny", "nx").distinct()
    i = F.explode(F.sequence(F.col("x0"), F.col("x0") + F.col("nx") - 1)).alias("i")
    j = F.explode(F.sequence(F.col("y0"), F.col("y0") + F.col("ny") - 1)).alias("j")
    xs = blocks.select(i).distinct().withColumn("x", F.lit(100_000.0) + (F.col("i") - 0.5) * 1000)
    ys = blocks.select(j).distinct().withColumn("y", F.lit(-50_000.0) + (F.col("j") - 0.5) * 1000)
    return xs, ys


def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Grid template: axes paired to a mesh with 2-D lon and lat."""
    from basinflow.functions.crs import meshgrid, with_lonlat

    xs, ys = axis_tables(spark, sf)
    return with_lonlat(meshgrid(xs, ys))


def grid_height(spark: SparkSession, sf: str) -> int:
    row = chunks(spark, sf).agg(F.max(F.col("y0") + F.col("ny") - 1).alias("h")).first()
    return row.h


# Vertices of the test polygons and of their holes, in radii from the centre.
OUTER = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (0.0, 0.0), (-1.0, 1.0), (-1.0, -1.0)]
HOLE = [(-0.25, -0.75), (0.25, -0.75), (0.25, -0.375), (-0.25, -0.375), (-0.25, -0.75)]


def shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Centre and radius of each supplier's polygon in index space."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey",
        ((k * 7 % 44 + 3).cast("double") + 0.35).alias("cx"),
        ((k * 13 % 25 + 2).cast("double") + 0.7).alias("cy"),
        (k % 6 + 3).cast("double").alias("r"),
    )


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as concave polygons in index space; every second one has a hole."""

    def point(ring: int, seq: int, dx: float, dy: float) -> Column:
        return F.struct(
            F.lit(ring).alias("ring"), F.lit(seq).alias("seq"),
            (F.col("cx") + F.col("r") * dx).alias("x"), (F.col("cy") + F.col("r") * dy).alias("y"),
        )

    points = F.array(*[point(0, s, *p) for s, p in enumerate(OUTER)])
    with_hole = F.concat(points, F.array(*[point(1, s, *p) for s, p in enumerate(HOLE)]))
    vertices = F.when(F.col("s_suppkey") % 2 == 0, with_hole).otherwise(points)
    return shapes(spark, sf).select(
        F.col("s_suppkey").cast("string").alias("poly_id"), "s_nationkey", F.lit(0).alias("part"),
        F.inline(vertices),
    )


def features(spark: SparkSession, sf: str, place=lambda x, y: (x, y)) -> DataFrame:
    """The same polygons as GeoJSON features, one text per polygon; ``place`` makes its coordinates."""

    def ring(points: list[tuple[float, float]]) -> Column:
        return F.array(*[
            F.array(*place(F.col("cx") + F.col("r") * dx, F.col("cy") + F.col("r") * dy)) for dx, dy in points
        ])

    rings = F.when(F.col("s_suppkey") % 2 == 0, F.array(ring(OUTER), ring(HOLE))).otherwise(
        F.array(ring(OUTER))
    )
    return shapes(spark, sf).select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").alias("nation")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"),
    )).alias("value"))


def lonlat_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """The same shapes as small lon/lat polygons."""
    return polygons(spark, sf).withColumns({
        "x": F.lit(-100.0) + F.col("x") / 4, "y": F.lit(35.0) + F.col("y") / 4
    })


# -- time ----------------------------------------------------------------------------------------

def series(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an hourly series."""
    return table(spark, sf, "events").select(
        "event_id", hour_of(F.col("ts")).alias("time"), F.col("event_type").alias("var"),
        F.col("user_id").alias("loc"), "value",
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as an hourly archive, one file per page."""
    t = ntz(LISTING_BASE) + hours(F.col("page_id"))
    return table(spark, sf, "pages").select(
        F.concat(
            F.lit("archive/forcing/"), F.year(t).cast("string"), F.lit("/"),
            stamp(t, minutes=False), F.lit(".LDASIN_DOMAIN1.json"),
        ).alias("path"),
        F.year(t).alias("year"),
    )


def land_centre(row: Column, col: Column) -> tuple[Column, Column]:
    return cell_centre(row, col, LAND)


# -- the same derivations in SQL -------------------------------------------------------------------

SQL: dict[str, str] = {
    "wts": """wts AS (
        SELECT l_partkey % 90 + l_suppkey % 10 + 1 AS i_index,
               l_partkey // 90 + l_linenumber AS j_index, l_partkey AS IDmask,
               l_quantity / sum(l_quantity) OVER (PARTITION BY l_partkey) AS weight,
               l_discount AS regridweight
        FROM lineitem)""",
    "rect": "rect AS (SELECT * FROM wts WHERE i_index BETWEEN 11 AND 60 AND j_index BETWEEN 2 AND 20)",
    "full_basins": """full_basins AS (
        SELECT IDmask FROM rect GROUP BY IDmask HAVING sum(weight) > 0.999)""",
    "links": """links AS (
        SELECT o_orderkey AS link, o_orderkey // 2 AS "to",
               -120e0 + (o_custkey % 500) / 10 AS lon, 25e0 + (o_orderkey % 250) / 10 AS lat,
               CASE WHEN o_orderkey % 5 = 0 THEN lpad(CAST(o_orderkey // 5 AS VARCHAR), 15, ' ')
                    ELSE repeat(' ', 15) END AS gages,
               CAST(floor(o_totalprice / 1000) AS INTEGER) AS ascendingIndex,
               CASE WHEN o_orderkey % 7 = 0 THEN o_custkey % 100 ELSE 0 END AS NHDWaterbodyComID
        FROM orders)""",
    "lcc": """lcc AS (
        SELECT n, 6370000e0 * cos(radians(30e0)) * pow(tan(pi() / 4 + radians(30e0) / 2), n) / n AS rf
        FROM (SELECT ln(cos(radians(30e0)) / cos(radians(60e0)))
                     / ln(tan(pi() / 4 + radians(60e0) / 2) / tan(pi() / 4 + radians(30e0) / 2)) AS n)),
        lcc0 AS (
        SELECT n, rf, rf / pow(tan(pi() / 4 + radians(40.0000076293945e0) / 2), n) AS rho0 FROM lcc)""",
    "sites": """sites AS (
        SELECT link, site, lon, lat,
               rf / pow(tan(pi() / 4 + radians(lat) / 2), n) * sin(n * radians(lon + 97e0)) AS x,
               rho0 - rf / pow(tan(pi() / 4 + radians(lat) / 2), n) * cos(n * radians(lon + 97e0)) AS y
        FROM (SELECT o_orderkey AS link, o_custkey // 5 AS site,
                     -120e0 + (o_custkey % 500) / 10 AS lon, 25e0 + (o_orderkey % 250) / 10 AS lat
              FROM orders), lcc0)""",
    "chunks": """chunks AS (
        SELECT 'T2D' AS var, TIMESTAMP '2024-01-01' + to_hours(vec_id % 24) AS time,
               CAST(vec_id // 24 // 3 * 4 + 1 AS INTEGER) AS y0,
               CAST(vec_id // 24 % 3 * 16 + 1 AS INTEGER) AS x0,
               label, embedding AS data
        FROM embeddings)""",
    "cells": """cells AS (
        SELECT var, time, label, CAST(y0 + p // 16 AS INTEGER) AS j,
               CAST(x0 + p % 16 AS INTEGER) AS i, CAST(v AS DOUBLE) AS value
        FROM (SELECT var, time, label, y0, x0, unnest(data) AS v,
                     generate_subscripts(data, 1) - 1 AS p FROM chunks))""",
    "grid": """axes AS (SELECT DISTINCT j, i FROM cells),
        grid AS (
        SELECT j, i, x, y, degrees(atan2(x, rho0 - y)) / n - 97e0 AS lon,
               degrees(2 * atan(pow(rf / sqrt(x * x + (rho0 - y) * (rho0 - y)), 1 / n))) - 90e0 AS lat
        FROM (SELECT a.j, b.i, 100000e0 + (b.i - 0.5e0) * 1000 AS x,
                     -50000e0 + (a.j - 0.5e0) * 1000 AS y
              FROM (SELECT DISTINCT j FROM axes) a, (SELECT DISTINCT i FROM axes) b), lcc0)""",
    "vertices": """shape AS (
        SELECT s_suppkey, s_nationkey, CAST(s_suppkey * 7 % 44 + 3 AS DOUBLE) + 0.35e0 AS cx,
               CAST(s_suppkey * 13 % 25 + 2 AS DOUBLE) + 0.7e0 AS cy,
               CAST(s_suppkey % 6 + 3 AS DOUBLE) AS r
        FROM supplier),
        offsets(ring, seq, dx, dy) AS (VALUES
            (0, 0, -1e0, -1e0), (0, 1, 1e0, -1e0), (0, 2, 1e0, 1e0), (0, 3, 0e0, 0e0),
            (0, 4, -1e0, 1e0), (0, 5, -1e0, -1e0),
            (1, 0, -0.25e0, -0.75e0), (1, 1, 0.25e0, -0.75e0), (1, 2, 0.25e0, -0.375e0),
            (1, 3, -0.25e0, -0.375e0), (1, 4, -0.25e0, -0.75e0)),
        vertices AS (
        SELECT CAST(s_suppkey AS VARCHAR) AS poly_id, s_nationkey, 0 AS part, ring, seq,
               cx + r * dx AS x, cy + r * dy AS y
        FROM shape, offsets WHERE ring = 0 OR s_suppkey % 2 = 0)""",
    "edges": """edges AS (
        SELECT a.poly_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
        FROM chosen a JOIN chosen b
          ON a.poly_id = b.poly_id AND a.ring = b.ring AND b.seq = a.seq + 1),
        places AS (SELECT DISTINCT j, i FROM cells),
        inside AS (
        SELECT poly_id, j, i FROM edges, places
        WHERE (y1 <= j) <> (y2 <= j) AND i >= x1 + (j - y1) * (x2 - x1) / (y2 - y1)
        GROUP BY poly_id, j, i HAVING count(*) % 2 = 1),
        covered AS (SELECT DISTINCT j, i FROM inside)""",
    "series": """series AS (
        SELECT event_id, date_trunc('hour', ts) AS time, event_type AS var, user_id AS loc, value
        FROM events)""",
    "zones": """zones AS (
        SELECT IDmask AS id, j_index AS j, i_index AS i, sum(weight) AS w
        FROM wts GROUP BY ALL)""",
    "hydro": """base AS (
        SELECT o_orderkey AS n, o_orderkey // 2 AS below, o_custkey, o_totalprice,
               substr(bin(o_orderkey), 1, 3) AS vpu_id
        FROM orders WHERE o_orderkey > 0)""",
}


def with_views(names: str, body: str, recursive: bool = False) -> str:
    """A SQL check: the named views, then the query."""
    ctes = ",\n".join(SQL[n] for n in names.split())
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
