"""Queries that write through a sink and read the result back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from basinflow import schemas
from basinflow.functions.gridindex import IndexBounds, bbox_bounds, grid_extent
from basinflow.functions.names import basename
from basinflow.operators import cells as C
from basinflow.operators import weights as W
from basinflow.operators.metadata import describe_chunks
from basinflow.operators.pyramid import read_overview
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.queries_grid import (
    EXTENT, LEVELS, NEAREST, TILE, TILED, as_double, forcing_cells, forcing_levels,
)
from basinflow.plans.views import with_views
from basinflow.session import scratch_path
from basinflow.sources import curve, geojson, netcdf, sinks, stores, tables


@query(with_views("wts rect full_basins", """
    SELECT CAST(i_index - 10 AS INTEGER) AS i_index, CAST(j_index - 1 AS INTEGER) AS j_index, IDmask,
           round(weight / sum(weight) OVER (PARTITION BY IDmask), 9) AS weight, regridweight
    FROM rect WHERE IDmask IN (SELECT IDmask FROM full_basins)"""))
def weights_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Subset weights written by name and read back."""
    out = scratch_path(spark, "weights")
    wts = V.weights(spark, sf)
    rows, polys = W.subset_weights(wts, V.polys(spark, sf), W.full_basins(wts, V.RECT), V.RECT)
    sinks.write_weights(rows, polys, out)
    return tables.read_weights(spark, out)[0].withColumn("weight", F.round("weight", 9))


@query(with_views("links", """
    SELECT link, "to", lon, lat, ascendingIndex, NHDWaterbodyComID, trim(gages) AS site_no FROM links"""))
def links_read(spark: SparkSession, sf: str) -> DataFrame:
    """Links read with all variables but the time, gauge numbers trimmed."""
    out = scratch_path(spark, "links")
    V.links(spark, sf).withColumn("time", F.lit(0)).write.parquet(out)
    return tables.read_links(spark, out).drop("gages")


@query(with_views("links", "SELECT trim(gages) AS gages, link, ascendingIndex FROM links"))
def links_read_some(spark: SparkSession, sf: str) -> DataFrame:
    """Only the asked variables of the links."""
    out = scratch_path(spark, "links")
    sinks.write_dataset(V.links(spark, sf), out)
    some = tables.read_links(spark, out, ["gages", "link", "ascendingIndex"])
    return some.withColumn("gages", F.trim("gages"))


@query("SELECT c_custkey AS ComID, CAST(c_acctbal AS FLOAT)::DOUBLE AS c_acctbal FROM customer")
def buckets_conformed(spark: SparkSession, sf: str) -> DataFrame:
    """Only columns the target knows, in its types."""
    out = scratch_path(spark, "buckets")
    template = V.buckets(spark, sf).select(
        F.col("c_acctbal").cast("float").alias("c_acctbal"), "ComID", F.lit("x").alias("other")
    )
    sinks.write_conformed(V.buckets(spark, sf), template, out)
    return tables.read_params(spark, out).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query(with_views("hydro", """
    SELECT 'wb-' || n AS id, 'nex-' || below AS toid, o_totalprice FROM base WHERE vpu_id = '101'"""))
def hydrofabric_read(spark: SparkSession, sf: str) -> DataFrame:
    """Flowpaths of one vector processing unit, stored by unit."""
    out = scratch_path(spark, "hydrofabric")
    V.hydrofabric(spark, sf)[0]["flowpaths"].write.partitionBy("vpu_id").parquet(f"{out}/flowpaths")
    return tables.read_hydrofabric(spark, out, "101", ["flowpaths"])["flowpaths"].drop("vpu_id")


@query(with_views("series", """
    SELECT loc, var, count(*) AS n, CASE WHEN var IN ('click', 'view') THEN round(sum(value), 4)
                                         ELSE -1 END AS total
    FROM series GROUP BY loc, var"""))
def results_read(spark: SparkSession, sf: str) -> DataFrame:
    """A folder holding Parquet results and CSV results without one of the columns."""
    out = scratch_path(spark, "results")
    sums = V.series(spark, sf).groupBy("loc", "var").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )
    first = F.col("var").isin("click", "view")
    sinks.publish(sums.filter(first), out)
    sums.filter(~first).drop("total").write.mode("append").csv(out, header=True)
    schema = PT.StructType([
        PT.StructField("loc", PT.LongType()), PT.StructField("var", PT.StringType()),
        PT.StructField("n", PT.LongType()),
    ])
    return tables.read_results(spark, out, schema).fillna(-1.0, ["total"])


@query(with_views("lcc chunks cells grid", """
    SELECT 'land' AS grid_id, min(x) - 500 AS xmin, max(x) + 500 AS xmax, min(y) - 500 AS ymin,
           max(y) + 500 AS ymax, CAST(count(DISTINCT x) AS INTEGER) AS ncol,
           CAST(count(DISTINCT y) AS INTEGER) AS nrow, 'EPSG:4326' AS spatial_ref
    FROM grid"""))
def grid_template(spark: SparkSession, sf: str) -> DataFrame:
    """Extent and coordinate system of a stored grid template."""
    out = scratch_path(spark, "grid")
    cells = V.grid_cells(spark, sf).select(F.lit("land").alias("grid_id"), "j", "i", "x", "y", "lon", "lat")
    sinks.write_tables({
        "cells": cells,
        "attrs": cells.select(
            F.col("grid_id").alias("dataset"), F.lit("crs").alias("variable"),
            F.lit("spatial_ref").alias("name"), F.lit("c").alias("type"),
            F.array(F.lit("EPSG:4326")).alias("value"),
        ).distinct(),
    }, out)
    stored, attrs = tables.read_grid(spark, out)
    crs = tables.spatial_ref(attrs, "land")
    return grid_extent(stored, 1000.0, by=["grid_id"]).withColumn("spatial_ref", F.lit(crs))


@query(with_views("chunks cells", "SELECT var, time, j, i, value FROM cells"))
def blocks_concat(spark: SparkSession, sf: str) -> DataFrame:
    """Two stores read as one dataset, one time step per partition."""
    out = scratch_path(spark, "blocks")
    blocks = V.chunks(spark, sf)
    noon = V.ntz(V.BASE_TIME + timedelta(hours=12))
    sinks.write_tables({
        "am": blocks.filter(F.col("time") < noon), "pm": blocks.filter(F.col("time") >= noon)
    }, out)
    both = tables.read_chunks(spark, [f"{out}/am", f"{out}/pm"])
    return as_double(C.explode_cells(C.rechunk(both)))


@query(with_views("chunks cells", """
    SELECT var, time, j, i, value FROM cells
    WHERE time BETWEEN TIMESTAMP '2024-01-01 05:00:00' AND TIMESTAMP '2024-01-01 14:00:00'
      AND j BETWEEN 6 AND 19 AND i BETWEEN 10 AND 33"""))
def store_window(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a window, read from a store of which only the chunks that meet it are planned."""
    out = scratch_path(spark, "store")
    stores.write_store(V.chunks(spark, sf), out, (V.grid_height(spark, sf), V.WIDTH), (6, *V.BLOCK), packed=True)
    hour = [V.BASE_TIME + timedelta(hours=h) for h in (5, 14)]
    box = IndexBounds(10, 33, 6, 19)
    return as_double(C.explode_cells(C.hyperslab(stores.read_store(spark, out, *hour, box), box))).select(
        "var", "time", "j", "i", "value")


@query(with_views("chunks cells", """
    SELECT var, time, j, i, value FROM cells
    WHERE time BETWEEN TIMESTAMP '2024-01-01 04:00:00' AND TIMESTAMP '2024-01-01 19:00:00'
      AND NOT time BETWEEN TIMESTAMP '2024-01-01 08:00:00' AND TIMESTAMP '2024-01-01 10:00:00'"""))
def blocks_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of the hours in a listing with a gap."""
    out = scratch_path(spark, "blocks")
    sinks.write_dataset(V.chunks(spark, sf), out)
    hours = V.chunks(spark, sf).select(F.col("time").alias("valid_time")).distinct()
    listing = C.concat([
        C.time_slice(hours, datetime(2024, 1, 1, 4), datetime(2024, 1, 1, 7), "valid_time"),
        C.time_slice(hours, datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 19), "valid_time"),
    ])
    return as_double(C.explode_cells(tables.open_listed(spark, listing, out)))


@query(with_views("chunks cells", f""", {LEVELS}, {NEAREST}
    SELECT var, time, {TILED} FROM nearest WHERE level = (SELECT max(level) FROM lv)"""))
def pyramid_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The smallest overview of a stored pyramid."""
    out = scratch_path(spark, "pyramid")
    sinks.write_pyramid(forcing_cells(spark, sf), out, forcing_levels(spark, sf), TILE)
    return read_overview(sinks.read_pyramid(spark, out))


@query("""SELECT c_custkey AS id, c_custkey * 37 % 1000 AS xmin, c_custkey * 91 % 700 AS ymin,
           c_custkey * 37 % 1000 + 5 + c_nationkey AS xmax, c_custkey * 91 % 700 + 3 AS ymax
    FROM customer WHERE c_custkey * 37 % 1000 <= 300 AND c_custkey * 37 % 1000 + 5 + c_nationkey >= 100
      AND c_custkey * 91 % 700 <= 250 AND c_custkey * 91 % 700 + 3 >= 120""")
def features_by_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes that meet a box, read by ranges of the Hilbert curve they are stored along."""
    out = scratch_path(spark, "curve")
    k = F.col("c_custkey")
    x, y = k * 37 % 1000, k * 91 % 700
    boxes = V.table(spark, sf, "customer").select(
        k.alias("id"), x.alias("xmin"), y.alias("ymin"), (x + 5 + F.col("c_nationkey")).alias("xmax"), (y + 3).alias("ymax"))
    curve.write_along_curve(boxes, out, (0.0, 0.0, 1030.0, 710.0), "id")
    return curve.read_box(spark, out, (100, 120, 300, 250))


@query("""SELECT c_custkey AS id, (c_custkey * 37 % 1000)::DOUBLE AS xmin,
           (c_custkey * 91 % 700)::DOUBLE AS ymin
    FROM customer WHERE c_custkey * 37 % 1000 BETWEEN 100 AND 300 AND c_custkey * 91 % 700 <= 250""")
def features_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a box, from a table stored along a Z-order curve."""
    out = scratch_path(spark, "features")
    k = F.col("c_custkey")
    points = V.table(spark, sf, "customer").select(
        k.alias("id"), (k * 37 % 1000).cast("double").alias("xmin"),
        (k * 91 % 700).cast("double").alias("ymin"),
    ).withColumns({"xmax": F.col("xmin"), "ymax": F.col("ymin")})
    sinks.write_clustered(points, out, (0.0, 0.0, 1000.0, 700.0), "id")
    found = tables.read_features(spark, out).filter("xmin BETWEEN 100 AND 300 AND ymin <= 250")
    return found.select("id", "xmin", "ymin")


@query(with_views("vertices", "SELECT poly_id, part, ring, seq, x, y FROM vertices"))
def boundary_read(spark: SparkSession, sf: str) -> DataFrame:
    """Polygon vertices read from GeoJSON, one feature per line."""
    out = scratch_path(spark, "boundary")
    V.features(spark, sf).write.text(out)
    return geojson.read_polygons(spark, out, "ID", lines=True)


# A collection with members beside its features, and text that looks like structure.
OPENING = r'{"type":"FeatureCollection","name":"a brace } and a \"quote\" {","crs":{"properties":{"name":"x"}},"features":['


@query(with_views("vertices", "SELECT poly_id, part, ring, seq, x, y FROM vertices"))
def boundary_collection(spark: SparkSession, sf: str) -> DataFrame:
    """The same read from one file that holds all features as one collection, on as many tasks as it has splits."""
    out = scratch_path(spark, "collection")
    texts = V.features(spark, sf).select(F.concat(F.lit(","), "value").alias("value"))
    first = spark.createDataFrame([(0, OPENING + r'{"type":"Note","text":"none: {\\"}'), (2, "]}")], "k int, value string")
    whole = first.unionByName(texts.select(F.lit(1).alias("k"), "value"))
    whole.repartition(1).sortWithinPartitions("k").select("value").write.option("lineSep", " ").text(out)
    return geojson.read_polygons(spark, out, "ID")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS poly_id FROM supplier")
def boundary_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of boundary records: the first attribute as text."""
    out = scratch_path(spark, "boundary")
    V.features(spark, sf).write.text(out)
    return tables.polygon_ids(geojson.read_records(spark, out, ["ID", "nation"], lines=True))


@query(with_views("lcc sites", f""", {EXTENT},
    box AS (SELECT min(w) AS w, max(e) AS e, min(r0) AS r0, max(r1) AS r1, min(s) AS s, max(n) AS n
            FROM extent),
    lines AS (
        SELECT '"hyd_sn"' AS g, (w - 1) * 4 + 1 AS a, e * 4 AS b, (s - 1) * 4 + 1 AS c, n * 4 AS d FROM box
        UNION ALL SELECT '"hyd_ns"', (w - 1) * 4 + 1, e * 4, (r0 - 1) * 4 + 1, r1 * 4 FROM box
        UNION ALL SELECT '"geo_sn"', w, e, s, n FROM box
        UNION ALL SELECT '"geo_ns"', w, e, r0, r1 FROM box)
    SELECT '"grid"' || chr(9) || '"imin"' || chr(9) || '"imax"' || chr(9) || '"jmin"' || chr(9) || '"jmax"'
           || chr(9) || '"index_start"' AS value
    UNION ALL
    SELECT g || chr(9) || a || chr(9) || b || chr(9) || c || chr(9) || d || chr(9) || '1' FROM lines"""))
def bounds_text(spark: SparkSession, sf: str) -> DataFrame:
    """Index bounds of the box around all links, as the text file written for a domain."""
    out = scratch_path(spark, "params")
    sinks.write_bounds(bbox_bounds(V.sites(spark, sf), V.LAND), out)
    return spark.read.text(out)


@query(with_views("chunks cells", """
    SELECT 'forcing' AS dataset, var AS variable, count(value) AS n, min(value) AS value_min,
           max(value) AS value_max, CAST(min(j) AS BIGINT) AS j_min, CAST(max(j) AS BIGINT) AS j_max
    FROM cells GROUP BY var"""))
def metadata_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata documents written as JSON and read back."""
    out = scratch_path(spark, "meta")
    sinks.write_metadata(describe_chunks(V.chunks(spark, sf), "forcing"), out)
    schema = PT.StructType([
        PT.StructField("variable", PT.StringType()), PT.StructField("n", PT.LongType()),
        PT.StructField("value_min", PT.DoubleType()), PT.StructField("value_max", PT.DoubleType()),
        PT.StructField("j_min", PT.LongType()), PT.StructField("j_max", PT.LongType()),
    ])
    docs = spark.read.schema(schema).json(out, pathGlobFilter="part-*")
    return docs.withColumn("dataset", F.lit("forcing"))


FILES = """files AS (
        SELECT strftime(time, '%Y%m%d%H') || '.T2D.' || y0 || '.' || x0 || '.nc' AS name FROM chunks)"""
# classic header: 8 bytes, two dimensions, no attributes, one variable
HEADER_BYTES = 8 + (8 + 2 * 12) + 8 + (8 + 4 + 4 + 4 + 8 + 8 + 4 + 4 + 4)
ARRAY = (
    '{"chunks": [4, 16], "compressor": null, "dtype": ">f4", "fill_value": null, "filters": null,'
    ' "order": "C", "shape": [4, 16], "zarr_format": 2}'
)


@query(with_views("chunks", f""", {FILES},
    entries(key, inline, pos, length) AS (VALUES
        ('.zgroup', '{{"zarr_format": 2}}', 0::BIGINT, 0::BIGINT),
        ('.zattrs', '{{}}', 0, 0),
        ('T2D/.zarray', '{ARRAY}', 0, 0),
        ('T2D/.zattrs', '{{"_ARRAY_DIMENSIONS": ["y", "x"]}}', 0, 0),
        ('T2D/0.0', '', {HEADER_BYTES}, 256))
    SELECT name, key, inline, pos AS "offset", length FROM files, entries"""))
def header_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks written as classic NetCDF files, and the references found in their headers."""
    out = scratch_path(spark, "netcdf")
    netcdf.write_blocks(V.chunks(spark, sf), out)
    refs = netcdf.scan_headers(spark, out, "*.nc")
    return refs.select(basename(F.col("path")).alias("name"), "key", "inline", "offset", "length").fillna(
        "", ["inline"]
    )


@query(with_views("chunks", f""", {FILES}
    SELECT replace(name, '.nc', '.json') AS name, 6::BIGINT AS lines, 1::BIGINT AS versions FROM files"""))
def refs_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the JSON document written for each of these files."""
    out, docs = scratch_path(spark, "netcdf"), scratch_path(spark, "refs")
    netcdf.write_blocks(V.chunks(spark, sf), out)
    netcdf.write_refs(netcdf.scan_headers(spark, out, "*.nc"), docs)
    return spark.read.text(docs).groupBy("name").agg(
        F.count("*").alias("lines"),
        F.count(F.when(F.col("value").startswith('{"version":1,'), 1)).alias("versions"),
    )
