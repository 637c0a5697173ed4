"""Queries running whole jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from basinflow.functions.crs import lcc_inverse
from basinflow.functions.gridindex import Grid, IndexBounds
from basinflow.functions.timestamps import hours_between, ntz, stamp
from basinflow.operators.cells import explode_cells
from basinflow.operators.timebins import time_bins
from basinflow.plans import jobs
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.queries_network import IN_BOX, KEPT, SUBSET, VPU_ID, WB_ID
from basinflow.plans.views import with_views
from basinflow.session import scratch_path
from basinflow.sources.sinks import RunLayout, write_hourly, write_tables
from basinflow.sources.stores import write_store
from basinflow.streaming.clip import stream_chunks
from basinflow.streaming.status import REPORT, reported_status, stream_status

START, END = datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 20)


def grid(spark: SparkSession, sf: str) -> jobs.ForcingGrid:
    return jobs.ForcingGrid(V.grid_height(spark, sf), V.WIDTH, V.BLOCK)


def forcing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One archive file per hour of the forcing."""
    t = F.col("time")
    return V.chunks(spark, sf).select("time").distinct().select(
        F.concat(
            F.lit("archive/forcing/"), F.year(t).cast("string"), F.lit("/"),
            stamp(t, minutes=False), F.lit(".LDASIN_DOMAIN1.json"),
        ).alias("path"),
        F.year(t).alias("year"),
    )


MASKED = f"""chosen AS (SELECT * FROM vertices), {V.SQL["edges"]},
    box AS (SELECT min(j) AS j0, max(j) AS j1, min(i) AS i0, max(i) AS i1 FROM covered),
    masked AS (
        SELECT var, time, c.j, c.i, CASE WHEN m.j IS NOT NULL THEN value END AS value
        FROM cells c JOIN box ON c.j BETWEEN j0 AND j1 AND c.i BETWEEN i0 AND i1
        LEFT JOIN covered m ON m.j = c.j AND m.i = c.i)"""


@query(with_views("lcc chunks cells grid vertices", f""", {MASKED}
    SELECT var, time, j, i, value, x, y, round(lon, 7) AS lon, round(lat, 7) AS lat,
           strftime(time, '%Y%m%d%H%M') || '.LDASIN_DOMAIN1' AS part
    FROM masked JOIN grid USING (j, i)
    WHERE time BETWEEN TIMESTAMP '2024-01-01 03:00:00' AND TIMESTAMP '2024-01-01 20:00:00'"""))
def forcing_job_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """List, open, place, clip and name hourly outputs."""
    out = jobs.forcing_hourly(
        forcing_manifest(spark, sf), V.chunks(spark, sf), V.axis_tables(spark, sf),
        V.polygons(spark, sf), grid(spark, sf), START, END,
    )
    return out.withColumns({
        "value": F.col("value").cast("double"), "lon": F.round("lon", 7), "lat": F.round("lat", 7)
    })


@query(with_views("chunks", """,
    bins(bin, bin_start, bin_end, expected) AS (VALUES
        (0, TIMESTAMP '2024-01-01 03:00:00', TIMESTAMP '2024-01-01 12:00:00', 10::BIGINT),
        (1, TIMESTAMP '2024-01-01 13:00:00', TIMESTAMP '2024-01-01 20:00:00', 8::BIGINT))
    SELECT bin, bin_start, bin_end, expected, count(DISTINCT time) AS written,
           expected = count(DISTINCT time) AS ok
    FROM bins LEFT JOIN chunks ON time BETWEEN bin_start AND bin_end
    GROUP BY bin, bin_start, bin_end, expected"""))
def forcing_job_status(spark: SparkSession, sf: str) -> DataFrame:
    """The same job written out hour by hour, with the status of each group as read back."""
    return jobs.run_forcing_hourly(
        spark, scratch_path(spark, "hourly"), START, END,
        manifest=forcing_manifest(spark, sf), chunks=V.chunks(spark, sf),
        axes=V.axis_tables(spark, sf), polygons=V.polygons(spark, sf), grid=grid(spark, sf),
    )


@query(with_views("lcc chunks cells grid vertices", f""", {MASKED}
    SELECT var, time, j, i, value, x, y, round(lon, 7) AS lon, round(lat, 7) AS lat,
           strftime(time, '%Y%m%d%H%M') || '.LDASIN_DOMAIN1' AS part
    FROM masked JOIN grid USING (j, i)
    WHERE time BETWEEN TIMESTAMP '2024-01-01 03:00:00' AND TIMESTAMP '2024-01-01 20:00:00'"""))
def forcing_job_repair(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly job's output as stored, after a run that lost hours and a repair of the groups they belong to."""
    out = scratch_path(spark, "hourly")
    chunks = V.chunks(spark, sf)
    parts = {
        "manifest": forcing_manifest(spark, sf), "axes": V.axis_tables(spark, sf),
        "polygons": V.polygons(spark, sf), "grid": grid(spark, sf),
    }
    lost = chunks.filter(~F.hour("time").isin(15, 16))
    write_hourly(jobs.forcing_hourly(chunks=lost, start=START, end=END, **parts), out)
    jobs.repair_forcing_hourly(spark, out, START, END, chunks=chunks, **parts)
    return spark.read.parquet(out).withColumns({
        "value": F.col("value").cast("double"), "lon": F.round("lon", 7), "lat": F.round("lat", 7)
    })


@query(with_views("chunks", """,
    bins(bin, bin_start, bin_end, expected) AS (VALUES
        (0, TIMESTAMP '2024-01-01 03:00:00', TIMESTAMP '2024-01-01 07:00:00', 5::BIGINT),
        (1, TIMESTAMP '2024-01-01 08:00:00', TIMESTAMP '2024-01-01 12:00:00', 5::BIGINT),
        (2, TIMESTAMP '2024-01-01 13:00:00', TIMESTAMP '2024-01-01 17:00:00', 5::BIGINT),
        (3, TIMESTAMP '2024-01-01 18:00:00', TIMESTAMP '2024-01-01 20:00:00', 3::BIGINT)),
    came AS (SELECT time FROM chunks WHERE hour(time) <> 15)
    SELECT bin, bin_start, bin_end, expected, count(DISTINCT time) AS written,
           expected = count(DISTINCT time) AS ok
    FROM bins LEFT JOIN came ON time BETWEEN bin_start AND bin_end
    GROUP BY bin, bin_start, bin_end, expected"""))
def stream_group_status(spark: SparkSession, sf: str) -> DataFrame:
    """The groups that a stream of arriving hours reports, complete ones and one that an hour never came for."""
    schema = PT.StructType([PT.StructField("vec_id", PT.LongType())])
    arriving = stream_chunks(spark, sf, schema, table="embeddings.parquet").select(
        (ntz(V.BASE_TIME) + V.hours(F.col("vec_id") % 24)).alias("time")
    ).filter(F.hour("time") != 15)
    out = scratch_path(spark, "reports")
    stream_status(
        arriving, START, END, 5, 2, out, scratch_path(spark, "reports-log"), available_now=True
    ).awaitTermination()
    span = spark.createDataFrame([(START, END)], "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ")
    return reported_status(time_bins(span, 5), spark.read.schema(REPORT).parquet(out))


@query(with_views("chunks cells vertices", f""", {MASKED}
    SELECT * FROM masked WHERE time >= TIMESTAMP '2024-01-01 05:00:00' AND time < TIMESTAMP '2024-01-02'"""))
def forcing_job_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Slice and clip a block store into one dataset."""
    out = jobs.forcing_dataset(
        V.chunks(spark, sf), V.polygons(spark, sf), grid(spark, sf), "2024-01-01 05:00:00",
        "2024-01-01",
    )
    return out.withColumn("value", F.col("value").cast("double"))


def store_and_boundary(spark: SparkSession, sf: str) -> tuple[str, str, Grid]:
    """The forcing as a store and the polygons as a boundary file in longitude and latitude, with their grid."""
    height = V.grid_height(spark, sf)
    store, boundary = scratch_path(spark, "store"), scratch_path(spark, "boundary")
    write_store(V.chunks(spark, sf), store, (height, V.WIDTH), (6, *V.BLOCK))
    lonlat = V.features(
        spark, sf, lambda u, v: lcc_inverse(99_500.0 + u * 1000, -50_500.0 + v * 1000)
    )
    lonlat.write.text(boundary)
    return store, boundary, Grid(100_000.0, height * 1000.0 - 50_000.0, 1000.0, V.WIDTH, height)


def forcing_from_files(spark: SparkSession, sf: str) -> tuple[RunLayout, DataFrame]:
    store, boundary, land = store_and_boundary(spark, sf)
    layout = RunLayout(scratch_path(spark, "runs"), "forcing")
    return layout, jobs.run_forcing_files(
        spark, store, boundary, land, layout, START, END, "EPSG:4326", "ID", lines=True)


HOURS = "time BETWEEN TIMESTAMP '2024-01-01 03:00:00' AND TIMESTAMP '2024-01-01 20:00:00'"


# a store holds every cell of every hour, NULL where no block was written
@query(with_views("chunks cells vertices", f""", {MASKED}
    SELECT var, time, j, i, value
    FROM (
        SELECT v.var, TIMESTAMP '2024-01-01' + to_hours(h.h) AS time, y.j::INTEGER AS j, x.i::INTEGER AS i
        FROM (SELECT DISTINCT var FROM chunks) v, (SELECT unnest(range(3, 21)) AS h) h,
             (SELECT unnest(range(j0, j1 + 1)) AS j FROM box) y, (SELECT unnest(range(i0, i1 + 1)) AS i FROM box) x)
    LEFT JOIN masked USING (var, time, j, i)"""))
def forcing_files_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A store cut by a boundary file in longitude and latitude, as written."""
    layout, _ = forcing_from_files(spark, sf)
    return spark.read.parquet(f"{layout.forcing}/cells").withColumn("value", F.col("value").cast("double"))


@query(with_views("chunks cells vertices", f""", {MASKED}
    SELECT 'forcing' AS dataset, var AS variable, count(value) AS n, min(value) AS value_min,
           max(value) AS value_max, min(j) AS j_min, max(j) AS j_max, min(i) AS i_min, max(i) AS i_max,
           min(time) AS time_first, max(time) AS time_last
    FROM masked WHERE {HOURS} GROUP BY var"""))
def forcing_files_described(spark: SparkSession, sf: str) -> DataFrame:
    """The same job's description, gathered while its cells were written."""
    return forcing_from_files(spark, sf)[1]


# four different rectangles, so that a grid cut by the rows of another order shows
BOUNDS = {
    "hyd_sn": V.RECT, "hyd_ns": IndexBounds(11, 44, 4, 20), "geo_sn": IndexBounds(10, 40, 3, 14),
    "geo_ns": IndexBounds(10, 40, 6, 17),
}


@query(with_views("wts rect full_basins links chunks cells", f""", {KEPT},
    newlinks AS ({SUBSET})
    SELECT 'weights' AS part, IDmask AS id, i_index - 10 AS a, j_index - 1 AS b,
           round(weight / sum(weight) OVER (PARTITION BY IDmask), 9) AS v
    FROM rect WHERE IDmask IN (SELECT IDmask FROM full_basins)
    UNION ALL
    SELECT 'polys', IDmask, count(*), -1, NULL FROM rect
    WHERE IDmask IN (SELECT IDmask FROM full_basins) AND IDmask IN (SELECT p_partkey FROM part)
    GROUP BY IDmask
    UNION ALL
    SELECT 'links', link, "to", NHDWaterbodyComID, ascendingIndex FROM newlinks
    UNION ALL
    SELECT 'buckets', c_custkey, row_number() OVER (ORDER BY c_custkey), -1, c_acctbal
    FROM customer WHERE c_custkey IN (SELECT IDmask FROM full_basins)
    UNION ALL
    SELECT 'soil', epoch(time)::BIGINT, j - 2, i - 9, value FROM cells
    WHERE i BETWEEN 10 AND 40 AND j BETWEEN 3 AND 14
    UNION ALL
    SELECT 'template', epoch(time)::BIGINT, j - 5, i - 9, value FROM cells
    WHERE i BETWEEN 10 AND 40 AND j BETWEEN 6 AND 17
    UNION ALL
    SELECT 'route', epoch(time)::BIGINT, j - 3, i - 10, value FROM cells
    WHERE i BETWEEN 11 AND 44 AND j BETWEEN 4 AND 20"""))
def static_job(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of a domain cut to a box."""
    inputs = jobs.StaticInputs(
        weights=V.weights(spark, sf), polys=V.polys(spark, sf), links=V.links(spark, sf),
        buckets=V.buckets(spark, sf),
        land_grids={"soil": V.chunks(spark, sf), "template": V.chunks(spark, sf)},
        routing_grids={"route": V.chunks(spark, sf)}, row_orders={"template": "ns"},
    )
    envelope = spark.createDataFrame([V.ENVELOPE])
    parts = jobs.static_subset(inputs, BOUNDS, envelope)
    epoch = hours_between(ntz(datetime(1970, 1, 1)), F.col("time")) * 3600
    grids = {n: explode_cells(parts[n]).withColumn("epoch", epoch) for n in ("soil", "template", "route")}
    none = F.lit(-1)

    def rows(name: str, df: DataFrame, ident: str, a, b, v) -> DataFrame:
        return df.select(
            F.lit(name).alias("part"), F.col(ident).cast("bigint").alias("id"),
            a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), v.cast("double").alias("v"),
        )

    c = F.col
    return (
        rows("weights", parts["weights"], "IDmask", c("i_index"), c("j_index"),
             F.round("weight", 9))
        .unionByName(rows("polys", parts["polys"], "polyid", c("overlaps"), none, F.lit(None)))
        .unionByName(rows("links", parts["links"], "link", c("to"), c("NHDWaterbodyComID"),
                          c("ascendingIndex")))
        .unionByName(rows("buckets", parts["buckets"], "ComID", c("Basin"), none, c("c_acctbal")))
        .unionByName(rows("soil", grids["soil"], "epoch", c("j"), c("i"), c("value")))
        .unionByName(rows("template", grids["template"], "epoch", c("j"), c("i"), c("value")))
        .unionByName(rows("route", grids["route"], "epoch", c("j"), c("i"), c("value")))
    )


@query(with_views("wts rect full_basins links", f""", {KEPT},
    newlinks AS ({SUBSET}),
    outlets AS (
        SELECT NHDWaterbodyComID AS lake_id, min(link) AS link FROM links
        WHERE NHDWaterbodyComID > 0 AND link > 0 GROUP BY 1),
    up AS (
        SELECT lake_id, link FROM outlets
        UNION
        SELECT up.lake_id, l.link FROM links l JOIN up ON l."to" = up.link AND l.link <> l."to"),
    removed AS (
        SELECT DISTINCT lake_id FROM up
        WHERE link NOT IN (SELECT link FROM sub) AND lake_id IN (SELECT NHDWaterbodyComID FROM sub)),
    lakes AS (
        SELECT s_suppkey AS lake_id, CAST(floor(s_acctbal / 100) AS INTEGER) AS a FROM supplier
        WHERE s_suppkey IN (SELECT NHDWaterbodyComID FROM sub WHERE NHDWaterbodyComID > 0)
          AND s_suppkey NOT IN (SELECT lake_id FROM removed))
    SELECT 'links' AS part, link AS id, "to" AS a,
           CASE WHEN NHDWaterbodyComID IN (SELECT lake_id FROM removed) THEN -9999 ELSE NHDWaterbodyComID END AS b,
           ascendingIndex AS v
    FROM newlinks
    UNION ALL
    SELECT 'lakes', lake_id, -1, -1, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2e0 - 1 FROM lakes
    UNION ALL
    SELECT 'stations', vec_id, label, -1, embedding[1]::DOUBLE FROM embeddings
    WHERE CAST(vec_id AS VARCHAR) IN (SELECT trim(gages) FROM sub)""", recursive=True))
def static_job_network(spark: SparkSession, sf: str) -> DataFrame:
    """Links, lakes and stations of a domain cut to a box, as the static job writes them."""
    inputs = jobs.StaticInputs(
        weights=V.weights(spark, sf), polys=V.polys(spark, sf), links=V.links(spark, sf), lakes=V.lakes(spark, sf),
        lake_types=V.lake_types(spark, sf), stations=V.stations(spark, sf),
    )
    out = scratch_path(spark, "domain")
    write_tables(jobs.static_subset(inputs, BOUNDS, spark.createDataFrame([V.ENVELOPE])), out)

    def rows(name: str, ident: str, a, b, v) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}").select(
            F.lit(name).alias("part"), F.trim(F.col(ident).cast("string")).cast("bigint").alias("id"),
            a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), v.cast("double").alias("v"),
        )

    none = F.lit(-1)
    links = rows("links", "link", F.col("to"), F.col("NHDWaterbodyComID"), F.col("ascendingIndex"))
    return links.unionByName(rows("lakes", "lake_id", none, none, F.col("ascendingIndex"))).unionByName(
        rows("stations", "stationId", F.col("R"), none, F.col("G")))


DOMAIN = f"""chosen AS (
        SELECT * FROM vertices WHERE poly_id IN (
            SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 5000)),
    {V.SQL["edges"]},
    box AS (SELECT min(j) AS j0, max(j) AS j1, min(i) AS i0, max(i) AS i1 FROM covered),
    domain AS (
        SELECT 'basin' AS label, g.grid, g.grid AS var, c.time, c.j, c.i,
               CASE WHEN m.j IS NOT NULL THEN CASE g.grid WHEN 'slope' THEN value ELSE -value END END
                 AS value
        FROM cells c JOIN box ON c.j BETWEEN j0 AND j1 AND c.i BETWEEN i0 AND i1
        CROSS JOIN (VALUES ('slope'), ('soil')) AS g(grid)
        LEFT JOIN covered m ON m.j = c.j AND m.i = c.i)"""


def domain_grids(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    blocks = V.chunks(spark, sf)
    return {
        "slope": blocks.withColumn("var", F.lit("slope")),
        "soil": blocks.withColumn("var", F.lit("soil")).withColumn(
            "data", F.transform("data", lambda v: -v)
        ),
    }


def domain(spark: SparkSession, sf: str) -> DataFrame:
    grids = domain_grids(spark, sf)
    ids = V.table(spark, sf, "supplier").filter("s_acctbal > 5000").select(
        F.col("s_suppkey").cast("string").alias("poly_id")
    )
    out = jobs.domain_by_ids(grids, V.polygons(spark, sf), ids, grid(spark, sf), "basin")
    return out.withColumn("value", F.col("value").cast("double"))


@query(with_views("chunks cells vertices", f", {DOMAIN} SELECT * FROM domain"))
def polygon_id_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Two grids clipped to the polygons of an id list."""
    return domain(spark, sf)


@query(with_views("chunks cells vertices", f""", {DOMAIN}
    SELECT 'domain' AS dataset, var AS variable, count(value) AS n, min(value) AS value_min,
           max(value) AS value_max, min(j) AS j_min, max(j) AS j_max, min(i) AS i_min, max(i) AS i_max,
           min(time) AS time_first, max(time) AS time_last
    FROM domain GROUP BY var"""))
def domain_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The same domain described."""
    return jobs.domain_with_metadata(domain(spark, sf))[1]


def domain_from_files(spark: SparkSession, sf: str) -> tuple[RunLayout, DataFrame]:
    """The domain job from a boundary file and a file of records that lists ids."""
    _, boundary, land = store_and_boundary(spark, sf)
    records = scratch_path(spark, "records")
    listed = V.table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("s_suppkey").alias("ID")).alias("properties"))).alias("value"))
    listed.write.text(records)
    layout = RunLayout(scratch_path(spark, "runs"), "domain")
    return layout, jobs.run_domain_by_ids(
        spark, domain_grids(spark, sf), boundary, records, land, "basin", layout, ["slope", "soil"], "ID", lines=True)


@query(with_views("chunks cells vertices", f", {DOMAIN} SELECT * FROM domain"))
def domain_files_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Two grids clipped to listed polygons of a boundary file, as written."""
    layout, _ = domain_from_files(spark, sf)
    return spark.read.parquet(layout.domain).withColumn("value", F.col("value").cast("double"))


@query(with_views("chunks cells vertices", f""", {DOMAIN}
    SELECT 'domain' AS dataset, var AS variable, count(value) AS n, min(value) AS value_min,
           max(value) AS value_max, min(j) AS j_min, max(j) AS j_max, min(i) AS i_min, max(i) AS i_max,
           min(time) AS time_first, max(time) AS time_last
    FROM domain GROUP BY var"""))
def domain_files_described(spark: SparkSession, sf: str) -> DataFrame:
    """The same job's description, gathered while it was written."""
    return domain_from_files(spark, sf)[1]


CHAIN = with_views("hydro wts zones chunks cells", f""",
    edges AS (
        SELECT 'wb-' || n AS id, 'nex-' || below AS toid, vpu_id FROM base
        UNION
        SELECT 'nex-' || below, 'wb-' || below, substr(bin(below), 1, 3) FROM base WHERE below > 0),
    up AS (
        SELECT '{WB_ID}' AS id
        UNION
        SELECT e.id FROM edges e JOIN up ON e.toid = up.id WHERE vpu_id = '{VPU_ID}'),
    cats AS (SELECT n AS id, o_custkey FROM base WHERE vpu_id = '{VPU_ID}' AND 'wb-' || n IN (SELECT id FROM up)),
    steps AS (SELECT DISTINCT id, time, var FROM zones JOIN cells USING (j, i)
              WHERE time >= TIMESTAMP '2024-01-01 06:00:00'),
    spans AS (SELECT id, min(time) AS time_first, max(time) AS time_last, count(DISTINCT time) AS n_steps
              FROM steps GROUP BY id)
    SELECT c.id, o_custkey, time_first, time_last, coalesce(n_steps, 0) AS n_steps,
           'cat-' || c.id AS config_name
    FROM cats c LEFT JOIN spans s ON s.id = c.id""", recursive=True)


@query(CHAIN)
def chain_job(spark: SparkSession, sf: str) -> DataFrame:
    """Hydrofabric, forcing and configuration in one go."""
    layers, edges = V.hydrofabric(spark, sf)
    vpu = F.col("vpu_id") == VPU_ID
    config, _ = jobs.catchment_inputs(
        {name: df.filter(vpu) for name, df in layers.items()}, edges.filter(vpu), WB_ID,
        V.chunks(spark, sf), V.weights(spark, sf), V.BLOCK, "2024-01-01 06:00:00", "2024-01-01",
        ["o_custkey"],
    )
    return config


@query(CHAIN)
def chain_job_written(spark: SparkSession, sf: str) -> DataFrame:
    """The chain run step by step from stored layers, each step on what the one before wrote; the configuration as written."""
    layers, edges = V.hydrofabric(spark, sf)
    base = scratch_path(spark, "hydrofabric")
    for name, df in {"edges": edges, "catchments": layers["catchments"], "attributes": layers["attributes"]}.items():
        df.write.partitionBy("vpu_id").parquet(f"{base}/{name}")
    layout = RunLayout(scratch_path(spark, "runs"), "chain")
    jobs.run_chain(
        spark, base, VPU_ID, WB_ID, V.chunks(spark, sf), V.weights(spark, sf), V.BLOCK, "2024-01-01 06:00:00", "2024-01-01",
        layout,
    )
    columns = "id bigint, o_custkey bigint, time_first timestamp_ntz, time_last timestamp_ntz, n_steps bigint, config_name string"
    return spark.read.schema(columns).json(layout.config)
