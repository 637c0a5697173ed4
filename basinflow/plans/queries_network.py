"""Queries on the river network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.operators import boxes, closure, network
from basinflow.operators.weights import full_basins
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.views import with_views

IN_BOX = "lon BETWEEN -115 AND -90 AND lat BETWEEN 30 AND 42"
KEPT = f"""kept AS (
        SELECT IDmask AS link FROM full_basins UNION SELECT link FROM links WHERE {IN_BOX}),
    sub AS (SELECT * FROM links WHERE link IN (SELECT link FROM kept))"""
SUBSET = """SELECT link, CASE WHEN "to" IN (SELECT link FROM sub) THEN "to" ELSE 0 END AS "to", lon, lat,
           trim(gages) AS gages, NHDWaterbodyComID,
           rank() OVER (ORDER BY ascendingIndex)
             + (count(*) OVER (PARTITION BY ascendingIndex) - 1) / 2e0 - 1 AS ascendingIndex
    FROM sub"""


@query(with_views("links", f"SELECT DISTINCT link FROM links WHERE {IN_BOX}"))
def links_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Links inside the envelope."""
    envelope = spark.createDataFrame([V.ENVELOPE])
    return network.links_in_envelope(V.links(spark, sf), envelope)


def kept(spark: SparkSession, sf: str) -> DataFrame:
    basins = full_basins(V.weights(spark, sf), V.RECT)
    return network.kept_ids(basins, links_envelope(spark, sf))


@query(with_views("wts rect full_basins links", f", {KEPT} {SUBSET}"))
def links_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Links of whole basins or inside the envelope, ends cut, order re-ranked."""
    sub = network.subset_links(V.links(spark, sf), kept(spark, sf))
    return sub.withColumn("gages", F.trim("gages"))


# every supplier stands at a link
STARTS = "SELECT s_suppkey + 50 FROM supplier"
CLOSURE = f"""up AS (
        SELECT link FROM links WHERE link IN ({STARTS})
        UNION
        SELECT l.link FROM links l JOIN up ON l."to" = up.link AND l.link <> l."to")"""


def starts(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "supplier").select((F.col("s_suppkey") + 50).alias("link"))


@query(with_views("links", f", {CLOSURE} SELECT link FROM up", recursive=True))
def upstream(spark: SparkSession, sf: str) -> DataFrame:
    """All links draining to the start links."""
    return closure.upstream(V.links(spark, sf), starts(spark, sf))


@query(with_views("links", f""",
    up AS (
        SELECT link, link AS first_start FROM links WHERE link IN ({STARTS})
        UNION
        SELECT l.link, up.first_start FROM links l JOIN up ON l."to" = up.link
        WHERE l.link <> l."to" AND l.link NOT IN ({STARTS}))
    SELECT link, first_start FROM up""", recursive=True))
def first_start(spark: SparkSession, sf: str) -> DataFrame:
    """The first start link below every link."""
    return closure.first_start_below(V.links(spark, sf), starts(spark, sf))


@query(with_views("links", f", {CLOSURE} SELECT link FROM up", recursive=True))
def upstream_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The same level by level, for networks where flow divides."""
    edges = V.links(spark, sf).select("link", "to")
    return closure.upstream_any(edges, starts(spark, sf))


# every fifth link drains to a second one, every seventh to a third
DIVIDED = """divided AS (
        SELECT link, "to" FROM links WHERE link <> "to"
        UNION SELECT link, link // 3 FROM links WHERE link % 5 = 0 AND link > 3
        UNION SELECT link, link // 2 + 1 FROM links WHERE link % 7 = 0 AND link > 7)"""


def divided(spark: SparkSession, sf: str) -> DataFrame:
    """The links with further ways down for some of them."""
    links = V.links(spark, sf).select("link", "to")
    second = links.filter("link % 5 = 0 AND link > 3").select("link", V.div(F.col("link"), 3).alias("to"))
    third = links.filter("link % 7 = 0 AND link > 7").select("link", (V.div(F.col("link"), 2) + 1).alias("to"))
    return links.filter("link <> to").union(second).union(third)


@query(with_views("links", f""", {DIVIDED},
    up AS (
        SELECT s_suppkey + 50 AS link FROM supplier
        UNION SELECT d.link FROM divided d JOIN up ON d."to" = up.link)
    SELECT link FROM up""", recursive=True))
def upstream_dividing(spark: SparkSession, sf: str) -> DataFrame:
    """All links draining to the start links where flow divides."""
    return closure.upstream(divided(spark, sf), starts(spark, sf))


@query(with_views("links", f""", {DIVIDED},
    down AS (
        SELECT link FROM links WHERE link % 97 = 5
        UNION SELECT d."to" FROM divided d JOIN down ON d.link = down.link)
    SELECT link FROM down WHERE link IN (SELECT link FROM divided)""", recursive=True))
def downstream_dividing(spark: SparkSession, sf: str) -> DataFrame:
    """All links on the ways down from some links where flow divides."""
    network = divided(spark, sf)
    return closure.downstream(network, V.links(spark, sf).filter("link % 97 = 5").select("link"))


ENVELOPES = """boxes AS (
        SELECT s_suppkey AS box, -120e0 + s_suppkey * 7 % 45 AS lon_min,
               -120e0 + s_suppkey * 7 % 45 + CASE WHEN s_suppkey % 10 = 0 THEN 30e0 ELSE 0.9e0 END AS lon_max,
               25e0 + s_suppkey * 3 % 23 AS lat_min,
               25e0 + s_suppkey * 3 % 23 + CASE WHEN s_suppkey % 10 = 0 THEN 12e0 ELSE 0.6e0 END AS lat_max
        FROM supplier)"""


@query(with_views("links", f""", {ENVELOPES}
    SELECT DISTINCT box, link FROM links JOIN boxes
      ON lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max"""))
def boxes_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links inside each of many envelopes, small ones and large ones."""
    k = F.col("s_suppkey")
    lon, lat = F.lit(-120.0) + k * 7 % 45, F.lit(25.0) + k * 3 % 23
    envelopes = V.table(spark, sf, "supplier").select(
        k.alias("box"), lon.alias("lon_min"), (lon + F.when(k % 10 == 0, 30.0).otherwise(0.9)).alias("lon_max"),
        lat.alias("lat_min"), (lat + F.when(k % 10 == 0, 12.0).otherwise(0.6)).alias("lat_max"),
    )
    return boxes.links_in_envelopes(V.links(spark, sf), envelopes)


WB_ID, VPU_ID = "wb-9", "100"
HYDRO = with_views("hydro", f""",
    edges AS (
        SELECT 'wb-' || n AS id, 'nex-' || below AS toid, vpu_id FROM base
        UNION
        SELECT 'nex-' || below, 'wb-' || below, substr(bin(below), 1, 3) FROM base WHERE below > 0),
    up AS (
        SELECT '{WB_ID}' AS id
        UNION
        SELECT e.id FROM edges e JOIN up ON e.toid = up.id WHERE vpu_id = '{VPU_ID}')
    SELECT 'flowpaths' AS layer, id, toid AS ref FROM edges
    WHERE vpu_id = '{VPU_ID}' AND id LIKE 'wb-%' AND id IN (SELECT id FROM up)
    UNION ALL
    SELECT 'nexus', id, toid FROM edges
    WHERE vpu_id = '{VPU_ID}' AND id LIKE 'nex-%' AND id IN (SELECT id FROM up)
    UNION ALL
    SELECT 'catchments', 'cat-' || n, 'wb-' || n FROM base
    WHERE vpu_id = '{VPU_ID}' AND 'wb-' || n IN (SELECT id FROM up)
    UNION ALL
    SELECT 'attributes', 'cat-' || n, CAST(o_custkey AS VARCHAR) FROM base
    WHERE vpu_id = '{VPU_ID}' AND 'wb-' || n IN (SELECT id FROM up)
    UNION ALL
    SELECT 'crosswalk', 'wb-' || n, CAST(o_custkey AS VARCHAR) FROM base
    WHERE vpu_id = '{VPU_ID}' AND 'wb-' || n IN (SELECT id FROM up)""", recursive=True)


@query(HYDRO)
def hydrofabric_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Every hydrofabric layer above one flowpath."""
    layers, edges = V.hydrofabric(spark, sf)
    in_vpu = {name: df.filter(F.col("vpu_id") == VPU_ID) for name, df in layers.items()}
    parts = network.subset_hydrofabric(in_vpu, edges.filter(F.col("vpu_id") == VPU_ID), WB_ID)
    second = {"flowpaths": "toid", "nexus": "toid", "catchments": "id",
              "attributes": "o_custkey", "crosswalk": "comid"}
    out = None
    for name, ref in second.items():
        part = parts[name]
        key = "divide_id" if "divide_id" in part.columns else "id"
        rows = part.select(
            F.lit(name).alias("layer"), F.col(key).alias("id"),
            F.col(ref).cast("string").alias("ref"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


LAKES = """sub AS (SELECT * FROM links WHERE lat < 49.5),
    outlets AS (
        SELECT NHDWaterbodyComID AS lake_id, min(link) AS link FROM links
        WHERE NHDWaterbodyComID > 0 AND link > 0 GROUP BY 1),
    up AS (
        SELECT lake_id, link FROM outlets
        UNION
        SELECT up.lake_id, l.link FROM links l JOIN up ON l."to" = up.link AND l.link <> l."to"),
    removed AS (
        SELECT DISTINCT lake_id FROM up
        WHERE link NOT IN (SELECT link FROM sub)
          AND lake_id IN (SELECT NHDWaterbodyComID FROM sub))"""


def removed_lakes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``(kept links, removed lakes)``."""
    full = V.links(spark, sf)
    sub = full.filter("lat < 49.5")
    outlets = network.lake_outlets(full, V.lake_types(spark, sf))
    return sub, network.lakes_to_remove(sub, full, outlets)


@query(with_views("links", f""", {LAKES},
    kept AS (
        SELECT s_suppkey AS lake_id, CAST(floor(s_acctbal / 100) AS INTEGER) AS a FROM supplier
        WHERE s_suppkey IN (SELECT NHDWaterbodyComID FROM sub WHERE NHDWaterbodyComID > 0)
          AND s_suppkey NOT IN (SELECT lake_id FROM removed))
    SELECT lake_id, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2e0 - 1
             AS ascendingIndex
    FROM kept""", recursive=True))
def lake_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Lakes whose whole drainage area is kept."""
    sub, removed = removed_lakes(spark, sf)
    return network.keep_lakes(V.lakes(spark, sf), sub, removed)


@query(with_views("links", f""", {LAKES}
    SELECT link, "to", CASE WHEN NHDWaterbodyComID IN (SELECT lake_id FROM removed) THEN -9999
                            ELSE NHDWaterbodyComID END AS NHDWaterbodyComID
    FROM sub""", recursive=True))
def lake_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links with the removed lakes marked."""
    sub, removed = removed_lakes(spark, sf)
    return network.mark_removed_lakes(sub, removed).select("link", "to", "NHDWaterbodyComID")


@query(with_views("links", """,
    st AS (
        SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings)
    SELECT CAST(vec_id AS VARCHAR) AS stationId, CAST(label AS DOUBLE) AS R, e[1] AS G, e[2] AS tau, k,
           e[k] AS qThresh, e[12 + k] AS expCoeff1, e[48 + k] AS expCoeff4
    FROM st, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS k)
    WHERE CAST(vec_id AS VARCHAR) IN (SELECT trim(gages) FROM links WHERE lat < 49.5)"""))
def station_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Stations on kept links, with their parameter arrays unfolded."""
    kept_links = V.links(spark, sf).filter("lat < 49.5")
    kept_stations = network.subset_stations(V.stations(spark, sf), kept_links)
    flat = kept_stations.select(
        F.trim("stationId").alias("stationId"), "R", "G", "tau", "expCoeff",
        F.posexplode("qThresh").alias("_p", "qThresh"),
    )
    k = F.col("_p") + 1
    return flat.select(
        "stationId", "R", "G", "tau", k.alias("k"), "qThresh",
        F.element_at(F.element_at("expCoeff", 1), k).alias("expCoeff1"),
        F.element_at(F.element_at("expCoeff", 4), k).alias("expCoeff4"),
    )
