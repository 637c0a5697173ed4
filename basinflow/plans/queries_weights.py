"""Queries on basins, weights and zones."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.operators import boxes as B
from basinflow.operators import weights as W
from basinflow.operators.catchments import configure_catchments
from basinflow.operators.network import subset_buckets
from basinflow.operators.zonal import zonal_mean, zonal_mean_chunks, zonal_mean_placed, zone_weights
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.views import with_views
from basinflow.session import scratch_path
from basinflow.sources import layout


@query(with_views("wts rect full_basins", """
    SELECT IDmask, round(sum(weight), 6) AS sum_weight, count(*) AS overlaps
    FROM rect WHERE IDmask IN (SELECT IDmask FROM full_basins) GROUP BY IDmask"""))
def basins_full(spark: SparkSession, sf: str) -> DataFrame:
    """Basins lying wholly inside the rectangle."""
    full = W.full_basins(V.weights(spark, sf), V.RECT)
    return full.withColumn("sum_weight", F.round("sum_weight", 6))


@query(with_views("wts rect full_basins", """
    SELECT i_index - 10 AS i_index, j_index - 1 AS j_index, IDmask,
           round(weight / sum(weight) OVER (PARTITION BY IDmask), 9) AS weight, regridweight
    FROM rect WHERE IDmask IN (SELECT IDmask FROM full_basins)"""))
def weights_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of whole basins, re-indexed and renormalised."""
    wts = V.weights(spark, sf)
    rows, _ = W.subset_weights(wts, V.polys(spark, sf), W.full_basins(wts, V.RECT), V.RECT)
    return rows.withColumn("weight", F.round("weight", 9))


@query(with_views("wts rect full_basins", """
    SELECT p_partkey AS polyid, count(r.IDmask) AS overlaps
    FROM part LEFT JOIN rect r ON r.IDmask = p_partkey GROUP BY p_partkey"""))
def weights_polys(spark: SparkSession, sf: str) -> DataFrame:
    """Cell counts of all basins; a basin with no cell inside counts 0."""
    keep = V.table(spark, sf, "part").select(F.col("p_partkey").alias("IDmask"))
    _, polys = W.subset_weights(V.weights(spark, sf), V.polys(spark, sf), keep, V.RECT)
    return polys


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A rectangle of the weights' index space per supplier; every tenth is large."""
    k = F.col("s_suppkey")
    wide, high = F.when(k % 10 == 0, 55).otherwise(15 + k % 9), F.when(k % 10 == 0, 20).otherwise(6 + k % 4)
    i, j = (k * 11 % 70 + 1).cast("int"), (k * 5 % 20 + 1).cast("int")
    return V.table(spark, sf, "supplier").select(
        k.alias("box"), i.alias("imin"), (i + wide).cast("int").alias("imax"),
        j.alias("jmin"), (j + high).cast("int").alias("jmax"),
    )


@query(with_views("wts", """
    , boxes AS (
        SELECT box, imin, imin + CASE WHEN box % 10 = 0 THEN 55 ELSE 15 + box % 9 END AS imax,
               jmin, jmin + CASE WHEN box % 10 = 0 THEN 20 ELSE 6 + box % 4 END AS jmax
        FROM (SELECT s_suppkey AS box, s_suppkey * 11 % 70 + 1 AS imin, s_suppkey * 5 % 20 + 1 AS jmin FROM supplier)),
    hit AS (SELECT * FROM wts JOIN boxes ON i_index BETWEEN imin AND imax AND j_index BETWEEN jmin AND jmax),
    whole AS (SELECT box, IDmask, sum(weight) AS s FROM hit GROUP BY box, IDmask HAVING sum(weight) > 0.999)
    SELECT box, i_index - (imin - 1) AS i_index, j_index - (jmin - 1) AS j_index, IDmask,
           round(weight / s, 9) AS weight, regridweight
    FROM hit JOIN whole USING (box, IDmask)"""))
def boxes_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of whole basins of many rectangles in one pass, re-indexed and renormalised in each."""
    wts, many = V.weights(spark, sf), boxes(spark, sf)
    rows = B.subset_weights_of_boxes(wts, many, B.full_basins_of_boxes(wts, many))
    return rows.withColumn("weight", F.round("weight", 9))


@query(with_views("wts rect full_basins", """
    SELECT c_custkey AS ComID, row_number() OVER (ORDER BY c_custkey) AS Basin, c_custkey AS ind,
           c_acctbal
    FROM customer WHERE c_custkey IN (SELECT IDmask FROM full_basins)"""))
def buckets_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Buckets of whole basins, numbered in file order."""
    basins = W.full_basins(V.weights(spark, sf), V.RECT)
    return subset_buckets(V.buckets(spark, sf), basins)


ZONAL = with_views("wts zones chunks cells", """
    SELECT id, time, var, round(sum(w * value) / sum(w), 6) AS mean, count(*) AS n_cells
    FROM zones JOIN cells USING (j, i) GROUP BY id, time, var""")


@query(ZONAL)
def zonal_means(spark: SparkSession, sf: str) -> DataFrame:
    """Basin means of the forcing, straight from stored blocks."""
    zones = zone_weights(V.weights(spark, sf))
    means = zonal_mean_chunks(V.chunks(spark, sf), zones, V.BLOCK)
    return means.withColumn("mean", F.round("mean", 6))


@query(with_views("wts zones chunks cells", """
    SELECT id, time, var, round(sum(w * value) / sum(w), 6) AS mean, count(*) AS n_cells
    FROM zones JOIN cells USING (j, i)
    WHERE time BETWEEN TIMESTAMP '2024-01-01 04:00:00' AND TIMESTAMP '2024-01-01 17:00:00'
    GROUP BY id, time, var"""))
def zonal_means_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Basin means of a period from blocks, stored in two parts, and weights that lie by block origin."""
    folder = scratch_path(spark, "layout")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    noon = V.ntz(V.BASE_TIME + timedelta(hours=12))
    blocks = V.chunks(spark, sf)
    layout.store_zones(zone_weights(V.weights(spark, sf)), V.BLOCK, name, folder, 8)
    for part in (blocks.filter(F.col("time") < noon), blocks.filter(F.col("time") >= noon)):
        layout.add_blocks(part, name, folder, 8)
    period = layout.stored_period(spark, name, *(V.BASE_TIME + timedelta(hours=h) for h in (4, 17)))
    return zonal_mean_placed(*period).withColumn("mean", F.round("mean", 6))


@query(ZONAL)
def zonal_means_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a cell table."""
    from basinflow.operators.cells import explode_cells

    zones = zone_weights(V.weights(spark, sf))
    means = zonal_mean(explode_cells(V.chunks(spark, sf)), zones)
    return means.withColumn("mean", F.round("mean", 6))


@query(with_views("wts rect full_basins zones chunks cells", """
    , means AS (
        SELECT id, time, var FROM zones JOIN cells USING (j, i) GROUP BY id, time, var),
    spans AS (
        SELECT id, min(time) AS time_first, max(time) AS time_last, count(DISTINCT time) AS n_steps
        FROM means GROUP BY id)
    SELECT f.IDmask AS id, p_brand AS brand, p_size AS size, time_first, time_last,
           coalesce(n_steps, 0) AS n_steps, 'cat-' || f.IDmask AS config_name
    FROM full_basins f LEFT JOIN part ON p_partkey = f.IDmask LEFT JOIN spans s ON s.id = f.IDmask"""))
def catchment_config(spark: SparkSession, sf: str) -> DataFrame:
    """Configuration rows of whole basins."""
    wts = V.weights(spark, sf)
    catchments = W.full_basins(wts, V.RECT).select(F.col("IDmask").alias("id"))
    attributes = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )
    zones = zone_weights(wts).join(catchments, "id", "left_semi")
    forcing = zonal_mean_chunks(V.chunks(spark, sf), zones, V.BLOCK)
    config, _ = configure_catchments(catchments, attributes, forcing)
    return config


@query(with_views("wts rect full_basins zones chunks cells", """
    SELECT id, time, var, round(sum(w * value) / sum(w), 6) AS mean, count(*) AS n_cells
    FROM zones JOIN cells USING (j, i)
    WHERE id IN (SELECT IDmask FROM full_basins) GROUP BY id, time, var"""))
def catchment_forcing(spark: SparkSession, sf: str) -> DataFrame:
    """Forcing of the configured catchments."""
    wts = V.weights(spark, sf)
    catchments = W.full_basins(wts, V.RECT).select(F.col("IDmask").alias("id"))
    zones = zone_weights(wts).join(catchments, "id", "left_semi")
    forcing = zonal_mean_chunks(V.chunks(spark, sf), zones, V.BLOCK)
    return forcing.withColumn("mean", F.round("mean", 6))
