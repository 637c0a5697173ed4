"""Subsets of river-network tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.operators.closure import downstream, upstream
from basinflow.operators.ordering import average_rank, sequential_id
from basinflow.session import cut

# Fixed values: ``to`` of a link that leaves the subset, and the lake id of a link whose lake went.
NO_LINK = 0
REMOVED_LAKE = -9999


def in_envelope(lon_min: float, lon_max: float, lat_min: float, lat_max: float) -> Column:
    return F.col("lon").between(lon_min, lon_max) & F.col("lat").between(lat_min, lat_max)


def links_in_envelope(links: DataFrame, envelope: DataFrame) -> DataFrame:
    """Distinct ids of links inside a one-row lon/lat envelope (as from ``buffered_envelope``)."""
    e = envelope.limit(2).collect()
    if len(e) != 1:
        raise ValueError("expected a single envelope")
    box = in_envelope(e[0].lon_min, e[0].lon_max, e[0].lat_min, e[0].lat_max)
    return links.filter(box).select("link").distinct()


def kept_ids(basins: DataFrame, link_ids: DataFrame) -> DataFrame:
    """Distinct ids of kept basins and kept links together, as ``(link)``."""
    return basins.select(F.col("IDmask").alias("link")).union(link_ids.select("link")).distinct()


def cut_dangling(links: DataFrame) -> DataFrame:
    """Set ``to`` to 0 where it is not itself a link of the table.

    Rows that already end there need no partner. They carry a spread-out second key, so however many
    there are they do not meet in one task.
    """
    present = links.select(F.col("link").alias("to"), F.lit(0).alias("_k")).distinct()
    ends = F.col("to").isNull() | (F.col("to") == NO_LINK)
    spread = F.when(ends, F.pmod(F.xxhash64("link"), F.lit(1024)) + 1).otherwise(0)
    keyed = links.withColumn("_k", spread.cast("int"))
    found = keyed.join(present.withColumn("_found", F.lit(True)), ["to", "_k"], "left")
    kept = F.when(F.col("_found"), F.col("to")).otherwise(F.lit(NO_LINK).cast("bigint"))
    return found.withColumn("to", kept).select(*links.columns)


def _rerank(df: DataFrame) -> DataFrame:
    # the subset is read several times below: counted, ordered, joined
    ranked = average_rank(cut(df, "ranked"), "ascendingIndex", "_rank")
    return ranked.drop("ascendingIndex").withColumnRenamed("_rank", "ascendingIndex")


def subset_links(links: DataFrame, keep: DataFrame) -> DataFrame:
    """Links whose id is in ``keep(link)``, with dangling ends cut and the order index re-ranked."""
    sub = cut_dangling(links.join(keep.select("link").distinct(), "link", "left_semi"))
    if "ascendingIndex" not in sub.columns:
        return sub
    return _rerank(sub)


def subset_buckets(
    buckets: DataFrame, basins: DataFrame, order_by: str = "ind"
) -> DataFrame:
    """Buckets of kept basins, numbered ``1..n`` in file order (the unique column ``order_by``)."""
    ids = basins.select(F.col("IDmask").alias("ComID")).distinct()
    sub = buckets.drop("Basin").join(ids, "ComID", "left_semi")
    return sequential_id(cut(sub, "buckets"), order_by, "Basin")


def lake_outlets(full_links: DataFrame, lake_types: DataFrame) -> DataFrame:
    """``(lake_id, link)`` of the links that let a lake out (type 1)."""
    types = lake_types.withColumnRenamed("LINKID", "link")
    typed = full_links.select("link", "NHDWaterbodyComID").join(types, "link", "left")
    return typed.filter("NHDWaterbodyComID > 0 AND TYPEL = 1").select(
        F.col("NHDWaterbodyComID").alias("lake_id"), "link"
    )


def lakes_to_remove(links: DataFrame, full_links: DataFrame, outlets: DataFrame) -> DataFrame:
    """Lakes of the subset with a link above their outlet that is not in the subset.

    Asked the other way round: which outlets lie below a link that is missing? One walk down from
    all missing links answers this for every lake at once, without listing the links of each lake.
    """
    missing = full_links.select("link").join(links.select("link"), "link", "left_anti")
    below = downstream(full_links, missing)
    present = links.filter("NHDWaterbodyComID > 0").select(
        F.col("NHDWaterbodyComID").alias("lake_id")
    ).distinct()
    broken = outlets.join(below, "link", "left_semi").select("lake_id").distinct()
    return broken.join(present, "lake_id", "left_semi")


def keep_lakes(lakes: DataFrame, links: DataFrame, removed: DataFrame) -> DataFrame:
    """Lakes of the subset's links but for the removed ones, order index re-ranked."""
    present = links.filter("NHDWaterbodyComID > 0").select(
        F.col("NHDWaterbodyComID").alias("lake_id")
    ).distinct()
    kept = lakes.join(present, "lake_id", "left_semi").join(removed, "lake_id", "left_anti")
    if "ascendingIndex" in kept.columns:
        kept = _rerank(kept)
    return kept


def mark_removed_lakes(links: DataFrame, removed: DataFrame) -> DataFrame:
    """Give links of removed lakes the lake id -9999.

    Most links belong to no lake. They cannot match and do not take part in the join.
    """
    in_lake = F.coalesce(F.col("NHDWaterbodyComID") > 0, F.lit(False))
    others = links.filter(~in_lake)
    links = links.filter(in_lake)
    gone = removed.select(F.col("lake_id").alias("NHDWaterbodyComID"), F.lit(True).alias("_gone"))
    marked = links.join(gone, "NHDWaterbodyComID", "left").withColumn(
        "NHDWaterbodyComID",
        F.when(F.col("_gone"), F.lit(REMOVED_LAKE).cast("bigint")).otherwise(
            F.col("NHDWaterbodyComID")
        ),
    )
    return marked.select(*links.columns).unionByName(others)


def retain_lakes(
    lakes: DataFrame,
    lake_types: DataFrame,
    links: DataFrame,
    full_links: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Lakes whose whole drainage area is in the subset, and the links without the other lakes.

    A lake without outlet is kept.
    """
    outlets = lake_outlets(full_links, lake_types)
    removed = cut(lakes_to_remove(links, full_links, outlets), "lakes")
    return keep_lakes(lakes, links, removed), mark_removed_lakes(links, removed)


def subset_stations(stations: DataFrame, links: DataFrame) -> DataFrame:
    """Stations gauging a kept link; their 1-, 2- and 3-D parameters travel in the row."""
    gauges = links.select(F.trim("gages").alias("_site")).filter("_site <> ''").distinct()
    return stations.join(gauges, F.trim("stationId") == F.col("_site"), "left_semi")


def subset_hydrofabric(
    layers: Mapping[str, DataFrame], edges: DataFrame, wb_id: str
) -> dict[str, DataFrame]:
    """Every layer cut to what drains to ``wb_id``.

    ``edges(id, toid)`` links flowpaths and nexuses. Layers join on ``id``, or on ``divide_id`` for
    tables keyed by catchment, whose number is that of its flowpath.
    """
    start = edges.sparkSession.createDataFrame([(wb_id,)], "link STRING")
    pointers = edges.select(F.col("id").alias("link"), F.col("toid").alias("to"))
    ids = upstream(pointers, start).withColumnRenamed("link", "id")
    catchments = ids.filter(F.col("id").startswith("wb-")).select(
        F.regexp_replace("id", "^wb-", "cat-").alias("divide_id")
    )
    out = {}
    for name, layer in layers.items():
        if "divide_id" in layer.columns:
            out[name] = layer.join(catchments, "divide_id", "left_semi")
        else:
            out[name] = layer.join(ids, "id", "left_semi")
    return out

