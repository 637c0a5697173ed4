"""Sparse grid-to-basin weights: which basins lie inside a rectangle, and their weights there.

``weights(i_index, j_index, IDmask, weight, regridweight)`` has one row per routing cell and basin;
``polys(polyid, overlaps)`` counts the cells of each basin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.functions.gridindex import IndexBounds

# Fixed value: a basin is whole when more than this share of its weight is inside.
FULL_BASIN = 0.999


def in_rectangle(bounds: IndexBounds) -> Column:
    """Weight rows inside an index rectangle."""
    return F.col("i_index").between(bounds.imin, bounds.imax) & F.col("j_index").between(
        bounds.jmin, bounds.jmax
    )


def basin_sums(weights: DataFrame, bounds: IndexBounds) -> DataFrame:
    """Weight and number of cells of each basin inside the rectangle."""
    return weights.filter(in_rectangle(bounds)).groupBy("IDmask").agg(
        F.sum("weight").alias("sum_weight"), F.count("*").alias("overlaps")
    )


def full_basins(weights: DataFrame, bounds: IndexBounds, threshold: float = FULL_BASIN) -> DataFrame:
    """Basins whose weight inside the rectangle is above ``threshold``."""
    return basin_sums(weights, bounds).filter(F.col("sum_weight") > threshold)


def subset_weights(
    weights: DataFrame, polys: DataFrame, keep: DataFrame, bounds: IndexBounds
) -> tuple[DataFrame, DataFrame]:
    """Weights and polys of the kept basins, cut to the rectangle.

    ``keep(IDmask)`` lists the basins; when it is the result of ``full_basins`` for the same
    rectangle, the sums it carries are used instead of being calculated again. Indices restart at 1, weights are divided by their basin's
    sum inside the rectangle (``regridweight`` is not), ``overlaps`` is counted again and is 0 for a
    kept basin without cells inside.

    Sums are aggregated before the rows are joined back, so a basin owning most rows reaches the
    join as one summed row, and its rows stay splittable.
    """
    if {"sum_weight", "overlaps"} <= set(keep.columns):
        kept, sums = keep.select("IDmask"), keep
    else:
        kept = keep.select("IDmask").distinct()
        sums = basin_sums(weights, bounds).join(kept, "IDmask", "left_semi")
    rows = (
        weights.filter(in_rectangle(bounds))
        .join(sums.select("IDmask", "sum_weight"), "IDmask")
        .select(
            (F.col("i_index") - (bounds.imin - 1)).alias("i_index"),
            (F.col("j_index") - (bounds.jmin - 1)).alias("j_index"),
            "IDmask",
            (F.col("weight") / F.col("sum_weight")).alias("weight"),
            "regridweight",
        )
    )
    counted = sums.select(F.col("IDmask").alias("polyid"), "overlaps")
    poly_rows = (
        polys.drop("overlaps")
        .join(kept.withColumnRenamed("IDmask", "polyid"), "polyid", "left_semi")
        .join(counted, "polyid", "left")
        .withColumn("overlaps", F.coalesce("overlaps", F.lit(0)).cast("bigint"))
    )
    return rows, poly_rows
