"""Weighted means of gridded values per zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.operators.joins import lookup_join
from basinflow.session import cut


def zone_weights(weights: DataFrame) -> DataFrame:
    """``(id, j, i, w)`` with one row per zone and cell."""
    return weights.groupBy(
        F.col("IDmask").alias("id"), F.col("j_index").cast("int").alias("j"),
        F.col("i_index").cast("int").alias("i"),
    ).agg(F.sum("weight").alias("w"))


def _mean(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    # cells without a value take no part in either sum
    return (
        pairs.filter(F.col("value").isNotNull())
        .groupBy(*by)
        .agg(
            (F.sum(F.col("w") * F.col("value").cast("double")) / F.sum("w")).alias("mean"),
            F.count("*").alias("n_cells"),
        )
    )


def zonal_mean(
    cells: DataFrame, zones: DataFrame, by: Sequence[str] = ("id", "time", "var")
) -> DataFrame:
    """Mean of cell values weighted by ``zones(id, j, i, w)``."""
    zones = cut(zones, "zones")
    return _mean(lookup_join(cells, zones, ["j", "i"]), by)


def zonal_mean_chunks(
    chunks: DataFrame,
    zones: DataFrame,
    chunk_shape: tuple[int, int],
    by: Sequence[str] = ("id", "time", "var"),
) -> DataFrame:
    """The same straight from stored blocks on a regular ``(ny, nx)`` block grid.

    Weights meet blocks on the block origin and pick their value out of the array, so cells outside
    all zones are never unfolded and blocks outside are dropped by the join. The placed weights are
    written once, then counted and joined.
    """
    placed = cut(place_zones(zones, chunk_shape), "zones")
    hit = lookup_join(chunks, placed, ["y0", "x0"], "inner", F.expr(_INSIDE))
    return _mean(hit.withColumn("value", _value()), by)


def place_zones(zones: DataFrame, chunk_shape: tuple[int, int]) -> DataFrame:
    """Weights by the origin of their block and their place in it: ``id, w, y0, x0, _dj, _di``."""
    ny, nx = chunk_shape
    return zones.select(
        "id", "w",
        (F.expr(f"(j - 1) div {ny}") * ny + 1).cast("int").alias("y0"),
        (F.expr(f"(i - 1) div {nx}") * nx + 1).cast("int").alias("x0"),
        F.expr(f"(j - 1) % {ny}").alias("_dj"), F.expr(f"(i - 1) % {nx}").alias("_di"),
    )


# Whether a weight's cell lies in a block, which may be smaller at the grid's edge.
_INSIDE = "_dj < ny AND _di < nx"


def _value() -> Column:
    return F.element_at("data", F.col("_dj") * F.col("nx") + F.col("_di") + 1)


def zonal_mean_placed(
    chunks: DataFrame, placed: DataFrame, by: Sequence[str] = ("id", "time", "var")
) -> DataFrame:
    """The same from blocks and placed weights that are stored by block origin: they are merged where they lie."""
    hit = chunks.hint("merge").join(placed, ["y0", "x0"]).filter(_INSIDE)
    return _mean(hit.withColumn("value", _value()), by)
