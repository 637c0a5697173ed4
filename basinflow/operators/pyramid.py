"""Tiled overview pyramids of a cell table.

Level 0 is full resolution; each level halves both axes. Cells are 0-based in the output:
``(…, level, tile_row, tile_col, row, col, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overview_levels(height: int, width: int, tile: int = 512) -> int:
    """Number of halvings until the whole grid fits into one tile."""
    levels = 0
    while max(height, width) > tile:
        height, width = -(-height // 2), -(-width // 2)
        levels += 1
    return levels


def grid_shape(cells: DataFrame) -> tuple[int, int]:
    """``(height, width)`` of a cell table (one aggregate row)."""
    e = cells.agg(F.max("j").alias("h"), F.max("i").alias("w")).first()
    return e.h or 0, e.w or 0


def decimated_shape(height: int, width: int, factor: int) -> tuple[int, int]:
    """Shape of a decimated read."""
    return height // factor, width // factor


def _tiled(level: DataFrame, keys: Sequence[str], tile: int) -> DataFrame:
    return level.select(
        *keys, "level",
        F.expr(f"row div {tile}").cast("int").alias("tile_row"),
        F.expr(f"col div {tile}").cast("int").alias("tile_col"),
        "row", "col", "value",
    )


def _zero_based(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.select(
        *keys, (F.col("j") - 1).alias("row"), (F.col("i") - 1).alias("col"), "value"
    )


def _nearest(cells: DataFrame, levels: int, keys: Sequence[str]) -> DataFrame:
    base = _zero_based(cells, keys)
    serves = F.array_compact(F.array(*[
        F.when((F.col("row") % 2**k == 0) & (F.col("col") % 2**k == 0), F.lit(k))
        for k in range(levels + 1)
    ]))
    flat = base.withColumn("level", F.explode(serves))
    scale = F.pow(F.lit(2.0), F.col("level")).cast("int")
    return flat.withColumns({
        "row": F.call_function("div", F.col("row"), scale).cast("int"),
        "col": F.call_function("div", F.col("col"), scale).cast("int"),
    })


def _mean(cells: DataFrame, levels: int, keys: Sequence[str]) -> DataFrame:
    part = _zero_based(cells, keys).select(
        *keys, "row", "col", F.col("value").cast("double").alias("total"),
        F.when(F.col("value").isNotNull(), 1).otherwise(0).cast("bigint").alias("n"),
    )
    out = None
    for k in range(levels + 1):
        if k:
            part = part.groupBy(
                *keys, F.expr("row div 2").cast("int").alias("row"),
                F.expr("col div 2").cast("int").alias("col"),
            ).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
        level = part.select(*keys, F.lit(k).alias("level"), "row", "col", mean.alias("value"))
        out = level if out is None else out.unionByName(level)
    return out


def build_pyramid(
    cells: DataFrame,
    levels: int,
    tile: int = 512,
    method: str = "nearest",
    keys: Sequence[str] = ("var", "time"),
) -> DataFrame:
    """All levels of the pyramid.

    ``nearest`` takes the north-west cell of each block: a cell serves level ``l`` when both indices
    are multiples of ``2^l``, so levels are unfolded in place without any shuffle. ``mean`` averages
    the cells of a block; sums and counts are carried up, each level from a quarter of the rows of
    the one before, and Spark reuses the lower level's shuffle.
    """
    if method == "nearest":
        return _tiled(_nearest(cells, levels, keys), keys, tile)
    if method == "mean":
        return _tiled(_mean(cells, levels, keys), keys, tile)
    raise ValueError(f"unknown resampling method {method}")


def read_overview(tiles: DataFrame, level: int | None = None) -> DataFrame:
    """One level of a pyramid, by default the smallest."""
    if level is not None:
        return tiles.filter(F.col("level") == level)
    return tiles.filter(F.col("level") == tiles.agg(F.max("level").alias("m")).scalar())
