"""Spatial clustering of features by Z-order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _spread_bits(value: Column) -> Column:
    """Put a zero bit between the bits of a 16-bit number."""
    for shift, mask in [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def zorder_key(
    x: Column, y: Column, extent: tuple[float, float, float, float]
) -> Column:
    """Z-order number of a point, on a 65536 by 65536 raster of ``(xmin, ymin, xmax, ymax)``."""
    xmin, ymin, xmax, ymax = extent

    def cell(v: Column, lo: float, hi: float) -> Column:
        scaled = F.floor((v - lo) / (hi - lo) * 65536.0).cast("bigint")
        return F.least(F.greatest(scaled, F.lit(0)), F.lit(65535)).cast("bigint")

    return _spread_bits(cell(x, xmin, xmax)).bitwiseOR(
        F.shiftleft(_spread_bits(cell(y, ymin, ymax)), 1)
    )


def with_zorder(features: DataFrame, extent: tuple[float, float, float, float]) -> DataFrame:
    """Add ``z`` of the centre of each feature's box ``(xmin, ymin, xmax, ymax)``."""
    cx = (F.col("xmin") + F.col("xmax")) / 2
    cy = (F.col("ymin") + F.col("ymax")) / 2
    return features.withColumn("z", zorder_key(cx, cy, extent))


def clustered(
    features: DataFrame, extent: tuple[float, float, float, float], tie_breaker: str
) -> DataFrame:
    """Features in Z-order over range partitions.

    The tie breaker takes part in the range split, so features piled on one point can be divided.
    """
    keyed = with_zorder(features, extent)
    return keyed.repartitionByRange("z", tie_breaker).sortWithinPartitions("z", tie_breaker)
