"""Map projections as Column expressions.

Lambert conformal conic on a sphere with two standard parallels, after Snyder, "Map Projections: A
Working Manual" (USGS Professional Paper 1395). Longitude and latitude are taken over unchanged
between the sphere, WGS84 and NAD83: no datum shift is applied.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LambertConformal:
    """A spherical Lambert conformal conic system (degrees, metres)."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    radius: float

    @property
    def cone(self) -> float:
        p1, p2 = math.radians(self.lat_1), math.radians(self.lat_2)
        if math.isclose(p1, p2):
            return math.sin(p1)
        growth = math.tan(math.pi / 4 + p2 / 2) / math.tan(math.pi / 4 + p1 / 2)
        return math.log(math.cos(p1) / math.cos(p2)) / math.log(growth)

    @property
    def scale(self) -> float:
        """Radius times the projection constant F."""
        p1 = math.radians(self.lat_1)
        return self.radius * math.cos(p1) * math.tan(math.pi / 4 + p1 / 2) ** self.cone / self.cone

    @property
    def rho_0(self) -> float:
        return self.scale / math.tan(math.pi / 4 + math.radians(self.lat_0) / 2) ** self.cone


# The national land and routing grids share this system.
NWM_LCC = LambertConformal(
    lat_1=30.0, lat_2=60.0, lat_0=40.0000076293945, lon_0=-97.0, radius=6370000.0
)


def lcc_forward(lon: Column, lat: Column, crs: LambertConformal = NWM_LCC) -> tuple[Column, Column]:
    """Degrees to metres."""
    rho = F.lit(crs.scale) / F.pow(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2), F.lit(crs.cone))
    # wrap the longitude difference so that grids crossing the date line stay in one piece
    delta = F.pmod(lon - F.lit(crs.lon_0) + 180.0, F.lit(360.0)) - 180.0
    theta = F.lit(crs.cone) * F.radians(delta)
    return rho * F.sin(theta), F.lit(crs.rho_0) - rho * F.cos(theta)


def lcc_inverse(x: Column, y: Column, crs: LambertConformal = NWM_LCC) -> tuple[Column, Column]:
    """Metres to degrees."""
    sign = math.copysign(1.0, crs.cone)
    down = F.lit(crs.rho_0) - y
    rho = sign * F.sqrt(x * x + down * down)
    theta = F.atan2(sign * x, sign * down)
    lat = F.degrees(2 * F.atan(F.pow(F.lit(crs.scale) / rho, F.lit(1 / crs.cone)))) - 90.0
    return F.degrees(theta) / crs.cone + crs.lon_0, lat


def reproject_polygons(polygons: DataFrame, crs: LambertConformal = NWM_LCC) -> DataFrame:
    """Replace the lon/lat of polygon vertices with projected coordinates."""
    x, y = lcc_forward(F.col("x"), F.col("y"), crs)
    return polygons.withColumns({"x": x, "y": y})


def meshgrid(xs: DataFrame, ys: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """All (y, x) pairs of two axis tables ``(i, x)`` and ``(j, y)`` as ``(j, i, x, y)``.

    Every row of the y axis is unfolded over the index range of the x axis, and the x coordinate is
    looked up by index, so the pairing is an equi-join.
    """
    span = xs.agg(F.struct(F.min("i").alias("first"), F.max("i").alias("last"))).scalar()
    indices = F.sequence(span.getField("first"), span.getField("last"))
    rows = ys.select("j", y, F.explode(indices).alias("i"))
    return rows.join(xs.select("i", x), "i").select("j", "i", x, y)


def with_lonlat(mesh: DataFrame, crs: LambertConformal = NWM_LCC) -> DataFrame:
    """Add 2-D ``lon`` and ``lat`` to a mesh of projected ``x`` and ``y``."""
    lon, lat = lcc_inverse(F.col("x"), F.col("y"), crs)
    return mesh.withColumns({"lon": lon, "lat": lat})
