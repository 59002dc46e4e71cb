"""Conformal conic projections undone as Catalyst expressions.

Planar zone coordinates (feet or metres of a state plane) become longitude and
latitude in degrees. The latitude has no closed form; it is the limit of a
fixed-point iteration that gains more than two digits a step."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 10


@dataclass(frozen=True)
class LambertConic:
    """A Lambert conformal conic projection with two standard parallels. Angles
    in degrees; the false origin in units of the coordinates, ``unit`` metres each."""

    semi_major: float
    inverse_flattening: float
    lat_origin: float
    lon_origin: float
    parallel_1: float
    parallel_2: float
    false_easting: float
    false_northing: float
    unit: float = 1.0

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening
        return math.sqrt(2 * f - f * f)

    def _t(self, lat: float) -> float:
        e, s = self.eccentricity, math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)

    def constants(self) -> tuple[float, float, float]:
        """(cone constant, radius of t = 1 in metres, radius of the origin)."""
        one, two, origin = (math.radians(x) for x in (self.parallel_1, self.parallel_2, self.lat_origin))
        m = lambda lat: math.cos(lat) / math.sqrt(1 - (self.eccentricity * math.sin(lat)) ** 2)
        n = math.sin(one) if one == two else math.log(m(one) / m(two)) / math.log(self._t(one) / self._t(two))
        scale = self.semi_major * m(one) / (n * self._t(one) ** n)
        return n, scale, scale * self._t(origin) ** n

    def lonlat(self, x: Column, y: Column) -> Column:
        """struct(lon, lat) in degrees of planar coordinates; null where one is null."""
        n, scale, rho0 = self.constants()
        sign, e = math.copysign(1.0, n), self.eccentricity
        east = (x - F.lit(self.false_easting)) * F.lit(self.unit * sign)
        north = (F.lit(rho0) - (y - F.lit(self.false_northing)) * F.lit(self.unit)) * F.lit(sign)
        t = F.pow(F.sqrt(east * east + north * north) / F.lit(abs(scale)), F.lit(1 / n))

        def step(lat, _):
            s = F.sin(lat) * F.lit(e)
            return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))

        lat = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(math.pi / 2) - 2 * F.atan(t), step)
        return F.struct(F.degrees(F.atan2(east, north) / F.lit(n) + F.lit(math.radians(self.lon_origin))).alias("lon"), F.degrees(lat).alias("lat"))

    def reproject(self, polygons: Column) -> Column:
        """Every point of the polygons as [longitude, latitude]."""
        def point(p):
            at = self.lonlat(p[0], p[1])
            return F.array(at["lon"], at["lat"])

        return F.transform(polygons, lambda poly: F.transform(poly, lambda ring: F.transform(ring, point)))


# NAD83 / New York Long Island (US survey feet), EPSG 2263.
LONG_ISLAND_FEET = LambertConic(semi_major=6378137.0, inverse_flattening=298.257222101, lat_origin=40 + 10 / 60, lon_origin=-74.0,
                                parallel_1=41 + 2 / 60, parallel_2=40 + 40 / 60, false_easting=984250.0, false_northing=0.0, unit=1200 / 3937)
