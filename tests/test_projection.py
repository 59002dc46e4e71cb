import json
import math

import pytest
from pyspark.sql import functions as F

from meterline.functions import geometry as G
from meterline.functions.projection import LONG_ISLAND_FEET, LambertConic
from meterline.operators.geo_models import zone_lonlat
from meterline.sources.geometry import read_zone_geojson, zone_geometry_from_geojson

# The worked example of the EPSG guidance note 7-2 for this projection (NAD27 / Texas South Central).
TEXAS = LambertConic(6378206.4, 294.97870, 27 + 50 / 60, -99.0, 28 + 23 / 60, 30 + 17 / 60, 2_000_000.0, 0.0, 1200 / 3937)


def forward(p: LambertConic, lon: float, lat: float) -> tuple[float, float]:
    n, scale, rho0 = p.constants()
    rho, theta = scale * p._t(math.radians(lat)) ** n, n * math.radians(lon - p.lon_origin)
    return p.false_easting + rho * math.sin(theta) / p.unit, p.false_northing + (rho0 - rho * math.cos(theta)) / p.unit


def test_published_example(spark):
    at = spark.range(1).select(TEXAS.lonlat(F.lit(2963503.91), F.lit(254759.80)).alias("p")).first().p
    assert at.lon == pytest.approx(-96.0, abs=1e-7) and at.lat == pytest.approx(28.5, abs=1e-7)


def test_round_trip(spark):
    south = LambertConic(6378160.0, 298.25, -36.0, 145.0, -36.0, -38.0, 2_500_000.0, 2_500_000.0)
    for p, lon0, lat0 in ((LONG_ISLAND_FEET, -74.0, 40.7), (south, 145.0, -37.0)):
        points = [(lon0 + dx, lat0 + dy) for dx in (-3, -0.1, 0, 0.4, 2) for dy in (-2, 0, 0.01, 1.5)]
        df = spark.createDataFrame([(*q, *forward(p, *q)) for q in points] + [(None, None, None, 1.0)], "lon double, lat double, x double, y double")
        for r in df.withColumn("p", p.lonlat(F.col("x"), F.col("y"))).collect():
            if r.x is None:
                assert r.p.lon is None and r.p.lat is None
            else:
                assert r.p.lon == pytest.approx(r.lon, abs=1e-11) and r.p.lat == pytest.approx(r.lat, abs=1e-11)


def test_zones_in_degrees(spark, tmp_dir):
    x, y = forward(LONG_ISLAND_FEET, -73.98, 40.75)
    square = {"type": "Polygon", "coordinates": [[[x - 50, y - 50], [x + 50, y - 50], [x + 50, y + 50], [x - 50, y + 50], [x - 50, y - 50]]]}
    line = {"type": "Polygon", "coordinates": [[[x, y], [x, y]]]}
    with open(f"{tmp_dir}/z.geojsonl", "w") as f:
        f.writelines(json.dumps({"type": "Feature", "properties": {"LocationID": i}, "geometry": g}) + "\n" for i, g in enumerate((square, line)))
    geom = zone_geometry_from_geojson(read_zone_geojson(spark, f"{tmp_dir}/z.geojsonl"))
    got = {r.LocationID: r for r in zone_lonlat(geom).collect()}
    assert got["0"].longitude == pytest.approx(-73.98, abs=1e-9) and got["0"].latitude == pytest.approx(40.75, abs=1e-9)
    assert got["0"].area_sq_meters == pytest.approx(10_000 * (1200 / 3937) ** 2, rel=1e-6)
    assert got["1"].longitude is None and got["1"].latitude is None
    ring = geom.where("LocationID = '0'").select(LONG_ISLAND_FEET.reproject(F.col("polygons")).alias("p")).first().p[0][0]
    assert len(ring) == 5 and ring[0] == ring[4] and abs(ring[0][0] + 73.98) < 0.001
    assert geom.where("LocationID = '0'").select(G.area(F.col("polygons")).alias("a")).first().a == pytest.approx(10_000, rel=1e-6)
