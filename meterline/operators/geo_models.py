"""Zone dimension with geometry measures (WKT, GeoJSON, area, centroid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import geometry as G
from meterline.functions.joins import dimension
from meterline.functions.projection import LONG_ISLAND_FEET, LambertConic


def zone_measures(geom: DataFrame) -> DataFrame:
    """WKT, GeoJSON, area and centroid per zone; the shoelace sums are
    evaluated once per row and shared by area and centroid."""
    p, t = F.col("polygons"), F.col("geom_type")
    with_t = geom.select("LocationID", "polygons", "geom_type", G.totals(p).alias("_t"))
    c = G.centroid_of(F.col("_t"))
    return with_t.select(
        "LocationID",
        G.as_wkt(p, t).alias("geometry_wkt"),
        G.as_geojson(p, t).alias("geometry_geojson"),
        G.area_of(F.col("_t")).alias("zone_area_sq_meters"),
        c["x"].alias("zone_centroid_longitude"),
        c["y"].alias("zone_centroid_latitude"),
    )


def zone_lonlat(geom: DataFrame, projection: LambertConic = LONG_ISLAND_FEET) -> DataFrame:
    """Longitude and latitude of each zone's centroid in degrees, and its area in
    square metres of the plane; null for a zone without area."""
    t = G.totals(F.col("polygons"))
    at = geom.select("LocationID", t.alias("_t")).withColumn("_c", G.centroid_of(F.col("_t")))
    at = at.withColumn("_at", projection.lonlat(F.col("_c.x"), F.col("_c.y")))
    return at.select("LocationID", F.col("_at.lon").alias("longitude"), F.col("_at.lat").alias("latitude"),
                     (G.area_of(F.col("_t")) * F.lit(projection.unit * projection.unit)).alias("area_sq_meters"))


def dim_zones_geo(zones: DataFrame, geom: DataFrame) -> DataFrame:
    """Staged zones left-joined to their geometry measures on the text id.
    Area and centroid are in source-coordinate units, whatever the names say."""
    m = dimension(zone_measures(geom).withColumnRenamed("LocationID", "g_LocationID"))
    j = zones.join(m, zones.LocationID == m.g_LocationID, "left")
    return j.select("LocationID", "Zone", "Borough", "service_zone", "geometry_wkt", "geometry_geojson",
                    "zone_area_sq_meters", "zone_centroid_longitude", "zone_centroid_latitude",
                    "_ingested_at")
