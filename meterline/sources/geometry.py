"""Zone geometry source: GeoJSON text (one geometry per zone) to coordinate arrays.

Replaces reading a shapefile through a spatial extension: boundaries arrive
as GeoJSON text, e.g. ``spark.read.json`` of a FeatureCollection exploded
to features, or a two-column table (id, geojson).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.geometry import parse_geojson


def zone_geometry_from_geojson(df: DataFrame, id_col: str = "LocationID",
                               geojson_col: str = "geojson") -> DataFrame:
    """(id, geojson text) -> (LocationID text, geom_type, polygons)."""
    g = parse_geojson(F.col(geojson_col))
    return df.select(F.col(id_col).cast("string").alias("LocationID"),
                     g["type"].alias("geom_type"), g["polygons"].alias("polygons"))


def read_geojson_seq(spark, path: str, id_property: str = "LocationID") -> DataFrame:
    """Line-delimited GeoJSON (one Feature per line) -> (LocationID, geojson).
    Files split across tasks like any text file: the scalable form for large
    boundary sets."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(
        F.get_json_object("value", f"$.properties.{id_property}").alias("LocationID"),
        F.get_json_object("value", "$.geometry").alias("geojson"))


def read_zone_geojson(spark, path: str, id_property: str = "LocationID") -> DataFrame:
    """Boundary files by their name: ``*.geojsonl``, ``*.geojsons`` and ``*.ndjson``
    hold a Feature a line and are split across tasks, others are collections."""
    lines = path.lower().endswith((".geojsonl", ".geojsons", ".ndjson"))
    return (read_geojson_seq if lines else read_feature_collection)(spark, path, id_property)


def read_feature_collection(spark, path: str, id_property: str = "LocationID") -> DataFrame:
    """GeoJSON FeatureCollection files -> (LocationID, geojson). Each file is
    read whole by one task (fine for zone sets of a few MB; use
    ``read_geojson_seq`` for large ones); features are exploded afterwards."""
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    features = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    feats = raw.select(F.explode(features).alias("f"))
    return feats.select(
        F.get_json_object("f", f"$.properties.{id_property}").alias("LocationID"),
        F.get_json_object("f", "$.geometry").alias("geojson"))
