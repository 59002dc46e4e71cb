import json

from pyspark.sql import functions as F

from meterline.functions import geometry as G

SQUARE_WITH_HOLE = {"type": "Polygon", "coordinates": [
    [[0, 0], [4, 0], [4, 3], [0, 3], [0, 0]],
    [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]]}
MULTI = {"type": "MultiPolygon", "coordinates": [
    [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]],
    [[[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]]]}


def measures(spark, geoms):
    df = spark.createDataFrame([(json.dumps(g),) for g in geoms], "geojson string")
    g = G.parse_geojson(F.col("geojson"))
    p, t = g["polygons"], g["type"]
    return df.select(G.area(p).alias("area"), G.centroid(p).alias("c"),
                     G.as_wkt(p, t).alias("wkt"), G.as_geojson(p, t).alias("gj")).collect()


def test_area_with_hole(spark):
    r = measures(spark, [SQUARE_WITH_HOLE])[0]
    assert r.area == 11.0
    # shell centroid (2, 1.5) weight 12, hole (1.5, 1.5) weight 1
    assert abs(r.c.x - (12 * 2 - 1.5) / 11) < 1e-12 and abs(r.c.y - 1.5) < 1e-12


def test_orientation_and_open_rings(spark):
    cw = {"type": "Polygon", "coordinates": [[[0, 0], [0, 3], [4, 3], [4, 0]]]}  # clockwise, open
    r = measures(spark, [cw])[0]
    assert r.area == 12.0 and (r.c.x, r.c.y) == (2.0, 1.5)


def test_multipolygon(spark):
    r = measures(spark, [MULTI])[0]
    assert r.area == 8.0 and (r.c.x, r.c.y) == (6.0, 6.0)
    assert r.wkt == "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((10 10, 12 10, 12 12, 10 12, 10 10)))"
    assert json.loads(r.gj)["type"] == "MultiPolygon"


def test_wkt_and_geojson(spark):
    r = measures(spark, [SQUARE_WITH_HOLE])[0]
    assert r.wkt == "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
    back = json.loads(r.gj)
    assert back["type"] == "Polygon" and back["coordinates"][1][2] == [2.0, 2.0]


def test_degenerate(spark):
    line = {"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]}
    r = measures(spark, [line])[0]
    assert r.area == 0.0 and r.c.x is None


def test_geojson_sources(spark, tmp_dir):
    from meterline.sources.geometry import read_feature_collection, read_geojson_seq, zone_geometry_from_geojson
    feats = [{"type": "Feature", "properties": {"LocationID": i}, "geometry": g}
             for i, g in ((1, SQUARE_WITH_HOLE), (2, MULTI))]
    with open(f"{tmp_dir}/fc.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)
    with open(f"{tmp_dir}/seq.geojsonl", "w") as f:
        f.write("\n".join(json.dumps(x) for x in feats) + "\n")
    for df in (read_feature_collection(spark, f"{tmp_dir}/fc.geojson"), read_geojson_seq(spark, f"{tmp_dir}/seq.geojsonl")):
        g = zone_geometry_from_geojson(df)
        got = {r.LocationID: r.a for r in g.select("LocationID", G.area(F.col("polygons")).alias("a")).collect()}
        assert got == {"1": 11.0, "2": 8.0}
