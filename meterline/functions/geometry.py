"""Planar polygon measures on coordinate arrays, with higher-order functions.

Geometry is held as ``polygons: array<array<array<array<double>>>>`` (a list
of polygons, each a list of rings, each a list of ``[x, y]`` points; ring 0
is the shell, the rest are holes). A Polygon is a one-element list. All
measures are in the units of the source coordinates (no reprojection).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGON_TYPE = "array<array<array<double>>>"
MULTIPOLYGON_TYPE = "array<array<array<array<double>>>>"


def _ring_sums(ring: Column) -> Column:
    """Shoelace sums of one ring: struct(c = sum of cross products,
    x = sum (x_i + x_j) * cross, y = sum (y_i + y_j) * cross), j = i + 1
    wrapping to 0, so open and closed rings give the same result."""
    n = F.size(ring)

    def step(acc, i):
        p, q = ring[i], ring[(i + 1) % n]
        cross = p[0] * q[1] - q[0] * p[1]
        return F.struct((acc["c"] + cross).alias("c"),
                        (acc["x"] + (p[0] + q[0]) * cross).alias("x"),
                        (acc["y"] + (p[1] + q[1]) * cross).alias("y"))

    zero = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.when(n >= 3, F.aggregate(F.sequence(F.lit(0), n - 1), zero, step)).otherwise(zero)


def _weighted_rings(polygons: Column) -> Column:
    """Per ring: struct(a = |area|, mx = |area| * cx, my = |area| * cy), with
    holes negated, flattened over all polygons."""
    def ring_terms(ring, j):
        s = _ring_sums(ring)
        sign = F.signum(s["c"]) * F.when(j == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct((s["c"] * sign / 2).alias("a"),
                        (s["x"] * sign / 6).alias("mx"),
                        (s["y"] * sign / 6).alias("my"))

    return F.flatten(F.transform(polygons, lambda poly: F.transform(poly, ring_terms)))


def totals(polygons: Column) -> Column:
    """struct(a, mx, my): area and area-weighted coordinate sums over all
    rings (holes negative). Compute once, then derive area and centroid."""
    return _totals(polygons)


def area_of(t: Column) -> Column:
    return t["a"]


def centroid_of(t: Column) -> Column:
    ok = t["a"] != 0
    return F.struct(F.when(ok, t["mx"] / t["a"]).alias("x"), F.when(ok, t["my"] / t["a"]).alias("y"))


def _totals(polygons: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(_weighted_rings(polygons), zero,
                       lambda acc, r: F.struct((acc["a"] + r["a"]).alias("a"),
                                               (acc["mx"] + r["mx"]).alias("mx"),
                                               (acc["my"] + r["my"]).alias("my")))


def area(polygons: Column) -> Column:
    """Area with holes subtracted, summed over the polygons."""
    return area_of(_totals(polygons))


def centroid(polygons: Column) -> Column:
    """Area-weighted centroid as struct(x, y); NULL for zero area."""
    return centroid_of(_totals(polygons))


def _num(x: Column) -> Column:
    """Coordinate text: integral values without a fraction (``4`` not ``4.0``)."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))


def _ring_text(ring: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", _num(p[0]), _num(p[1]))), ", "), F.lit(")"))


def _polygon_text(poly: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(poly, _ring_text), ", "), F.lit(")"))


def as_wkt(polygons: Column, geom_type: Column) -> Column:
    """Well-known text: ``POLYGON ((x y, ...), (...))`` or ``MULTIPOLYGON (((...)))``."""
    single = F.concat(F.lit("POLYGON "), _polygon_text(polygons[0]))
    multi = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(polygons, _polygon_text), ", "), F.lit(")"))
    return F.when(polygons.isNull(), F.lit(None)).when(geom_type == "Polygon", single).otherwise(multi)


def as_geojson(polygons: Column, geom_type: Column) -> Column:
    """GeoJSON text with the source geometry type."""
    coords = F.when(geom_type == "Polygon", F.to_json(polygons[0])).otherwise(F.to_json(polygons))
    return F.when(polygons.isNull(), F.lit(None)).otherwise(
        F.concat(F.lit('{"type":"'), geom_type, F.lit('","coordinates":'), coords, F.lit("}")))


def parse_geojson(text: Column) -> Column:
    """GeoJSON Polygon / MultiPolygon text -> struct(type, polygons)."""
    gtype = F.get_json_object(text, "$.type")
    coords = F.get_json_object(text, "$.coordinates")
    polys = (F.when(gtype == "Polygon", F.array(F.from_json(coords, POLYGON_TYPE)))
              .when(gtype == "MultiPolygon", F.from_json(coords, MULTIPOLYGON_TYPE)))
    return F.struct(gtype.alias("type"), polys.alias("polygons"))
