"""Golden totals recorded in FIXTURES.md for sf0.01 (checked there on two engines)."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from meterline.plans.trip_queries import wh
from tests.conftest import SF01


def test_staged_trip_totals(spark):
    s = wh(spark, SF01).stg_trips()
    c = F.col
    r = s.agg(
        F.count(F.lit(1)).alias("n"), F.sum("calculated_total_amount").alias("calc"),
        F.sum("trip_duration_minutes").alias("dur"), F.sum("pickup_day_of_week").alias("dow"),
        F.count(F.when(c("trip_duration_minutes") <= 0, 1)).alias("le0"),
        F.count(F.when(c("trip_duration_minutes") < 0, 1)).alias("lt0"),
        F.count(F.when(F.abs(c("total_amount") - c("calculated_total_amount")) > 0.01, 1)).alias("mismatch"),
        F.count(F.when(c("passenger_count").isNull(), 1)).alias("pnull"),
        F.count(F.when(c("fare_amount") < 0, 1)).alias("fneg"),
        F.count(F.when(c("trip_distance") <= 0, 1)).alias("dle0"),
        F.count(F.when((c("passenger_count") > 0) & (c("passenger_count") <= 6) & (c("trip_distance") >= 0)
                       & (c("fare_amount") >= 0), 1)).alias("passing")).first()
    assert r.asDict() == {"n": 60000, "calc": Decimal("3353443.67"), "dur": 3362392, "dow": 181067, "le0": 1877,
                          "lt0": 1376, "mismatch": 20046, "pnull": 8598, "fneg": 651, "dle0": 2337, "passing": 37803}


def test_flagship_values(spark):
    got = [tuple(r) for r in E.queries()["top_boroughs"](spark, SF01).collect()]
    assert got == [("MIDDLE EAST", 6954, 23.4648, 56.3595, 6266), ("AMERICA", 6278, 23.4481, 56.7872, 5642),
                   ("ASIA", 5100, 23.6478, 57.1617, 4605), ("EUROPE", 3786, 23.5222, 55.986, 3411),
                   ("AFRICA", 3336, 23.2254, 56.704, 3005)]


def test_geometry_fixture_has_multipolygons(spark):
    rows = {r.LocationID: r for r in E.queries()["dim_zones_geo"](spark, SF01).collect()}
    for k in ("0", "10", "20"):
        assert rows[k].geometry_wkt.startswith("MULTIPOLYGON (((")
        assert rows[k].zone_area_sq_meters == 13.0       # 4 x 3 rectangle + 1 x 1 island
    assert rows["3"].geometry_wkt.startswith("POLYGON ((") and rows["3"].zone_area_sq_meters == 4 * 6 - 1
    assert rows["24"].geometry_wkt is None


def test_fused_profile_equals_load_profile(spark):
    from meterline.operators import profile as P
    from meterline.operators import quality as Q
    w = wh(spark, SF01)
    models = {"s": w.stg_trips(), "z": w.stg_zones(), "v": w.dim_vendor()}
    rows, prof = Q.fused_model_check_values(
        w.stg_trips(), [Q.not_null("s", "VendorID"), Q.row_count_positive("s")],
        [Q.relationships("s", "PULocationID", "z", "LocationID"), Q.relationships("s", "VendorID", "v", "vendor_id")],
        models, "tpep_pickup_datetime")
    lp = P.load_profile(w.stg_trips()).first()
    assert (prof["total_rows"], prof["earliest"], prof["latest"], prof["months_covered"]) == tuple(lp)
    assert {r["test_name"]: r["failures"] for r in rows}["relationships__s__VendorID__v"] == 29941
