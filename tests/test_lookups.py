"""One rule for lookup keys that occur several times: they multiply, in models and cubes alike."""

import datetime as dt

from pyspark.sql import functions as F

from meterline.functions.joins import is_literal, key_is_unique, lookup
from meterline.operators import models
from meterline.plans.cube_defs import ALL_CUBES
from meterline.plans.cubes import CubeQuery
from meterline.plans.warehouse import TripWarehouse
from meterline.sources import seeds
from tests.conftest import SF001


def doubled(spark):
    """A warehouse in which zone 3 occurs twice, under different names."""
    w = TripWarehouse.from_testdata(spark, SF001)
    zones = w.raw_zones()
    twice = zones.unionByName(zones.where("LocationID = 3").withColumn("Zone", F.lit("second name")))
    return w, TripWarehouse(spark, raw_trips_fn=w.raw_trips, raw_zones_fn=lambda: twice, zone_geojson_fn=w.zone_geojson_fn, date_min=w.date_min, date_max=w.date_max)


def test_a_doubled_zone_doubles_its_trips_in_models_and_cubes(spark):
    once, twice = doubled(spark)
    fct = once.fct_trips()
    n = fct.count()
    at3 = fct.agg(F.sum(F.when(F.col("PULocationID") == "3", 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("DOLocationID") == "3", 1).otherwise(0)).alias("b"),
                  F.sum(F.when((F.col("PULocationID") == "3") & (F.col("DOLocationID") == "3"), 1).otherwise(0)).alias("ab")).first()
    assert at3.a > 0 and twice.fct_trips().count() == n + at3.a + at3.b + at3.ab
    names = {r[0] for r in twice.fct_trips().where("PULocationID = '3'").select("pickup_zone").distinct().collect()}
    assert len(names) == 2 and "second name" in names


def test_unique_zones_leave_unused_lookups_out_of_the_plan(spark):
    once, twice = doubled(spark)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    assert joins(once.fct_trips().select("trip_distance")) == 0
    assert joins(twice.fct_trips().select("trip_distance")) == 2  # only these can change the count


def test_lookup_proofs(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert key_is_unique(dim, "k") and not key_is_unique(dim.unionByName(dim), "k")
    many = dim.unionByName(dim.where("k = 1"))
    left = spark.createDataFrame([(1,), (2,), (9,)], "id int")
    rows = lambda d: left.join(lookup(d, "k"), F.col("id") == F.col("k"), "left").count()
    assert rows(dim) == 3 and rows(many) == 4
    assert "broadcast" not in lookup(many, "k", max_rows=2)._jdf.queryExecution().analyzed().toString().lower()
    vendor = seeds.dim_vendor(spark)
    assert is_literal(vendor) and key_is_unique(vendor, "vendor_id", literal=vendor)


def test_a_doubled_seed_key_from_a_file_multiplies(spark, tmp_dir):
    with open(f"{tmp_dir}/vendors.csv", "w") as f:
        f.write("vendor_id,vendor_name,vendor_description\n1,One,x\n1,Uno,y\n2,Two,z\n")
    vendor = seeds.load_seed_csv(spark, "dim_vendor", f"{tmp_dir}/vendors.csv")
    trips = spark.createDataFrame([("1", "1", "1"), ("2", "1", "1"), ("7", "1", "1")], "VendorID string, RatecodeID string, payment_type string")
    got = models.lookup_joins(trips, vendor, seeds.dim_rate_code(spark), seeds.dim_payment_type(spark))
    assert sorted((r.VendorID, r.vendor_name) for r in got.collect()) == [("1", "One"), ("1", "Uno"), ("2", "Two"), ("7", None)]


def test_cube_and_fact_agree_on_a_doubled_zone(spark):
    _, twice = doubled(spark)
    w = TripWarehouse.from_testdata(spark, SF001)
    tables = {"fct_taxi_trips": w.fct_trips(), "dim_taxi_zones_geospatial": twice.dim_zones_geo()}
    cube = ALL_CUBES["TaxiTrips"]
    join = next((j for j in cube.joins if ALL_CUBES[j.cube].table == "dim_taxi_zones_geospatial"), None)
    assert join is not None
    dim = next(d.name for d in ALL_CUBES[join.cube].dimensions if d.sql == "LocationID")
    q = CubeQuery(measures=["TaxiTrips.tripCount"], dimensions=[f"{join.name}.{dim}"])
    got = {r[0]: r[1] for r in ALL_CUBES.query(q, tables).collect()}
    left = w.fct_trips().where(F.col(join.left) == "3").count()
    assert got["3"] == 2 * left


assert dt
