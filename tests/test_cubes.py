import pytest
from pyspark.sql import functions as F

from meterline.plans import rollups
from meterline.plans.cube_defs import ALL_CUBES, RAW_TAXI_TRIPS, warehouse_tables
from meterline.plans.cubes import CubeQuery, CubeSet, Filter, TimeDimension, infer_cube
from meterline.plans.warehouse import TripWarehouse
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tables(spark):
    return warehouse_tables(TripWarehouse.from_testdata(spark, SF001))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_infer_cube_reproduces_raw_cube(spark, tables):
    cube = infer_cube("raw_taxi_trips", "raw_taxi_trips", tables["raw_taxi_trips"])
    assert {(m.name, m.type) for m in cube.measures} == {(m.name, m.type) for m in RAW_TAXI_TRIPS.measures}
    assert {(d.name, d.type) for d in cube.dimensions} == {(d.name, d.type) for d in RAW_TAXI_TRIPS.dimensions}


def test_dimension_cubes_on_seeds(spark, tables):
    for cube, m, n in (("VendorDim", "vendorCount", 4), ("RateCodeDim", "rateCodeCount", 7),
                       ("PaymentTypeDim", "paymentTypeCount", 7)):
        got = ALL_CUBES.query(CubeQuery(measures=(f"{cube}.{m}",)), tables).first()[0]
        assert got == n


def test_only_needed_joins(spark, tables):
    q = CubeQuery(measures=("TaxiTrips.tripCount",), dimensions=("PickupZone.borough",))
    _, src = ALL_CUBES.source(q, tables)
    cols = [c for c in src.columns if "__" in c]
    assert cols and all(c.startswith("PickupZone__") for c in cols)


def test_filters_order_limit(spark, tables):
    q = CubeQuery(measures=("TaxiTrips.tripCount",), dimensions=("TaxiTrips.pickupBorough",),
                  filters=(Filter("TaxiTrips.pickupBorough", "notEquals", ("ASIA",)),
                           Filter("TaxiTrips.passengerCount", "gte", (2,))),
                  order=(("TaxiTrips.tripCount", "desc"),), limit=2)
    rows = ALL_CUBES.query(q, tables).collect()
    assert len(rows) == 2 and rows[0][1] >= rows[1][1]
    assert all(r[0] != "ASIA" for r in rows)
    fct = tables["fct_taxi_trips"]
    top = (fct.where((F.col("pickup_borough") != "ASIA") & (F.col("passenger_count") >= 2))
              .groupBy("pickup_borough").count().orderBy(F.desc("count")).first())
    assert rows[0][1] == top["count"]


def test_rollup_reaggregation_equals_base_query_exactly(spark, tables):
    q = CubeQuery(measures=("TaxiTrips.tripCount", "TaxiTrips.totalRevenueCharged", "TaxiTrips.avgFareAmount",
                            "TaxiTrips.totalMilesTraveled"),
                  dimensions=("TaxiTrips.vendorName",),
                  time_dimensions=(TimeDimension("TaxiTrips.pickupDatetime", "month"),))
    ro = rollups.build_rollup(ALL_CUBES, "TaxiTrips", "dailyOperations", tables)
    served = rows(rollups.serve(ro, ALL_CUBES, "TaxiTrips", "dailyOperations", q))
    base = rows(ALL_CUBES.query(q, tables))
    assert served == base   # exact decimal parts: no tolerance needed


def test_rollup_materialized_and_cannot_serve(spark, tables, tmp_dir):
    ro = rollups.materialize(spark, rollups.build_rollup(ALL_CUBES, "TaxiZones", "boroughSummary", tables),
                             f"{tmp_dir}/borough_summary")
    q = CubeQuery(measures=("TaxiZones.totalZones", "TaxiZones.avgZoneArea"), dimensions=("TaxiZones.borough",))
    served = rows(rollups.serve(ro, ALL_CUBES, "TaxiZones", "boroughSummary", q))
    assert served == rows(ALL_CUBES.query(q, tables))
    pa = ALL_CUBES["TaxiZones"].pre_aggregations[0]
    assert not rollups.can_serve(ALL_CUBES["TaxiZones"], pa,
                                 CubeQuery(measures=("TaxiZones.totalZones",), dimensions=("TaxiZones.zoneName",)))


def test_plain_double_mode(spark, tables):
    plain = CubeSet(list(ALL_CUBES.cubes.values()))
    q = CubeQuery(measures=("TaxiTrips.totalFareAmount",))
    a, b = plain.query(q, tables).first()[0], ALL_CUBES.query(q, tables).first()[0]
    assert abs(a - b) < 1e-6


def test_query_from_dict_and_rollup_routing(spark, tables, tmp_dir):
    q = CubeQuery.from_dict({
        "measures": ["TaxiTrips.tripCount", "TaxiTrips.avgFareAmount"],
        "dimensions": ["TaxiTrips.pickupBorough"],
        "timeDimensions": [{"dimension": "TaxiTrips.pickupDatetime", "granularity": "month"}],
        "filters": [{"member": "TaxiTrips.pickupBorough", "operator": "notEquals", "values": ["ASIA"]}],
        "order": {"TaxiTrips.tripCount": "desc"}, "limit": 1000})
    assert q.time_dimensions[0].granularity == "month" and q.order == (("TaxiTrips.tripCount", "desc"),)
    store = rollups.RollupStore(ALL_CUBES)
    store.build(spark, "TaxiTrips", "dailyOperations", tables, path=f"{tmp_dir}/daily_ops")
    assert store.route(q) == ("TaxiTrips", "dailyOperations")
    assert rows(store.query(q, tables)) == rows(ALL_CUBES.query(q, tables))
    other = CubeQuery(measures=("TaxiTrips.totalTips",), dimensions=("TaxiTrips.pickupBorough",))
    assert store.route(other) is None
    assert rows(store.query(other, tables)) == rows(ALL_CUBES.query(other, tables))


def test_join_numeric_fact_key_to_text_dimension_key(spark):
    from meterline.plans.cubes import Cube, Dimension, Join, Measure
    fact = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0), (9, 1.0)], "k int, v double")
    dim = spark.createDataFrame([("1.0", "one"), ("2", "two"), ("x", "junk")], "id string, name string")
    cubes = CubeSet([Cube("F", "f", measures=(Measure("total", "sum", "v"),), joins=(Join("D", "D", "k", "id"),)),
                     Cube("D", "d", dimensions=(Dimension("name", "name"),))])
    got = {r[0]: r[1] for r in cubes.query(CubeQuery(measures=("F.total",), dimensions=("D.name",)),
                                             {"f": fact, "d": dim}).collect()}
    assert got == {"one": 5.0, "two": 4.0, None: 1.0}
