"""Registered semantic-layer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from meterline import bindings
from meterline.functions.columns import round_to
from meterline.oracle_sql import r as _r, xavg, xsum
from meterline.plans import rollups
from meterline.plans.cube_defs import ALL_CUBES, RAW_TAXI_TRIPS, TAXI_TRIPS, warehouse_tables
from meterline.plans.cubes import Cube, CubeQuery, CubeSet, Dimension, Filter, Measure, PreAggregation, TimeDimension, infer_cube
from meterline.plans.distinct_rollups import DistinctRollup
from meterline.plans.registry import register
from meterline.plans.rollup_advisor import lattice_rows
from meterline.plans.trip_queries import wh
from meterline.session import scratch_path

# Doubles are compared at 6 digits. An average of values with few decimals can
# lie on a rounding tie, where the last bit of a sum decides; a shift that is no
# short decimal moves the ties away from such values.
DIGITS = 6
OFF_TIE = 1.3e-9


def r(expr: str) -> str:
    return _r(f"({expr} + {OFF_TIE!r} * sign({expr}))", DIGITS)


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Double measures at ``digits`` digits, so that summation order does not show."""
    def shown(c):
        return round_to(c + F.lit(OFF_TIE) * F.signum(c), digits)
    return df.select(*[shown(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def run(spark, sf_dir, q: CubeQuery, cubes: CubeSet = ALL_CUBES) -> DataFrame:
    return round_doubles(cubes.query(q, warehouse_tables(wh(spark, sf_dir))))


def _sel(pairs):
    return ",\n       ".join(f"{expr} AS {name}" for name, expr in pairs)


# ---------------------------------------------------------------- C1: query surface
@register("cube_by_vendor", oracle=f"""
SELECT VendorID AS TaxiTrips_vendorId, CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount,
       {r(xsum('fare_amount'))} AS TaxiTrips_totalFareAmount, {r(xavg('fare_amount'))} AS TaxiTrips_avgFareAmount
FROM fct_trips WHERE store_and_fwd_flag IN ('N')
GROUP BY VendorID ORDER BY TaxiTrips_tripCount DESC NULLS LAST, TaxiTrips_vendorId ASC NULLS LAST LIMIT 10""")
def q_cube_by_vendor(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=("TaxiTrips.tripCount", "TaxiTrips.totalFareAmount", "TaxiTrips.avgFareAmount"),
        dimensions=("TaxiTrips.vendorId",),
        filters=(Filter("TaxiTrips.storeAndForwardFlag", "equals", ("N",)),),
        order=(("TaxiTrips.tripCount", "desc"), ("TaxiTrips.vendorId", "asc")), limit=10))


@register("cube_daily", oracle=f"""
SELECT CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS raw_taxi_trips_tpep_pickup_datetime_day,
       CAST(COUNT(*) AS BIGINT) AS raw_taxi_trips_count, {r(xsum('total_amount'))} AS raw_taxi_trips_total_amount
FROM raw_trips
WHERE tpep_pickup_datetime >= TIMESTAMP '1998-01-01' AND tpep_pickup_datetime < TIMESTAMP '1999-01-01'
GROUP BY 1""")
def q_cube_daily(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=("raw_taxi_trips.count", "raw_taxi_trips.total_amount"),
        time_dimensions=(TimeDimension("raw_taxi_trips.tpep_pickup_datetime", "day", ("1998-01-01", "1998-12-31")),)))


# ---------------------------------------------------------------- C2-C4 live cubes
RAW_MEASURES = [("count", "CAST(COUNT(*) AS BIGINT)"), ("fare_amount", r(xsum("fare_amount"))),
                ("passenger_count", r(xsum("passenger_count"))), ("tip_amount", r(xsum("tip_amount"))),
                ("tolls_amount", r(xsum("tolls_amount"))), ("total_amount", r(xsum("total_amount")))]


@register("cube_raw_trips", oracle=f"""
SELECT store_and_fwd_flag AS raw_taxi_trips_store_and_fwd_flag,
       {_sel([(f'raw_taxi_trips_{n}', e) for n, e in RAW_MEASURES])}
FROM raw_trips GROUP BY store_and_fwd_flag""")
def q_cube_raw_trips(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=tuple(f"raw_taxi_trips.{m.name}" for m in RAW_TAXI_TRIPS.measures),
        dimensions=("raw_taxi_trips.store_and_fwd_flag",)))


@register("cube_inferred", oracle=f"""
SELECT store_and_fwd_flag AS raw_auto_store_and_fwd_flag,
       {_sel([(f'raw_auto_{n}', e) for n, e in RAW_MEASURES])}
FROM raw_trips GROUP BY store_and_fwd_flag""")
def q_cube_inferred(spark, sf_dir):
    """The cube inferred from the raw trip schema reproduces the live raw cube."""
    tables = warehouse_tables(wh(spark, sf_dir))
    cube = infer_cube("raw_auto", "raw_taxi_trips", tables["raw_taxi_trips"])
    q = CubeQuery(measures=tuple(f"raw_auto.{m.name}" for m in cube.measures),
                  dimensions=("raw_auto.store_and_fwd_flag",))
    return round_doubles(CubeSet([cube]).query(q, tables))


@register("cube_raw_zones", oracle="""
SELECT Borough AS raw_taxi_zones_borough, service_zone AS raw_taxi_zones_service_zone, Zone AS raw_taxi_zones_zone,
       CAST(COUNT(*) AS BIGINT) AS raw_taxi_zones_count
FROM raw_zones GROUP BY 1, 2, 3""")
def q_cube_raw_zones(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=("raw_taxi_zones.count",),
        dimensions=("raw_taxi_zones.borough", "raw_taxi_zones.service_zone", "raw_taxi_zones.zone")))


@register("cube_fct_count", oracle="SELECT CAST(COUNT(*) AS BIGINT) AS fct_taxi_trips_count FROM fct_trips")
def q_cube_fct_count(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(measures=("fct_taxi_trips.count",)))


# ---------------------------------------------------------------- C6-C9 unmounted cubes
TRIP_MEASURE_SQL = [
    ("tripCount", "CAST(COUNT(*) AS BIGINT)"), ("totalPassengers", r(xsum("passenger_count"))),
    ("totalMilesTraveled", r(xsum("trip_distance"))), ("avgTripDistance", r(xavg("trip_distance"))),
    ("totalFareAmount", r(xsum("fare_amount"))), ("avgFareAmount", r(xavg("fare_amount"))),
    ("totalTips", r(xsum("tip_amount"))), ("avgTipAmount", r(xavg("tip_amount"))),
    ("totalRevenueCharged", r(xsum("total_amount"))), ("avgRevenuePerTrip", r(xavg("total_amount"))),
    ("totalMtaTax", r(xsum("mta_tax"))), ("totalImprovementSurcharge", r(xsum("improvement_surcharge"))),
    ("totalCongestionSurcharge", r(xsum("congestion_surcharge"))), ("totalAirportFees", r(xsum("airport_fee"))),
    ("totalExtrasAndSurcharges", r(xsum("extra"))), ("totalTolls", r(xsum("tolls_amount"))),
    ("avgFarePerMile", r(xavg("fare_per_mile"))), ("avgTripDurationMinutes", r(xavg("trip_duration_minutes"))),
]


@register("cube_trips_all_measures", oracle=f"""
SELECT pickup_borough AS TaxiTrips_pickupBorough,
       {_sel([(f'TaxiTrips_{n}', e) for n, e in TRIP_MEASURE_SQL])}
FROM fct_trips GROUP BY pickup_borough""")
def q_cube_trips_all_measures(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=tuple(f"TaxiTrips.{m.name}" for m in TAXI_TRIPS.measures),
        dimensions=("TaxiTrips.pickupBorough",)))


@register("cube_zones", oracle=f"""
SELECT Borough AS TaxiZones_borough, CAST(COUNT(*) AS BIGINT) AS TaxiZones_totalZones,
       {r(xsum('zone_area_sq_meters'))} AS TaxiZones_totalCoverageArea, {r(xavg('zone_area_sq_meters'))} AS TaxiZones_avgZoneArea
FROM dim_zones_geo GROUP BY Borough""")
def q_cube_zones(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=("TaxiZones.totalZones", "TaxiZones.totalCoverageArea", "TaxiZones.avgZoneArea"),
        dimensions=("TaxiZones.borough",)))


@register("cube_staging", oracle=f"""
SELECT VendorID AS StagingTaxiTest_vendorId,
       CAST(date_trunc('month', pickup_date) AS TIMESTAMP) AS StagingTaxiTest_pickupDate_month,
       CAST(COUNT(*) AS BIGINT) AS StagingTaxiTest_tripCount, {r(xavg('fare_amount'))} AS StagingTaxiTest_avgFare,
       {r(xsum('total_amount'))} AS StagingTaxiTest_totalRevenue
FROM stg_trips GROUP BY 1, 2""")
def q_cube_staging(spark, sf_dir):
    return run(spark, sf_dir, CubeQuery(
        measures=("StagingTaxiTest.tripCount", "StagingTaxiTest.avgFare", "StagingTaxiTest.totalRevenue"),
        dimensions=("StagingTaxiTest.vendorId",),
        time_dimensions=(TimeDimension("StagingTaxiTest.pickupDate", "month"),)))


@register("cube_star_join", oracle=f"""
SELECT v.vendor_name AS VendorDim_vendorName, p.payment_name AS PaymentTypeDim_paymentName,
       rc.rate_code_name AS RateCodeDim_rateCodeName, pz.Borough AS PickupZone_borough,
       dz.Borough AS DropoffZone_borough,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('t.total_amount'))} AS TaxiTrips_totalRevenueCharged
FROM fct_trips t
LEFT JOIN dim_vendor v ON t.VendorID = v.vendor_id
LEFT JOIN dim_payment_type p ON t.payment_type = p.payment_type
LEFT JOIN dim_rate_code rc ON t.RatecodeID = rc.rate_code_id
LEFT JOIN dim_zones_geo pz ON t.PULocationID = pz.LocationID
LEFT JOIN dim_zones_geo dz ON t.DOLocationID = dz.LocationID
GROUP BY 1, 2, 3, 4, 5""")
def q_cube_star_join(spark, sf_dir):
    """Members of joined cubes pull in only the joins they need."""
    return run(spark, sf_dir, CubeQuery(
        measures=("TaxiTrips.tripCount", "TaxiTrips.totalRevenueCharged"),
        dimensions=("VendorDim.vendorName", "PaymentTypeDim.paymentName", "RateCodeDim.rateCodeName",
                    "PickupZone.borough", "DropoffZone.borough")))


# ---------------------------------------------------------------- C10-C14 rollups
def _rollup(spark, sf_dir, cube: str, pa: str) -> DataFrame:
    tables = warehouse_tables(wh(spark, sf_dir))
    return round_doubles(rollups.finalize(rollups.build_rollup(ALL_CUBES, cube, pa, tables), ALL_CUBES, cube, pa))


@register("rollup_daily_operations", oracle=f"""
SELECT pickup_date AS TaxiTrips_pickupDate, pickup_borough AS TaxiTrips_pickupBorough,
       vendor_name AS TaxiTrips_vendorName,
       CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS TaxiTrips_pickupDatetime_day,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('total_amount'))} AS TaxiTrips_totalRevenueCharged,
       {r(xsum('trip_distance'))} AS TaxiTrips_totalMilesTraveled, {r(xavg('fare_amount'))} AS TaxiTrips_avgFareAmount
FROM fct_trips GROUP BY 1, 2, 3, 4""")
def q_rollup_daily_operations(spark, sf_dir):
    return _rollup(spark, sf_dir, "TaxiTrips", "dailyOperations")


@register("rollup_payment", oracle=f"""
SELECT payment_name AS TaxiTrips_paymentMethod, pickup_borough AS TaxiTrips_pickupBorough,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('total_amount'))} AS TaxiTrips_totalRevenueCharged,
       {r(xsum('tip_amount'))} AS TaxiTrips_totalTips, {r(xavg('tip_amount'))} AS TaxiTrips_avgTipAmount
FROM fct_trips GROUP BY 1, 2""")
def q_rollup_payment(spark, sf_dir):
    return _rollup(spark, sf_dir, "TaxiTrips", "paymentAnalysis")


@register("rollup_trip_flow", oracle=f"""
SELECT pickup_zone AS TaxiTrips_pickupZone, dropoff_zone AS TaxiTrips_dropoffZone,
       pickup_borough AS TaxiTrips_pickupBorough, dropoff_borough AS TaxiTrips_dropoffBorough,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xavg('fare_amount'))} AS TaxiTrips_avgFareAmount,
       {r(xavg('trip_distance'))} AS TaxiTrips_avgTripDistance
FROM fct_trips GROUP BY 1, 2, 3, 4""")
def q_rollup_trip_flow(spark, sf_dir):
    return _rollup(spark, sf_dir, "TaxiTrips", "tripFlow")


@register("rollup_borough", oracle=f"""
SELECT Borough AS TaxiZones_borough, service_zone AS TaxiZones_serviceZone,
       CAST(COUNT(*) AS BIGINT) AS TaxiZones_totalZones, {r(xsum('zone_area_sq_meters'))} AS TaxiZones_totalCoverageArea,
       {r(xavg('zone_area_sq_meters'))} AS TaxiZones_avgZoneArea
FROM dim_zones_geo GROUP BY 1, 2""")
def q_rollup_borough(spark, sf_dir):
    return _rollup(spark, sf_dir, "TaxiZones", "boroughSummary")


REAGG_QUERY = CubeQuery(
    measures=("TaxiTrips.tripCount", "TaxiTrips.totalRevenueCharged", "TaxiTrips.totalMilesTraveled",
              "TaxiTrips.avgFareAmount"),
    dimensions=("TaxiTrips.pickupBorough",),
    time_dimensions=(TimeDimension("TaxiTrips.pickupDatetime", "year"),))


@register("rollup_reaggregate", oracle=f"""
SELECT pickup_borough AS TaxiTrips_pickupBorough,
       CAST(date_trunc('year', tpep_pickup_datetime) AS TIMESTAMP) AS TaxiTrips_pickupDatetime_year,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('total_amount'))} AS TaxiTrips_totalRevenueCharged,
       {r(xsum('trip_distance'))} AS TaxiTrips_totalMilesTraveled, {r(xavg('fare_amount'))} AS TaxiTrips_avgFareAmount
FROM fct_trips GROUP BY 1, 2""")
def q_rollup_reaggregate(spark, sf_dir):
    """C14: a borough x year query answered from the day-grain rollup."""
    tables = warehouse_tables(wh(spark, sf_dir))
    ro = rollups.build_rollup(ALL_CUBES, "TaxiTrips", "dailyOperations", tables)
    return round_doubles(rollups.serve(ro, ALL_CUBES, "TaxiTrips", "dailyOperations", REAGG_QUERY))


@register("cube_joined_measure", oracle="""
SELECT f.pickup_borough AS TaxiTrips_pickupBorough, CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount,
       CAST(COUNT(DISTINCT v.vendor_id) AS BIGINT) AS VendorDim_vendorCount
FROM fct_trips f LEFT JOIN dim_vendor v ON f.VendorID = v.vendor_id GROUP BY 1""")
def q_cube_joined_measure(spark, sf_dir):
    """A joined dimension's count is of its rows, not of the trips."""
    return run(spark, sf_dir, CubeQuery(measures=("TaxiTrips.tripCount", "VendorDim.vendorCount"),
                                        dimensions=("TaxiTrips.pickupBorough",)))


@register("rollup_stored", oracle=f"""
SELECT payment_name AS TaxiTrips_paymentMethod, CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount,
       {r(xsum('tip_amount'))} AS TaxiTrips_totalTips, {r(xavg('tip_amount'))} AS TaxiTrips_avgTipAmount
FROM fct_trips GROUP BY 1""")
def q_rollup_stored(spark, sf_dir):
    """C11, C14: the rollup is written once; the query reads the stored table, not the fact."""
    tables = warehouse_tables(wh(spark, sf_dir))
    store = rollups.RollupStore(ALL_CUBES)
    store.build(spark, "TaxiTrips", "paymentAnalysis", tables, path=scratch_path(spark, "rollups"))
    return round_doubles(store.query(CubeQuery(
        measures=("TaxiTrips.tripCount", "TaxiTrips.totalTips", "TaxiTrips.avgTipAmount"), dimensions=("TaxiTrips.paymentMethod",)), tables))


@register("cube_joined_sum", oracle=f"""
WITH reached AS (SELECT DISTINCT v.vendor_name, z.LocationID, z.zone_area_sq_meters AS area
                 FROM fct_trips f LEFT JOIN dim_vendor v ON f.VendorID = v.vendor_id JOIN dim_zones_geo z ON f.PULocationID = z.LocationID),
areas AS (SELECT vendor_name, {r(xsum("area"))} AS total, {r(xavg("area"))} AS mean FROM reached GROUP BY 1),
trips AS (SELECT v.vendor_name, CAST(COUNT(*) AS BIGINT) AS n FROM fct_trips f LEFT JOIN dim_vendor v ON f.VendorID = v.vendor_id GROUP BY 1)
SELECT t.vendor_name AS VendorDim_vendorName, n AS TaxiTrips_tripCount, total AS PickupZone_totalCoverageArea, mean AS PickupZone_avgZoneArea
FROM trips t LEFT JOIN areas a ON t.vendor_name IS NOT DISTINCT FROM a.vendor_name""")
def q_cube_joined_sum(spark, sf_dir):
    """Area of the zones that each vendor picks up in; a zone counts once."""
    return run(spark, sf_dir, CubeQuery(measures=("TaxiTrips.tripCount", "PickupZone.totalCoverageArea", "PickupZone.avgZoneArea"),
                                        dimensions=("VendorDim.vendorName",)))


RANGE = ("1996-03-05T07:30:00", "1998-07-19T18:45:10")


@register("rollup_range_split", oracle=f"""
SELECT pickup_borough AS TaxiTrips_pickupBorough, CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP) AS TaxiTrips_pickupDatetime_month,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('total_amount'))} AS TaxiTrips_totalRevenueCharged,
       {r(xsum('trip_distance'))} AS TaxiTrips_totalMilesTraveled, {r(xavg('fare_amount'))} AS TaxiTrips_avgFareAmount
FROM fct_trips WHERE tpep_pickup_datetime >= '{RANGE[0]}' AND tpep_pickup_datetime <= '{RANGE[1]}' GROUP BY 1, 2""")
def q_rollup_range_split(spark, sf_dir):
    """C14: a range that begins and ends inside a day, from the stored daily rollup
    (whole days) and the fact (the two edges)."""
    tables = warehouse_tables(wh(spark, sf_dir))
    store = rollups.RollupStore(ALL_CUBES)
    store.build(spark, "TaxiTrips", "dailyOperations", tables, path=scratch_path(spark, "rollups"))
    return round_doubles(store.query(CubeQuery(
        measures=REAGG_QUERY.measures, dimensions=REAGG_QUERY.dimensions,
        time_dimensions=(TimeDimension("TaxiTrips.pickupDatetime", "month", RANGE),)), tables))


@register("rollup_routed", oracle="""
SELECT pickup_borough AS TaxiTrips_pickupBorough, CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount FROM fct_trips GROUP BY 1""")
def q_rollup_routed(spark, sf_dir):
    """C14: three stored rollups can answer; the one with the fewest rows does."""
    tables = warehouse_tables(wh(spark, sf_dir))
    store = rollups.RollupStore(ALL_CUBES)
    for name in ("dailyOperations", "paymentAnalysis", "tripFlow"):
        store.build(spark, "TaxiTrips", name, tables, path=scratch_path(spark, "rollups"))
    return store.query(CubeQuery(measures=("TaxiTrips.tripCount",), dimensions=("TaxiTrips.pickupBorough",)), tables)


LATTICE_WORKLOAD = (CubeQuery(("TaxiTrips.tripCount",), ("TaxiTrips.pickupBorough",)),
                    CubeQuery(("TaxiTrips.tripCount",), ("TaxiTrips.vendorName",), (TimeDimension("TaxiTrips.pickupDatetime", "month"),)),
                    CubeQuery(("TaxiTrips.totalRevenueCharged",), ("TaxiTrips.paymentMethod",)))
LATTICE = (("pickupBorough", None, "pickup_borough"), ("vendorName", "month", "vendor_name, {m}"), ("paymentMethod", None, "payment_name"),
           ("pickupBorough,vendorName", "month", "pickup_borough, vendor_name, {m}"), ("paymentMethod,pickupBorough", None, "payment_name, pickup_borough"),
           ("paymentMethod,vendorName", "month", "payment_name, vendor_name, {m}"),
           ("paymentMethod,pickupBorough,vendorName", "month", "payment_name, pickup_borough, vendor_name, {m}"))


@register("rollup_lattice", oracle="\nUNION ALL\n".join(
    f"SELECT '{dims}' AS dimensions, {f"'{g}'" if g else 'CAST(NULL AS VARCHAR)'} AS granularity, CAST(COUNT(*) AS BIGINT) AS n_rows "
    f"FROM (SELECT DISTINCT {columns.format(m="date_trunc('month', tpep_pickup_datetime)")} FROM fct_trips)" for dims, g, columns in LATTICE))
def q_rollup_lattice(spark, sf_dir):
    """C14: the exact rows of every rollup that a workload of three queries spans,
    from which the advisor chooses."""
    counted = lattice_rows(ALL_CUBES, "TaxiTrips", LATTICE_WORKLOAD, warehouse_tables(wh(spark, sf_dir)))
    return counted.withColumn("dimensions", F.array_join("dimensions", ","))


ORDERS = Cube("Orders", "orders", dimensions=(Dimension("orderDate", "order_date", "time"), Dimension("segment", "customer_segment"),
                                              Dimension("region", "customer_region")),
              measures=(Measure("customers", "count_distinct", "customer_id"),),
              pre_aggregations=(PreAggregation("dailyCustomers", ("customers",), ("segment", "region"), "orderDate", "day"),))
GRAINS = ("day", "month", "year")


@register("rollup_distinct_customers", oracle="\nUNION ALL\n".join(f"""
SELECT '{g}' AS grain, CAST(date_trunc('{g}', o.order_date) AS TIMESTAMP) AS period, c.customer_segment AS segment,
       CAST(COUNT(DISTINCT o.customer_id) AS BIGINT) AS customers
FROM orders_fact o LEFT JOIN customers_dim c ON o.customer_id = c.customer_id GROUP BY 2, 3""" for g in GRAINS))
def q_rollup_distinct_customers(spark, sf_dir):
    """Exact distinct customers by segment at three grains from one daily
    rollup by segment and region."""
    orders = bindings.orders_fact(spark, sf_dir).join(bindings.customers_dim(spark, sf_dir), "customer_id", "left")
    rollup = DistinctRollup(CubeSet([ORDERS]), "Orders", "dailyCustomers")
    rollup.build(spark, {"orders": orders})
    out = None
    for grain in GRAINS:
        got = rollup.serve(CubeQuery(("Orders.customers",), ("Orders.segment",), (TimeDimension("Orders.orderDate", grain),))).select(
            F.lit(grain).alias("grain"), F.col(f"Orders_orderDate_{grain}").alias("period"), F.col("Orders_segment").alias("segment"),
            F.col("Orders_customers").alias("customers"))
        out = got if out is None else out.unionByName(got)
    return out
