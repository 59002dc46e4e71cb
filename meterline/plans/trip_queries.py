"""Registered queries over the driver's tables (keys of ``queries()``).

Every query reads the parquet tables under ``sf_dir`` (through the
projections of ``meterline.bindings``) so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
import math
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import bindings
from meterline.functions.columns import round_to
from meterline.functions.projection import LONG_ISLAND_FEET, STEPS, LambertConic
from meterline.oracle_sql import r, xavg
from meterline.operators import geo_models, models, profile, reconcile, timeseries, topk
from meterline.plans.registry import register
from meterline.plans.warehouse import TripWarehouse
from meterline.session import apply_defaults, scratch_path, size_shuffles
from meterline.sources.raw_layer import tables_bytes, tables_fingerprint
from meterline.sources.shapefile import read_shapefile, write_shapefile

TABLES_USED = ["lineitem", "orders", "supplier", "customer", "nation", "region"]


_WAREHOUSES: dict[tuple, TripWarehouse] = {}
_WH_LOCK = threading.Lock()


def wh(spark: SparkSession, sf_dir: str) -> TripWarehouse:
    """The model graph over ``sf_dir``, reused across queries of one session
    while the input tables are unchanged (checked on every call by a stat
    fingerprint of their files). Plans are lazy: reuse saves planning work,
    every query still reads the data."""
    apply_defaults(spark)
    size_shuffles(spark, tables_bytes(spark, sf_dir, TABLES_USED))
    sc = spark.sparkContext
    key = (sc.applicationId, sc.startTime, id(spark), sf_dir, tables_fingerprint(spark, sf_dir, TABLES_USED))
    with _WH_LOCK:
        if key not in _WAREHOUSES:
            _WAREHOUSES.clear()
            _WAREHOUSES[key] = TripWarehouse.from_testdata(spark, sf_dir)
        return _WAREHOUSES[key]


# ---------------------------------------------------------------- flagship (L1)
@register("top_boroughs", oracle=f"""
SELECT pickup_borough, CAST(COUNT(*) AS BIGINT) AS trip_count,
       {r(xavg('trip_distance'))} AS avg_distance, {r(xavg('total_amount'))} AS avg_fare,
       CAST(COUNT(rate_code_name) AS BIGINT) AS rated_trips
FROM fct_trips GROUP BY pickup_borough
ORDER BY trip_count DESC, pickup_borough ASC NULLS LAST LIMIT 5""")
def q_top_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_boroughs(wh(spark, sf_dir).fct_trips())


# ---------------------------------------------------------------- models
@register("stg_trips", oracle="SELECT * FROM stg_trips")
def q_stg_trips(spark, sf_dir):
    return wh(spark, sf_dir).stg_trips()


@register("stg_zones", oracle="SELECT * FROM stg_zones")
def q_stg_zones(spark, sf_dir):
    return wh(spark, sf_dir).stg_zones()


@register("fct_trips", oracle="SELECT * FROM fct_trips")
def q_fct_trips(spark, sf_dir):
    return wh(spark, sf_dir).fct_trips()


@register("mart_trips", oracle="SELECT * FROM mart_trips")
def q_mart_trips(spark, sf_dir):
    return wh(spark, sf_dir).mart_trips()


# ---------------------------------------------------------------- column operators
@register("calculated_total", oracle="""
SELECT fare_amount, extra, mta_tax, improvement_surcharge, tolls_amount, congestion_surcharge,
       airport_fee, calculated_total_amount FROM stg_trips""")
def q_calculated_total(spark, sf_dir):
    return wh(spark, sf_dir).stg_trips().select(
        "fare_amount", "extra", "mta_tax", "improvement_surcharge", "tolls_amount",
        "congestion_surcharge", "airport_fee", "calculated_total_amount")


@register("trip_duration", oracle="""
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_minutes FROM stg_trips""")
def q_trip_duration(spark, sf_dir):
    return wh(spark, sf_dir).stg_trips().select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_minutes")


@register("date_parts", oracle="""
SELECT tpep_pickup_datetime, pickup_date, pickup_year, pickup_month, pickup_day_of_week, pickup_hour
FROM stg_trips""")
def q_date_parts(spark, sf_dir):
    return wh(spark, sf_dir).stg_trips().select(
        "tpep_pickup_datetime", "pickup_date", "pickup_year", "pickup_month",
        "pickup_day_of_week", "pickup_hour")


@register("fare_ratios", oracle="""
SELECT fare_amount, trip_distance, trip_duration_minutes, fare_per_mile, fare_per_minute FROM mart_trips""")
def q_fare_ratios(spark, sf_dir):
    return wh(spark, sf_dir).mart_trips().select(
        "fare_amount", "trip_distance", "trip_duration_minutes", "fare_per_mile", "fare_per_minute")


@register("quality_flags_fct", oracle="""
SELECT VendorID, trip_duration_minutes, total_amount, calculated_total_amount,
       missing_vendor_flag, negative_duration_flag, total_amount_mismatch_flag FROM fct_trips""")
def q_quality_flags_fct(spark, sf_dir):
    return wh(spark, sf_dir).fct_trips().select(
        "VendorID", "trip_duration_minutes", "total_amount", "calculated_total_amount",
        "missing_vendor_flag", "negative_duration_flag", "total_amount_mismatch_flag")


@register("quality_flags_mart", oracle="""
SELECT trip_duration_minutes, total_amount, calculated_total_amount,
       negative_duration_flag, total_amount_mismatch_flag FROM mart_trips""")
def q_quality_flags_mart(spark, sf_dir):
    return wh(spark, sf_dir).mart_trips().select(
        "trip_duration_minutes", "total_amount", "calculated_total_amount",
        "negative_duration_flag", "total_amount_mismatch_flag")


@register("fct_filter", oracle="""
SELECT tpep_pickup_datetime, pickup_date, trip_distance, fare_amount, passenger_count FROM fct_trips""")
def q_fct_filter(spark, sf_dir):
    return wh(spark, sf_dir).fct_trips().select(
        "tpep_pickup_datetime", "pickup_date", "trip_distance", "fare_amount", "passenger_count")


@register("mart_filter", oracle="""
SELECT pickup_datetime, pickup_date, trip_distance, fare_amount, passenger_count FROM mart_trips""")
def q_mart_filter(spark, sf_dir):
    return wh(spark, sf_dir).mart_trips().select(
        "pickup_datetime", "pickup_date", "trip_distance", "fare_amount", "passenger_count")


@register("lookup_joins", oracle="""
SELECT t.VendorID, t.RatecodeID, t.payment_type, v.vendor_name, r.rate_code_name, p.payment_name
FROM stg_trips t
LEFT JOIN dim_vendor v ON t.VendorID = v.vendor_id
LEFT JOIN dim_rate_code r ON t.RatecodeID = r.rate_code_id
LEFT JOIN dim_payment_type p ON t.payment_type = p.payment_type""")
def q_lookup_joins(spark, sf_dir):
    w = wh(spark, sf_dir)
    return models.lookup_joins(w.stg_trips(), w.dim_vendor(), w.dim_rate_code(), w.dim_payment_type()).select(
        "VendorID", "RatecodeID", "payment_type", "vendor_name", "rate_code_name", "payment_name")


@register("zone_role_join", oracle="""
SELECT t.PULocationID, t.DOLocationID, pu.Zone AS pickup_zone, pu.Borough AS pickup_borough,
       pu.service_zone AS pickup_service_zone, dz.Zone AS dropoff_zone, dz.Borough AS dropoff_borough,
       dz.service_zone AS dropoff_service_zone
FROM stg_trips t
LEFT JOIN stg_zones pu ON t.PULocationID = pu.LocationID
LEFT JOIN stg_zones dz ON t.DOLocationID = dz.LocationID""")
def q_zone_role_join(spark, sf_dir):
    w = wh(spark, sf_dir)
    return models.zone_role_join(w.stg_trips(), w.stg_zones()).select(
        "PULocationID", "DOLocationID", "pickup_zone", "pickup_borough", "pickup_service_zone",
        "dropoff_zone", "dropoff_borough", "dropoff_service_zone")


@register("clean_orders", oracle="""
SELECT CAST(order_id AS VARCHAR) AS order_id, COALESCE(customer_id, 'UNKNOWN') AS customer_id,
       CAST(order_date AS DATE) AS order_date, ROUND(CAST(order_amount AS DECIMAL(10,2)), 2) AS order_amount
FROM raw_orders WHERE order_date IS NOT NULL""")
def q_clean_orders(spark, sf_dir):
    return models.clean_orders(bindings.raw_orders(spark, sf_dir))


# ---------------------------------------------------------------- geometry
@register("zone_wkt", oracle="SELECT LocationID, geometry_wkt FROM zone_wkt")
def q_zone_wkt(spark, sf_dir):
    return geo_models.zone_measures(wh(spark, sf_dir).zone_geometry()).select("LocationID", "geometry_wkt")


@register("zone_geojson", oracle="SELECT LocationID, geometry_geojson FROM zone_wkt")
def q_zone_geojson(spark, sf_dir):
    return geo_models.zone_measures(wh(spark, sf_dir).zone_geometry()).select("LocationID", "geometry_geojson")


@register("zone_area", oracle="SELECT LocationID, area AS zone_area_sq_meters FROM zone_measures")
def q_zone_area(spark, sf_dir):
    return geo_models.zone_measures(wh(spark, sf_dir).zone_geometry()).select("LocationID", "zone_area_sq_meters")


@register("zone_centroid", oracle=f"""
SELECT LocationID, {r('mx / area', 9)} AS zone_centroid_longitude, {r('my / area', 9)} AS zone_centroid_latitude
FROM zone_measures""")
def q_zone_centroid(spark, sf_dir):
    m = geo_models.zone_measures(wh(spark, sf_dir).zone_geometry())
    return m.select("LocationID", round_to("zone_centroid_longitude", 9).alias("zone_centroid_longitude"),
                    round_to("zone_centroid_latitude", 9).alias("zone_centroid_latitude"))


def lonlat_sql(p: LambertConic) -> str:
    """The inverse projection, a common table a step of the iteration."""
    n, scale, rho0 = p.constants()
    e, half_pi = p.eccentricity, math.pi / 2
    out = (f"WITH plane AS (SELECT LocationID, area, (mx / area - {p.false_easting!r}) * {p.unit!r} AS east, "
           f"{rho0!r} - (my / area - {p.false_northing!r}) * {p.unit!r} AS north FROM zone_measures),\n"
           f"cone AS (SELECT *, pow(sqrt(east * east + north * north) / {scale!r}, 1 / {n!r}) AS t FROM plane),\n"
           f"lat0 AS (SELECT *, {half_pi!r} - 2 * atan(t) AS lat FROM cone)")
    for k in range(STEPS):
        out += (f",\nlat{k + 1} AS (SELECT * EXCLUDE (lat), {half_pi!r} - 2 * atan(t * pow((1 - {e!r} * sin(lat)) / (1 + {e!r} * sin(lat)), {e / 2!r})) AS lat "
                f"FROM lat{k})")
    lon, lat = f"degrees(atan2(east, north) / {n!r} + {math.radians(p.lon_origin)!r})", "degrees(lat)"
    return out + f"\nSELECT LocationID, {r(lon, 9)} AS longitude, {r(lat, 9)} AS latitude, {r(f'area * {p.unit * p.unit!r}', 6)} AS area_sq_meters FROM lat{STEPS}"


@register("zone_lonlat", oracle=lonlat_sql(LONG_ISLAND_FEET))
def q_zone_lonlat(spark, sf_dir):
    """G4 + M3: zone centroids in degrees, the conic projection undone."""
    at = geo_models.zone_lonlat(wh(spark, sf_dir).zone_geometry())
    return at.select("LocationID", round_to("longitude", 9).alias("longitude"), round_to("latitude", 9).alias("latitude"),
                     round_to("area_sq_meters", 6).alias("area_sq_meters"))


@register("zone_shapefile", oracle=f"""
SELECT LocationID, area AS zone_area_sq_meters, {r('mx / area', 9)} AS zone_centroid_longitude, {r('my / area', 9)} AS zone_centroid_latitude
FROM zone_measures""")
def q_zone_shapefile(spark, sf_dir):
    """Zone polygons written as shapefiles and read back in cuts of a
    kilobyte, then measured."""
    path = scratch_path(spark, "shapefile") + "/zones"
    write_shapefile(wh(spark, sf_dir).zone_geometry().select("LocationID", "polygons"), path)
    m = geo_models.zone_measures(read_shapefile(spark, path, partition_bytes=1024))
    return m.select("LocationID", "zone_area_sq_meters", round_to("zone_centroid_longitude", 9).alias("zone_centroid_longitude"),
                    round_to("zone_centroid_latitude", 9).alias("zone_centroid_latitude"))


@register("dim_zones_geo", oracle=f"""
SELECT b.LocationID, b.Zone, b.Borough, b.service_zone, w.geometry_wkt, w.geometry_geojson,
       m.area AS zone_area_sq_meters, {r('m.mx / m.area', 9)} AS zone_centroid_longitude,
       {r('m.my / m.area', 9)} AS zone_centroid_latitude, b._ingested_at
FROM stg_zones b
LEFT JOIN zone_measures m ON b.LocationID = m.LocationID
LEFT JOIN zone_wkt w ON b.LocationID = w.LocationID""")
def q_dim_zones_geo(spark, sf_dir):
    d = wh(spark, sf_dir).dim_zones_geo()
    return d.withColumn("zone_centroid_longitude", round_to("zone_centroid_longitude", 9)) \
            .withColumn("zone_centroid_latitude", round_to("zone_centroid_latitude", 9))


# ---------------------------------------------------------------- profiles
@register("profile_trips", oracle="""
SELECT CAST(COUNT(*) AS BIGINT) AS total_trips, MIN(tpep_pickup_datetime) AS earliest_trip,
       MAX(tpep_pickup_datetime) AS latest_trip,
       CAST(COUNT(DISTINCT DATE_TRUNC('month', tpep_pickup_datetime)) AS BIGINT) AS months_covered
FROM raw_trips""")
def q_profile_trips(spark, sf_dir):
    return profile.load_profile(wh(spark, sf_dir).raw_trips())


@register("zone_count", oracle="SELECT CAST(COUNT(*) AS BIGINT) AS zone_count FROM raw_zones")
def q_zone_count(spark, sf_dir):
    return profile.row_count(wh(spark, sf_dir).raw_zones(), "zone_count")


@register("distinct_boroughs", oracle="SELECT DISTINCT Borough FROM raw_zones ORDER BY Borough")
def q_distinct_boroughs(spark, sf_dir):
    return topk.distinct_sorted(wh(spark, sf_dir).raw_zones(), "Borough")


NULL_COLS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"]


@register("null_counts", oracle="SELECT " + ", ".join(
    f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}" for c in NULL_COLS)
    + " FROM raw_trips")
def q_null_counts(spark, sf_dir):
    return profile.null_counts(wh(spark, sf_dir).raw_trips(), NULL_COLS)


@register("trip_stats", oracle=f"""
SELECT MIN(tpep_pickup_datetime) AS earliest_trip, MAX(tpep_pickup_datetime) AS latest_trip,
       {r(xavg('trip_distance'))} AS avg_trip_distance, {r(xavg('fare_amount'))} AS avg_fare_amount
FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""")
def q_trip_stats(spark, sf_dir):
    return profile.range_stats(wh(spark, sf_dir).raw_trips())


@register("model_counts", oracle="""
SELECT 'fct_trips' AS model, CAST(COUNT(*) AS BIGINT) AS row_count FROM fct_trips
UNION ALL SELECT 'mart_trips', CAST(COUNT(*) AS BIGINT) FROM mart_trips""")
def q_model_counts(spark, sf_dir):
    w = wh(spark, sf_dir)
    return profile.model_counts({"fct_trips": w.fct_trips(), "mart_trips": w.mart_trips()})


@register("fact_quality", oracle="""
SELECT CAST(SUM(total_amount_mismatch_flag) AS BIGINT) AS total_mismatches,
       CAST(SUM(negative_duration_flag) AS BIGINT) AS negative_durations,
       CAST(COUNT(DISTINCT pickup_borough) AS BIGINT) AS pickup_boroughs,
       CAST(COUNT(DISTINCT dropoff_borough) AS BIGINT) AS dropoff_boroughs
FROM fct_trips""")
def q_fact_quality(spark, sf_dir):
    return profile.fact_quality(wh(spark, sf_dir).fct_trips())


@register("trip_count", oracle="SELECT CAST(COUNT(*) AS BIGINT) AS trip_count FROM mart_trips")
def q_trip_count(spark, sf_dir):
    return profile.row_count(wh(spark, sf_dir).mart_trips(), "trip_count")


@register("table_profile", oracle="""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) AS unique_keys,
       MIN(o_orderdate) AS min_date, MAX(o_orderdate) AS max_date FROM orders""")
def q_table_profile(spark, sf_dir):
    return profile.table_profile(bindings.table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")


RECONCILE_DROPPED_BOROUGH = "AFRICA"
RECONCILE_DROPPED_LOCATION = "0"


def _reconcile_sql(table: str, dev_filter: str) -> str:
    dev = f"FILTER (WHERE {dev_filter})"
    return f"""
SELECT '{table}' AS table_name,
       CAST(COUNT(*) {dev} AS BIGINT) AS dev_rows,
       CAST(COUNT(*) AS BIGINT) AS prod_rows,
       CAST(COUNT(*) {dev} - COUNT(*) AS BIGINT) AS row_variance,
       CAST(SUM(calculated_total_amount) {dev} AS DECIMAL(38,2)) AS dev_key_sum,
       CAST(SUM(calculated_total_amount) AS DECIMAL(38,2)) AS prod_key_sum,
       CAST(COALESCE(SUM(calculated_total_amount) {dev}, 0)
            - COALESCE(SUM(calculated_total_amount), 0) AS DECIMAL(38,2)) AS key_sum_variance
FROM {table}"""


@register("reconcile", oracle=_reconcile_sql(
    "fct_trips", f"pickup_borough IS DISTINCT FROM '{RECONCILE_DROPPED_BOROUGH}'")
    + "\nUNION ALL" + _reconcile_sql(
    "mart_trips", f"pickup_location_id IS DISTINCT FROM '{RECONCILE_DROPPED_LOCATION}'"))
def q_reconcile(spark, sf_dir):
    """Prod = the fact and the mart; dev = the same models after a change
    that drops one borough (fact) or one pickup location (mart)."""
    w = wh(spark, sf_dir)
    fct, mart = w.fct_trips(), w.mart_trips()
    return profile.reconcile({
        "fct_trips": (fct.where(~F.col("pickup_borough").eqNullSafe(RECONCILE_DROPPED_BOROUGH)), fct),
        "mart_trips": (mart.where(~F.col("pickup_location_id").eqNullSafe(RECONCILE_DROPPED_LOCATION)), mart),
    }, "calculated_total_amount")


FRESHNESS_NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
FRESHNESS_MAX_LAG_HOURS = 24


@register("freshness", oracle=f"""
SELECT MAX(ts) AS latest_at, date_diff('hour', MAX(ts), TIMESTAMP '{FRESHNESS_NOW:%Y-%m-%d %H:%M:%S}') AS lag_hours,
       date_diff('hour', MAX(ts), TIMESTAMP '{FRESHNESS_NOW:%Y-%m-%d %H:%M:%S}') <= {FRESHNESS_MAX_LAG_HOURS} AS is_fresh
FROM events""")
def q_freshness(spark, sf_dir):
    return profile.freshness(bindings.table(spark, sf_dir, "events"), "ts", FRESHNESS_NOW,
                             FRESHNESS_MAX_LAG_HOURS)


# ---------------------------------------------------------------- revenue patterns
@register("daily_revenue", oracle="""
WITH per_customer AS (SELECT customer_id, order_date, SUM(revenue) AS spent, COUNT(order_id) AS orders FROM orders_fact GROUP BY ALL)
SELECT order_date, customer_segment, customer_region, CAST(SUM(spent) AS DECIMAL(38,2)) AS daily_revenue,
       CAST(COUNT(customer_id) AS BIGINT) AS unique_customers, CAST(SUM(orders) AS BIGINT) AS order_count
FROM per_customer LEFT JOIN customers_dim USING (customer_id) GROUP BY ALL""")
def q_daily_revenue(spark, sf_dir):
    out = timeseries.daily_revenue(bindings.orders_fact(spark, sf_dir), bindings.customers_dim(spark, sf_dir),
                                   amount="revenue")
    return out.withColumn("daily_revenue", F.col("daily_revenue").cast("decimal(38,2)"))


@register("cohort_revenue", oracle="""
WITH dated AS (SELECT *, MIN(order_date) OVER (PARTITION BY customer_id) AS began FROM orders_fact WHERE customer_id IS NOT NULL),
monthly AS (SELECT began AS cohort_date, customer_id, SUM(revenue) AS spent,
                   (year(order_date) - year(began)) * 12 + month(order_date) - month(began) AS months_since_first FROM dated GROUP BY ALL)
SELECT cohort_date, months_since_first, CAST(COUNT(*) AS BIGINT) AS active_customers, CAST(SUM(spent) AS DECIMAL(38,2)) AS cohort_revenue
FROM monthly GROUP BY ALL""")
def q_cohort_revenue(spark, sf_dir):
    out = timeseries.cohort_revenue(bindings.orders_fact(spark, sf_dir))
    return out.withColumn("cohort_revenue", F.col("cohort_revenue").cast("decimal(38,2)"))


@register("rolling_revenue", oracle=f"""
WITH daily AS (SELECT order_date, SUM(revenue) AS daily_revenue FROM orders_fact GROUP BY order_date)
SELECT order_date, CAST(daily_revenue AS DECIMAL(38,2)) AS daily_revenue,
       {r('CAST(SUM(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / COUNT(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS revenue_7day_avg,
       {r('CAST(SUM(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / COUNT(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS revenue_30day_avg
FROM daily""")
def q_rolling_revenue(spark, sf_dir):
    out = timeseries.rolling_revenue(bindings.orders_fact(spark, sf_dir), amount="revenue")
    return out.withColumn("daily_revenue", F.col("daily_revenue").cast("decimal(38,2)"))


@register("reconcile_rows", oracle="""
WITH prod AS (SELECT order_id, customer_id, order_date, revenue + CASE WHEN order_id % 997 = 0 THEN 1 ELSE 0 END AS revenue FROM orders_fact WHERE order_id % 1009 <> 0
              UNION ALL SELECT -order_id, customer_id, order_date, revenue FROM orders_fact WHERE order_id % 1013 = 0)
SELECT coalesce(d.order_id, p.order_id) AS order_id,
       CASE WHEN p.order_id IS NULL THEN 'missing' WHEN d.order_id IS NULL THEN 'extra' ELSE 'changed' END AS status,
       CAST(CASE WHEN d.order_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS left_rows, CAST(CASE WHEN p.order_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS right_rows
FROM orders_fact d FULL JOIN prod p ON d.order_id = p.order_id WHERE d.revenue IS DISTINCT FROM p.revenue""")
def q_reconcile_rows(spark, sf_dir):
    """Which orders differ between two layers; the second one is the first with
    some orders changed, left out and added."""
    dev = bindings.orders_fact(spark, sf_dir)
    n = F.col("order_id")
    changed = dev.where(n % 1009 != 0).withColumn("revenue", (F.col("revenue") + F.when(n % 997 == 0, 1).otherwise(0)).cast("decimal(12,2)"))
    prod = changed.unionByName(dev.where(n % 1013 == 0).withColumn("order_id", -n))
    return reconcile.differing_keys(dev, prod, ["order_id"])
