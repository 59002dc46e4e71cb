"""Test projections: trip-shaped tables derived from the driver's TPC-H-style tables.

The reference ships no data. These functions derive its raw inputs (trips,
zones, zone geometry, an orders fact with a customer dimension) from the
parquet tables under ``sf_dir`` so every query's work grows with those
tables. Each DataFrame has a DuckDB twin in ``meterline.oracle_sql`` built
from the same expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.columns import to_decimal
from meterline.functions.joins import dimension

# Fixed values of the projection (see FIXTURES.md).
INGESTED_AT = dt.datetime(2025, 6, 1, 0, 0, 0)
TEST_DATE_MIN = dt.date(1996, 1, 1)
TEST_DATE_MAX = dt.date(2000, 5, 31)
EVENT_SPLIT = dt.datetime(2024, 1, 15, 0, 0, 0)
NO_GEOMETRY_KEY = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds(ts: Column, n: Column) -> Column:
    return F.timestamp_add("SECOND", n, ts)


def raw_trips(spark: SparkSession, sf_dir: str, ingested_at: dt.datetime = INGESTED_AT) -> DataFrame:
    """Raw trip rows: one per lineitem, with the reference's raw trip schema."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = dimension(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    customer = dimension(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))

    # orders x customer first (4x fewer rows than lineitem), then the big
    # equi-join on the order key, then the supplier lookup.
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_nationkey")
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(supplier, li.l_suppkey == supplier.s_suppkey)

    lk, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    snk = F.col("s_nationkey")
    pickup = _seconds(F.col("o_orderdate"), (lk * 37 + ln * 5003) % 86400)
    odd_line = ln % 2 == 1
    total = F.round(
        (F.col("l_extendedprice") / 1000 - 2 + F.col("l_discount") * 10 + F.lit(0.8).cast("decimal(1,1)")
         + F.col("l_tax") * 50
         + F.when(odd_line, F.lit(2.5).cast("decimal(2,1)")).otherwise(F.lit(0))
         + F.when(snk < 3, F.lit(1.25).cast("decimal(3,2)")).otherwise(F.lit(0))
         + F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0))) * 100, 0) / 100
    return j.select(
        (sk % 8).cast("int").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        _seconds(pickup, (pk % 120) * 60 - 180 + sk % 60).alias("tpep_dropoff_datetime"),
        F.when(ln == 7, F.lit(None).cast("double"))
         .otherwise((F.col("l_quantity").cast("int") % 8).cast("double")).alias("passenger_count"),
        (F.col("l_quantity") - 2).alias("trip_distance"),
        F.when(pk % 10 == 0, F.lit(None).cast("double")).otherwise(ln.cast("double")).alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        snk.alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        (pk % 8).cast("bigint").alias("payment_type"),
        (F.col("l_extendedprice") / 1000 - 2).alias("fare_amount"),
        (F.col("l_discount") * 10).alias("extra"),
        F.lit(0.5).cast("double").alias("mta_tax"),
        (F.col("l_tax") * 100).alias("tip_amount"),
        (F.col("l_tax") * 50).alias("tolls_amount"),
        F.lit(0.3).cast("double").alias("improvement_surcharge"),
        total.alias("total_amount"),
        F.when(odd_line, F.lit(2.5).cast("double")).alias("congestion_surcharge"),
        F.when(snk < 3, F.lit(1.25).cast("double")).alias("airport_fee"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
    )


def raw_zones(spark: SparkSession, sf_dir: str, ingested_at: dt.datetime = INGESTED_AT) -> DataFrame:
    """Raw zone lookup: one zone per nation, its region as borough (padded text)."""
    nation = table(spark, sf_dir, "nation")
    region = dimension(table(spark, sf_dir, "region"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("Zone"),
        F.concat("r_name", F.lit(" ")).alias("Borough"),
        F.concat(F.lit("Zone "), (F.col("n_regionkey") % 2).cast("string")).alias("service_zone"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
    )


def zone_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone boundaries as GeoJSON text: a rectangle per nation, a square hole
    for odd keys, a second 1x1 square (a MultiPolygon) for keys divisible by
    10, no geometry for nation 24 (so the join leaves NULLs)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    k = F.col("n_nationkey")
    h = k + 3 + k % 5
    ring = "[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]"
    outer = F.format_string(ring, k, k, k + 4, k, k + 4, h, k, h, k, k)
    hole = F.format_string(ring, k + 1, k + 1, k + 1, k + 2, k + 2, k + 2, k + 2, k + 1, k + 1, k + 1)
    island = F.format_string(ring, k + 10, k + 10, k + 11, k + 10, k + 11, k + 11, k + 10, k + 11, k + 10, k + 10)
    rings = F.when(k % 2 == 1, F.concat(outer, F.lit(","), hole)).otherwise(outer)
    poly = F.concat(F.lit("["), rings, F.lit("]"))
    text = (F.when(k % 10 == 0, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), poly,
                                         F.lit(",["), island, F.lit("]]}")))
             .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), poly, F.lit("}"))))
    return (nation.where(k != NO_GEOMETRY_KEY)
            .select(k.cast("string").alias("LocationID"), text.alias("geojson")))


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a revenue fact: order_id, customer_id, order_date and
    revenue as DECIMAL(12,2) (money is summed as decimals, exactly)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        to_decimal("o_totalprice", 12, 2).alias("revenue"),
    )


def customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with segment and region name (nation and region are tiny)."""
    nation = dimension(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = dimension(table(spark, sf_dir, "region"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return (c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
             .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_mktsegment").alias("customer_segment"),
                     F.col("r_name").alias("customer_region")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the documented cleaning pattern's raw input."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
    )


def _source_version() -> str:
    import hashlib
    import inspect
    import sys
    return hashlib.sha256(inspect.getsource(sys.modules[__name__]).encode()).hexdigest()[:16]


# Changes whenever this module changes, so landed projections are rebuilt
# (layout revision 2: raw trips clustered by pickup time).
VERSION = _source_version()
