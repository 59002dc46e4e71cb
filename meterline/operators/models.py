"""Staging, fact and mart models (raw -> stg -> fct / mart), as lazy DataFrames.

A "view" model is a lazy DataFrame; a "table" model is the same DataFrame
written with ``meterline.sources.sinks.full_refresh``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import defaults as D
from meterline.functions.columns import (
    as_decimal_2, day_of_week_sunday0, flag, guarded_ratio, minute_boundaries, null_safe_sum,
    key_form,
)
from meterline.functions.joins import is_literal, key_is_unique, literal_dimension, lookup, one_per_key

# Fare components of the calculated total (the tip is deliberately left out).
FARE_COMPONENTS = ["fare_amount", "extra", "mta_tax", "improvement_surcharge",
                   "tolls_amount", "congestion_surcharge", "airport_fee"]
PASSTHROUGH = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
               "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
               "airport_fee", "store_and_fwd_flag"]
ID_COLUMNS = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type"]


def calculated_total(prefix: str = "") -> F.Column:
    return as_decimal_2(null_safe_sum(*[prefix + c for c in FARE_COMPONENTS]))


def stg_trips(raw: DataFrame, pickup_col: str = "tpep_pickup_datetime",
              dropoff_col: str = "tpep_dropoff_datetime") -> DataFrame:
    """Typed trips: text ids, zone-less timestamps, calculated total, duration
    in minute boundaries and pickup date parts."""
    pickup = F.col(pickup_col).cast("timestamp_ntz")
    dropoff = F.col(dropoff_col).cast("timestamp_ntz")
    return raw.select(
        *[F.col(c).cast("string").alias(c) for c in ID_COLUMNS],
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        *PASSTHROUGH,
        calculated_total().alias("calculated_total_amount"),
        minute_boundaries(pickup, dropoff).alias("trip_duration_minutes"),
        F.to_date(pickup).alias("pickup_date"),
        F.year(pickup).cast("bigint").alias("pickup_year"),
        F.month(pickup).cast("bigint").alias("pickup_month"),
        day_of_week_sunday0(pickup).alias("pickup_day_of_week"),
        F.hour(pickup).cast("bigint").alias("pickup_hour"),
        "_ingested_at",
    )


def stg_zones(raw: DataFrame) -> DataFrame:
    """Zones with a text id and trimmed names."""
    return raw.select(
        F.col("LocationID").cast("string").alias("LocationID"),
        F.trim("Zone").alias("Zone"),
        F.trim("Borough").alias("Borough"),
        F.col("service_zone").cast("string").alias("service_zone"),
        "_ingested_at",
    )


def fare_ratios() -> list[F.Column]:
    """Fare per mile and per minute, 0 when the divisor is not positive."""
    return [guarded_ratio("fare_amount", "trip_distance").alias("fare_per_mile"),
            guarded_ratio("fare_amount", "trip_duration_minutes").alias("fare_per_minute")]


def mismatch_flag(tolerance: float = D.TOTAL_MISMATCH_TOLERANCE) -> F.Column:
    diff = F.abs(F.col("total_amount") - F.col("calculated_total_amount"))
    return flag(diff > F.lit(tolerance)).alias("total_amount_mismatch_flag")


def pickup_window(date_min: dt.date, date_max: dt.date) -> F.Column:
    """pickup_date in [date_min, date_max], plus the same bound on the raw
    timestamp so the predicate reaches the Parquet scan / partition filter."""
    lo = dt.datetime.combine(date_min, dt.time())
    hi = dt.datetime.combine(date_max + dt.timedelta(days=1), dt.time())
    ts = F.col("tpep_pickup_datetime")
    return ((F.col("pickup_date") >= F.lit(date_min)) & (F.col("pickup_date") <= F.lit(date_max))
            & (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))


def fact_filter(date_min: dt.date = D.FACT_DATE_MIN, date_max: dt.date = D.FACT_DATE_MAX,
                max_passengers: int | None = D.MAX_PASSENGERS) -> F.Column:
    """Fact filter: date window, non-negative distance and fare, 0 < passengers
    (<= max_passengers when given). NULL operands drop the row."""
    cond = (pickup_window(date_min, date_max) & (F.col("trip_distance") >= 0)
            & (F.col("fare_amount") >= 0) & (F.col("passenger_count") > 0))
    if max_passengers is not None:
        cond = cond & (F.col("passenger_count") <= max_passengers)
    return cond


def _zone_role(zones: DataFrame, role: str) -> DataFrame:
    return zones.select(F.col("LocationID").alias(f"{role}_LocationID"),
                        F.col("Zone").alias(f"{role}_zone"),
                        F.col("Borough").alias(f"{role}_borough"),
                        F.col("service_zone").alias(f"{role}_service_zone"))


def lookup_joins(trips: DataFrame, vendor: DataFrame, rate_code: DataFrame,
                 payment: DataFrame) -> DataFrame:
    """Left lookups of the three seeds on text ids (broadcast: literal rows).
    A text id against a numeric key compares as an exact decimal."""
    out = trips
    for dim, key, name, col in ((vendor, "vendor_id", "vendor_name", "VendorID"), (rate_code, "rate_code_id", "rate_code_name", "RatecodeID"),
                                (payment, "payment_type", "payment_name", "payment_type")):
        form, on = key_form(dim.schema[key].dataType), f"_{name}_key"
        d = dim.select(form(F.col(key)).alias(on), name)
        if not is_literal(dim):
            d = lookup(d, on)
        elif key_is_unique(d, key, literal=dim):
            d = literal_dimension(one_per_key(d.coalesce(1), on))  # one partition: the grouping needs no exchange
        else:
            d = literal_dimension(d)
        out = out.join(d, form(out[col]) == d[on], "left").drop(on)
    return out


def zone_role_join(trips: DataFrame, zones: DataFrame, max_rows: int = D.BROADCAST_MAX_ROWS) -> DataFrame:
    """Join the zone dimension twice: once as pickup, once as dropoff zone. A zone
    id that occurs twice doubles its trips (the ``unique`` check reports it)."""
    zone = lookup(zones.select("LocationID", "Zone", "Borough", "service_zone"), "LocationID", max_rows)
    pu, do = (_zone_role(zone, role) for role in ("pickup", "dropoff"))
    out = trips.join(pu, trips.PULocationID == pu.pickup_LocationID, "left")
    out = out.join(do, out.DOLocationID == do.dropoff_LocationID, "left")
    return out.drop("pickup_LocationID", "dropoff_LocationID")


STG_FACT_COLUMNS = ID_COLUMNS + ["tpep_pickup_datetime", "tpep_dropoff_datetime"] + PASSTHROUGH + [
    "calculated_total_amount", "trip_duration_minutes", "pickup_date", "pickup_year",
    "pickup_month", "pickup_day_of_week", "pickup_hour"]
DIM_FACT_COLUMNS = ["vendor_name", "rate_code_name", "payment_name",
                    "pickup_zone", "pickup_borough", "pickup_service_zone",
                    "dropoff_zone", "dropoff_borough", "dropoff_service_zone"]


def fct_trips(stg: DataFrame, zones: DataFrame, vendor: DataFrame, rate_code: DataFrame,
              payment: DataFrame, date_min: dt.date = D.FACT_DATE_MIN,
              date_max: dt.date = D.FACT_DATE_MAX, max_passengers: int = D.MAX_PASSENGERS,
              tolerance: float = D.TOTAL_MISMATCH_TOLERANCE) -> DataFrame:
    """Trip fact: staged trips with lookup names, both zone roles, fare ratios
    and three quality flags, filtered to valid rows.

    The filter only touches trip columns, so Catalyst applies it below the
    (broadcast) joins; the fact is never shuffled."""
    t = stg.where(fact_filter(date_min, date_max, max_passengers))
    t = lookup_joins(t, vendor, rate_code, payment)
    t = zone_role_join(t, zones)
    return t.select(
        *STG_FACT_COLUMNS, *DIM_FACT_COLUMNS,
        *fare_ratios(),
        flag(F.col("VendorID").isNull()).alias("missing_vendor_flag"),
        flag(F.col("trip_duration_minutes") <= 0).alias("negative_duration_flag"),
        mismatch_flag(tolerance),
        "_ingested_at",
    )


MART_RENAMES = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
                "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
MART_COLUMNS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
                "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
                "congestion_surcharge", "airport_fee", "payment_type", "calculated_total_amount",
                "trip_duration_minutes", "pickup_date", "pickup_year", "pickup_month",
                "pickup_day_of_week", "pickup_hour", "RatecodeID", "store_and_fwd_flag"]


def mart_trips(stg: DataFrame, date_min: dt.date = D.FACT_DATE_MIN, date_max: dt.date = D.FACT_DATE_MAX,
               tolerance: float = D.TOTAL_MISMATCH_TOLERANCE) -> DataFrame:
    """Analysis mart: renamed staged trips with ratios and flags, no joins.
    Its duration flag is ``< 0`` (the fact's is ``<= 0``) and it has no
    passenger upper bound."""
    t = stg.where(fact_filter(date_min, date_max, max_passengers=None))
    return t.select(
        *[F.col(c).alias(MART_RENAMES.get(c, c)) for c in MART_COLUMNS],
        *fare_ratios(),
        flag(F.col("trip_duration_minutes") < 0).alias("negative_duration_flag"),
        mismatch_flag(tolerance),
        "_ingested_at",
    )


def clean_orders(raw: DataFrame, key: str = "customer_id", unknown: str = "UNKNOWN") -> DataFrame:
    """Documented cleaning pattern: text id, default key, date cast, amount
    to DECIMAL(10,2) rounded to cents, rows without a date dropped."""
    return raw.where(F.col("order_date").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.coalesce(F.col(key).cast("string"), F.lit(unknown)).alias(key),
        F.col("order_date").cast("date").alias("order_date"),
        F.round(as_decimal_2("order_amount"), 2).cast("decimal(10,2)").alias("order_amount"),
    )
