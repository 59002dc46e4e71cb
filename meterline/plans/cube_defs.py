"""The reference's cube definitions, as data.

Table keys: ``raw_taxi_trips``, ``raw_taxi_zones``, ``stg_taxi_trips``,
``fct_taxi_trips``, ``dim_taxi_zones_geospatial``, ``dim_vendor``,
``dim_rate_code``, ``dim_payment_type``.
"""

from __future__ import annotations

from meterline.plans.cubes import Cube, CubeSet, Dimension as Dm, Join, LazyTables, Measure as Ms, PreAggregation

# Decimals that money columns carry at most: their sums are exact.
MONEY = 6

# Cube, member and column names, member types and joins of the
# reference's semantic layer (live cubes first, then the kept-but-unmounted set).
RAW_TAXI_TRIPS = Cube("raw_taxi_trips", "raw_taxi_trips",
    dimensions=(Dm("store_and_fwd_flag", "store_and_fwd_flag", "string"),
                Dm("tpep_dropoff_datetime", "tpep_dropoff_datetime", "time"),
                Dm("tpep_pickup_datetime", "tpep_pickup_datetime", "time")),
    measures=(Ms("count", "count"),
              Ms("fare_amount", "sum", "fare_amount", scale=MONEY),
              Ms("passenger_count", "sum", "passenger_count"),
              Ms("tip_amount", "sum", "tip_amount", scale=MONEY),
              Ms("tolls_amount", "sum", "tolls_amount", scale=MONEY),
              Ms("total_amount", "sum", "total_amount", scale=MONEY)))

RAW_TAXI_ZONES = Cube("raw_taxi_zones", "raw_taxi_zones",
    dimensions=(Dm("borough", "Borough", "string"),
                Dm("service_zone", "service_zone", "string"),
                Dm("zone", "Zone", "string")),
    measures=(Ms("count", "count"),))

FCT_TAXI_TRIPS = Cube("fct_taxi_trips", "fct_taxi_trips", measures=(Ms("count", "count"),))

TAXI_TRIPS = Cube("TaxiTrips", "fct_taxi_trips", title="NYC Yellow Taxi Trips",
    month_partitions=(("tpep_pickup_datetime", ("pickup_year", "pickup_month")),),
    joins=(Join("VendorDim", "VendorDim", "VendorID", "vendor_id"),
           Join("PaymentTypeDim", "PaymentTypeDim", "payment_type", "payment_type"),
           Join("RateCodeDim", "RateCodeDim", "RatecodeID", "rate_code_id"),
           Join("PickupZone", "TaxiZones", "PULocationID", "LocationID"),
           Join("DropoffZone", "TaxiZones", "DOLocationID", "LocationID")),
    dimensions=(Dm("vendorId", "VendorID"), Dm("vendorName", "vendor_name"),
                Dm("rateCodeId", "RatecodeID"), Dm("rateCodeName", "rate_code_name"),
                Dm("paymentTypeId", "payment_type"), Dm("paymentMethod", "payment_name"),
                Dm("pickupDatetime", "tpep_pickup_datetime", "time"),
                Dm("dropoffDatetime", "tpep_dropoff_datetime", "time"),
                Dm("pickupLocationId", "PULocationID"), Dm("pickupZone", "pickup_zone"),
                Dm("pickupBorough", "pickup_borough"),
                Dm("dropoffLocationId", "DOLocationID"), Dm("dropoffZone", "dropoff_zone"),
                Dm("dropoffBorough", "dropoff_borough"),
                Dm("passengerCount", "passenger_count", "number"),
                Dm("tripDistanceMiles", "trip_distance", "number", format="#,##0.00"),
                Dm("storeAndForwardFlag", "store_and_fwd_flag"),
                Dm("pickupDate", "pickup_date", "time"),
                Dm("pickupHour", "pickup_hour", "number"),
                Dm("pickupDayOfWeek", "pickup_day_of_week", "number")),
    measures=(Ms("tripCount", "count"),
              Ms("totalPassengers", "sum", "passenger_count"),
              Ms("totalMilesTraveled", "sum", "trip_distance", format="#,##0.0"),
              Ms("avgTripDistance", "avg", "trip_distance", format="#,##0.00"),
              Ms("totalFareAmount", "sum", "fare_amount", scale=MONEY, format="$#,##0.00"),
              Ms("avgFareAmount", "avg", "fare_amount", scale=MONEY, format="$#,##0.00"),
              Ms("totalTips", "sum", "tip_amount", scale=MONEY, format="$#,##0.00"),
              Ms("avgTipAmount", "avg", "tip_amount", scale=MONEY, format="$#,##0.00"),
              Ms("totalRevenueCharged", "sum", "total_amount", scale=MONEY, format="$#,##0.00"),
              Ms("avgRevenuePerTrip", "avg", "total_amount", scale=MONEY, format="$#,##0.00"),
              Ms("totalMtaTax", "sum", "mta_tax", scale=MONEY, format="$#,##0.00"),
              Ms("totalImprovementSurcharge", "sum", "improvement_surcharge", scale=MONEY, format="$#,##0.00"),
              Ms("totalCongestionSurcharge", "sum", "congestion_surcharge", scale=MONEY, format="$#,##0.00"),
              Ms("totalAirportFees", "sum", "airport_fee", scale=MONEY, format="$#,##0.00"),
              Ms("totalExtrasAndSurcharges", "sum", "extra", scale=MONEY, format="$#,##0.00"),
              Ms("totalTolls", "sum", "tolls_amount", scale=MONEY, format="$#,##0.00"),
              Ms("avgFarePerMile", "avg", "fare_per_mile", format="$#,##0.00"),
              Ms("avgTripDurationMinutes", "avg", "trip_duration_minutes", format="#,##0.0 min")),
    pre_aggregations=(
        PreAggregation("dailyOperations",
                       ("tripCount", "totalRevenueCharged", "totalMilesTraveled", "avgFareAmount"),
                       ("pickupDate", "pickupBorough", "vendorName"),
                       time_dimension="pickupDatetime", granularity="day"),
        PreAggregation("paymentAnalysis",
                       ("tripCount", "totalRevenueCharged", "totalTips", "avgTipAmount"),
                       ("paymentMethod", "pickupBorough"), refresh_every="4 hours"),
        PreAggregation("tripFlow",
                       ("tripCount", "avgFareAmount", "avgTripDistance"),
                       ("pickupZone", "dropoffZone", "pickupBorough", "dropoffBorough"),
                       refresh_every="6 hours")))

TAXI_ZONES = Cube("TaxiZones", "dim_taxi_zones_geospatial", title="NYC TLC Taxi Zones",
    dimensions=(Dm("locationId", "LocationID", primary_key=True), Dm("zoneName", "Zone"),
                Dm("borough", "Borough"), Dm("serviceZone", "service_zone"),
                Dm("zoneAreaSqMeters", "zone_area_sq_meters", "number", format="#,##0"),
                Dm("centroidLongitude", "zone_centroid_longitude", "number", format="#,##0.000000"),
                Dm("centroidLatitude", "zone_centroid_latitude", "number", format="#,##0.000000"),
                Dm("geometryWkt", "geometry_wkt"), Dm("geometryGeoJson", "geometry_geojson")),
    measures=(Ms("totalZones", "count"),
              Ms("totalCoverageArea", "sum", "zone_area_sq_meters", format="#,##0"),
              Ms("avgZoneArea", "avg", "zone_area_sq_meters", format="#,##0")),
    pre_aggregations=(PreAggregation("boroughSummary", ("totalZones", "totalCoverageArea", "avgZoneArea"),
                                     ("borough", "serviceZone"), refresh_every="24 hours"),))

VENDOR_DIM = Cube("VendorDim", "dim_vendor",
    dimensions=(Dm("vendorId", "vendor_id", primary_key=True), Dm("vendorName", "vendor_name"),
                Dm("vendorDescription", "vendor_description")),
    measures=(Ms("vendorCount", "count"),))

RATE_CODE_DIM = Cube("RateCodeDim", "dim_rate_code",
    dimensions=(Dm("rateCodeId", "rate_code_id", primary_key=True), Dm("rateCodeName", "rate_code_name"),
                Dm("rateCodeDescription", "rate_code_description")),
    measures=(Ms("rateCodeCount", "count"),))

PAYMENT_TYPE_DIM = Cube("PaymentTypeDim", "dim_payment_type",
    dimensions=(Dm("paymentTypeId", "payment_type", primary_key=True), Dm("paymentName", "payment_name"),
                Dm("paymentDescription", "payment_description")),
    measures=(Ms("paymentTypeCount", "count"),))

STAGING_TAXI_TEST = Cube("StagingTaxiTest", "stg_taxi_trips",
    dimensions=(Dm("vendorId", "VendorID"), Dm("pickupZone", "PULocationID"),
                Dm("pickupDate", "pickup_date", "time")),
    measures=(Ms("tripCount", "count"), Ms("avgFare", "avg", "fare_amount", scale=MONEY, format="$#,##0.00"),
              Ms("totalRevenue", "sum", "total_amount", scale=MONEY, format="$#,##0.00")))

ALL_CUBES = CubeSet([RAW_TAXI_TRIPS, RAW_TAXI_ZONES, FCT_TAXI_TRIPS, TAXI_TRIPS, TAXI_ZONES,
                     VENDOR_DIM, RATE_CODE_DIM, PAYMENT_TYPE_DIM, STAGING_TAXI_TEST])


def warehouse_tables(wh) -> "LazyTables":
    """Cube table keys bound to a ``TripWarehouse`` (built on first use)."""
    return LazyTables({
        "raw_taxi_trips": wh.raw_trips, "raw_taxi_zones": wh.raw_zones,
        "stg_taxi_trips": wh.stg_trips, "fct_taxi_trips": wh.fct_trips,
        "dim_taxi_zones_geospatial": wh.dim_zones_geo,
        "dim_vendor": wh.dim_vendor, "dim_rate_code": wh.dim_rate_code,
        "dim_payment_type": wh.dim_payment_type,
    })
