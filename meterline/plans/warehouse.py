"""The model graph (raw -> stg -> fct / mart / dims) over one set of sources.

``TripWarehouse`` wires the model functions together lazily; nothing runs
until an action. Parameters (date window, passenger bound, tolerance) keep
the reference's values unless given.
"""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline import bindings, defaults as D
from meterline.operators import models
from meterline.sources import seeds
from meterline.sources.files import ingest_csv, ingest_parquet
from meterline.sources.geometry import read_zone_geojson, zone_geometry_from_geojson
from meterline.sources.shapefile import read_zone_shapefile
from meterline.sources.raw_layer import landed
from meterline.sources.sinks import create_namespaces, full_refresh_table, schema_name


# Declared schema of the zone lookup CSV (no type inference in production).
ZONES_CSV_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
# Raw trip columns and types; used to unify monthly files whose physical
# types differ (``from_files(..., unify_types=True)``).
RAW_TRIPS_SCHEMA = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
    "passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE, store_and_fwd_flag STRING, "
    "PULocationID INT, DOLocationID INT, payment_type BIGINT, fare_amount DOUBLE, extra DOUBLE, "
    "mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE, "
    "total_amount DOUBLE, congestion_surcharge DOUBLE, airport_fee DOUBLE")


@dataclass
class TripWarehouse:
    spark: SparkSession
    raw_trips_fn: Callable[[], DataFrame]
    raw_zones_fn: Callable[[], DataFrame]
    zone_geojson_fn: Callable[[], DataFrame] | None = None
    zone_shapes_fn: Callable[[], DataFrame] | None = None  # polygons read as such, instead of GeoJSON text
    date_min: dt.date = D.FACT_DATE_MIN
    date_max: dt.date = D.FACT_DATE_MAX
    max_passengers: int = D.MAX_PASSENGERS
    tolerance: float = D.TOTAL_MISMATCH_TOLERANCE
    _memo: dict = field(default_factory=dict, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, land: bool = True, **params) -> "TripWarehouse":
        """Sources projected from the driver's tables; test date window by default.

        With ``land`` the raw projections are ingested once into the raw
        layer (``sources.raw_layer``) and every model reads that Parquet,
        as the reference's models read its raw database."""
        params.setdefault("date_min", bindings.TEST_DATE_MIN)
        params.setdefault("date_max", bindings.TEST_DATE_MAX)
        if land:
            v = bindings.VERSION
            trips = lambda: landed(spark, "raw_taxi_trips", bindings.raw_trips(spark, sf_dir), v,
                                   cluster_by=["tpep_pickup_datetime"])
            zones = lambda: landed(spark, "raw_taxi_zones", bindings.raw_zones(spark, sf_dir), v)
        else:
            trips = lambda: bindings.raw_trips(spark, sf_dir)
            zones = lambda: bindings.raw_zones(spark, sf_dir)
        return cls(spark, raw_trips_fn=trips, raw_zones_fn=zones,
                   zone_geojson_fn=lambda: bindings.zone_geojson(spark, sf_dir), **params)

    @classmethod
    def from_files(cls, spark: SparkSession, trips_glob: str, zones_csv: str,
                   zones_geojson: str | None = None, ingested_at: dt.datetime | None = None,
                   zones_schema: str | None = ZONES_CSV_SCHEMA, merge_schema: bool = False,
                   unify_types: bool = False, **params) -> "TripWarehouse":
        """Sources from files: monthly trip Parquet (a glob), the zone lookup
        CSV and, optionally, zone boundaries as a GeoJSON FeatureCollection, as
        Features line by line (see ``read_zone_geojson``) or as a shapefile (a
        path that ends in ``.shp``, with an attribute ``LocationID``).
        ``unify_types`` reads the trips as ``RAW_TRIPS_SCHEMA`` when monthly
        files disagree on physical types. Missing inputs raise
        FileNotFoundError when the warehouse is built."""
        trips = ingest_parquet(spark, trips_glob, ingested_at, merge_schema=merge_schema,
                               schema=RAW_TRIPS_SCHEMA if unify_types else None)
        zones = ingest_csv(spark, zones_csv, zones_schema, ingested_at)
        geo = shapes = None
        if zones_geojson and zones_geojson.lower().endswith(".shp"):
            shapes = lambda: read_zone_shapefile(spark, zones_geojson)
        elif zones_geojson:
            geo = lambda: read_zone_geojson(spark, zones_geojson)
        return cls(spark, raw_trips_fn=lambda: trips, raw_zones_fn=lambda: zones, zone_geojson_fn=geo, zone_shapes_fn=shapes, **params)

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:  # re-entrant: models build on each other
            if name not in self._memo:
                self._memo[name] = build()
            return self._memo[name]

    # raw layer
    def raw_trips(self) -> DataFrame:
        return self._get("raw_trips", self.raw_trips_fn)

    def raw_zones(self) -> DataFrame:
        return self._get("raw_zones", self.raw_zones_fn)

    # seeds
    def dim_vendor(self) -> DataFrame:
        return self._get("dim_vendor", lambda: seeds.dim_vendor(self.spark))

    def dim_rate_code(self) -> DataFrame:
        return self._get("dim_rate_code", lambda: seeds.dim_rate_code(self.spark))

    def dim_payment_type(self) -> DataFrame:
        return self._get("dim_payment_type", lambda: seeds.dim_payment_type(self.spark))

    # staging views
    def stg_trips(self) -> DataFrame:
        return self._get("stg_trips", lambda: models.stg_trips(self.raw_trips()))

    def stg_zones(self) -> DataFrame:
        return self._get("stg_zones", lambda: models.stg_zones(self.raw_zones()))

    # marts
    def fct_trips(self) -> DataFrame:
        return self._get("fct_trips", lambda: models.fct_trips(
            self.stg_trips(), self.stg_zones(), self.dim_vendor(), self.dim_rate_code(),
            self.dim_payment_type(), self.date_min, self.date_max, self.max_passengers,
            self.tolerance))

    def mart_trips(self) -> DataFrame:
        return self._get("mart_trips", lambda: models.mart_trips(
            self.stg_trips(), self.date_min, self.date_max, self.tolerance))

    def zone_geometry(self) -> DataFrame:
        return self._get("zone_geometry", self.zone_shapes_fn or (lambda: zone_geometry_from_geojson(self.zone_geojson_fn())))

    def register_views(self) -> list[str]:
        """Make the models queryable by name in SQL (temporary views; lazy, so
        only what a query reads is computed). Returns the names."""
        models_by_name = {
            "stg_taxi_trips": self.stg_trips, "stg_taxi_zones": self.stg_zones, "fct_taxi_trips": self.fct_trips, "mart_taxi_trips": self.mart_trips,
            "dim_vendor": self.dim_vendor, "dim_rate_code": self.dim_rate_code, "dim_payment_type": self.dim_payment_type,
            **({"dim_taxi_zones_geospatial": self.dim_zones_geo} if self.zone_geojson_fn else {})}
        for name, build in models_by_name.items():
            build().createOrReplaceTempView(name)
        return list(models_by_name)

    def publish_tables(self, target: str = "main") -> dict[str, str]:
        """Write the table models as catalog tables (the mart in the namespace
        ``<target>_mart``) and register the staging views: {model: table}."""
        mart = schema_name(target, "mart")
        create_namespaces(self.spark, [target, mart])
        part = ["pickup_year", "pickup_month"]
        out = {}
        for name, df, namespace, by in (
                ("dim_vendor", self.dim_vendor(), target, None), ("dim_rate_code", self.dim_rate_code(), target, None),
                ("dim_payment_type", self.dim_payment_type(), target, None), ("fct_taxi_trips", self.fct_trips(), target, part),
                ("mart_taxi_trips", self.mart_trips(), mart, part)):
            out[name] = f"{namespace}.{name}"
            full_refresh_table(df, out[name], by)
        for name, df in (("stg_taxi_trips", self.stg_trips()), ("stg_taxi_zones", self.stg_zones())):
            df.createOrReplaceTempView(name)
        return out

    def dim_zones_geo(self) -> DataFrame:
        if self.zone_geojson_fn is None and self.zone_shapes_fn is None:
            raise ValueError("no zone geometry source configured")
        return self._get("dim_zones_geo", lambda: models_geo.dim_zones_geo(
            self.stg_zones(), self.zone_geometry()))


from meterline.operators import geo_models as models_geo  # noqa: E402
