"""Registered ingest, layer, incremental, streaming and job queries
(S1, S5, S12, R1, D1). Each writes under the shared checkpoint folder
(``spark.checkpoint.dir``) in a fresh sub-folder and returns what it wrote,
read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterline import bindings
from meterline.oracle_sql import SUITE_MODELS, check_sql, xavg, xsum
from meterline.plans.cube_defs import ALL_CUBES
from meterline.plans.cube_queries import r, round_doubles
from meterline.plans.job import metrics_frame, run_job
from meterline.plans.registry import ORACLES, register
from meterline.plans.rollups import PartitionedRollup, finalize
from meterline.plans.trip_queries import wh
from meterline.session import scratch_path
from meterline.sources import files, incremental, load_log
from meterline.sources.sinks import Layer, copy_layer
from meterline.operators import models, profile
from meterline.streaming.ingest import ingest_new_files, read_sink, stream_model

INGESTED_AT = bindings.INGESTED_AT
JOB_TODAY = dt.date(2025, 6, 1)


@register("ingest_trips", oracle="SELECT *, TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at FROM lineitem")
def q_ingest_trips(spark, sf_dir):
    """Every file matching a glob, all columns, plus the ingest stamp."""
    return files.ingest_parquet(spark, f"{sf_dir.rstrip('/')}/lineite*.parquet", INGESTED_AT)


@register("ingest_zones_csv", oracle="SELECT * FROM raw_zones")
def q_ingest_zones_csv(spark, sf_dir):
    """S2 + S4: the zone lookup written as CSV with a header (full refresh),
    then ingested with its declared schema and the ingest stamp."""
    path = scratch_path(spark, "csv") + "/taxi_zone_lookup"
    zones = wh(spark, sf_dir).raw_zones().drop("_ingested_at")
    (zones.write.mode("overwrite").option("header", True)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return files.ingest_csv(spark, path, "LocationID INT, Zone STRING, Borough STRING, service_zone STRING",
                            INGESTED_AT)


@register("ingest_events_json",
          oracle="SELECT *, TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at FROM events")
def q_ingest_events_json(spark, sf_dir):
    """Events written as JSON lines, ingested with their declared schema."""
    path = scratch_path(spark, "json") + "/events"
    events = bindings.table(spark, sf_dir, "events")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events.write.mode("overwrite").option("timestampNTZFormat", fmt).json(path)
    return files.ingest_json(spark, path, events.schema, INGESTED_AT, timestamp_ntz_format=fmt)


@register("copy_layer_trips", oracle="SELECT * FROM raw_trips")
def q_copy_layer_trips(spark, sf_dir):
    """Raw trips written to the raw layer, copied to dev, read back from dev."""
    base = scratch_path(spark, "layers")
    raw, dev = Layer("raw", base), Layer("dev", base)
    raw.write(wh(spark, sf_dir).raw_trips(), "nyc_taxi_data", "raw_taxi_trips")
    return copy_layer(spark, raw, dev, "nyc_taxi_data", ["raw_taxi_trips"])["raw_taxi_trips"]


@register("incremental_events", oracle="SELECT * FROM events")
def q_incremental_events(spark, sf_dir):
    """First load before the split, then an append past the high-water mark."""
    target = scratch_path(spark, "incremental") + "/events"
    events = bindings.table(spark, sf_dir, "events")
    events.where(F.col("ts") < F.lit(bindings.EVENT_SPLIT)).write.mode("overwrite").parquet(target)
    incremental.incremental_append(spark, events, target, "ts")
    return spark.read.parquet(target)


@register("stream_ingest_events", oracle="SELECT * FROM events")
def q_stream_ingest_events(spark, sf_dir):
    """Two arrivals of files, two availableNow runs; each row lands once."""
    root = scratch_path(spark, "stream")
    landing, sink, ckpt = f"{root}/landing", f"{root}/sink", f"{root}/_checkpoint"
    events = bindings.table(spark, sf_dir, "events")
    schema = events.schema
    before = F.col("ts") < F.lit(bindings.EVENT_SPLIT)
    events.where(before).write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, schema, sink, ckpt)
    events.where(~before | F.col("ts").isNull()).write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, schema, sink, ckpt)
    return read_sink(spark, sink)


FCT_SPLIT = "1998-06-01 00:00:00"


def _fct_builder(w):
    """raw trips -> fct_trips with the warehouse's dimensions and parameters."""
    def build(raw):
        return models.fct_trips(models.stg_trips(raw), w.stg_zones(), w.dim_vendor(), w.dim_rate_code(),
                                w.dim_payment_type(), w.date_min, w.date_max, w.max_passengers, w.tolerance)
    return build


@register("incremental_fct_trips", oracle="SELECT * FROM fct_trips")
def q_incremental_fct_trips(spark, sf_dir):
    """Incremental mart: the fact built from trips before a date, then extended
    past its high-water mark from the full raw table; equals the full build."""
    w = wh(spark, sf_dir)
    build, raw = _fct_builder(w), w.raw_trips()
    target = scratch_path(spark, "incremental_fct") + "/fct_taxi_trips"
    part = ["pickup_year", "pickup_month"]
    first = raw.where(F.col("tpep_pickup_datetime") < F.lit(FCT_SPLIT).cast("timestamp_ntz"))
    incremental.incremental_model(spark, first, build, target, "tpep_pickup_datetime", part)
    incremental.incremental_model(spark, raw, build, target, "tpep_pickup_datetime", part)
    return incremental.read_model(spark, target, w.fct_trips().schema)


@register("incremental_late_fct", oracle="SELECT * FROM fct_trips")
def q_incremental_late_fct(spark, sf_dir):
    """Two arrivals of trip files; the second holds trips before, at and after
    the mark and trips without a time. The load log finds the months they touch, only
    these are rebuilt, and the fact equals the full build. A third load finds nothing to do."""
    w = wh(spark, sf_dir)
    raw, ts = w.raw_trips(), F.col("tpep_pickup_datetime")
    root = scratch_path(spark, "late_fct")
    source, target, log = f"{root}/source", f"{root}/fct_taxi_trips", f"{root}/load_log"
    first = (ts < F.lit(FCT_SPLIT).cast("timestamp_ntz")) & (F.second(ts) % 7 != 0)
    part = ("pickup_year", "pickup_month")
    for rows in (raw.where(first), raw.where(~first).unionByName(raw.where("PULocationID = 5").withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz"))), None):
        if rows is not None:
            rows.write.mode("append").parquet(source)
        load_log.load_months(spark, source, raw.schema, _fct_builder(w), target, log, "tpep_pickup_datetime", part)
    return incremental.read_model(spark, target, w.fct_trips().schema)


@register("freshness_partitions", oracle="""
SELECT pickup_year, pickup_month, CAST(COUNT(*) AS BIGINT) AS row_count, MAX(tpep_pickup_datetime) AS latest_at,
       date_diff('hour', MAX(tpep_pickup_datetime), TIMESTAMP '2000-06-01 00:00:00') AS lag_hours,
       date_diff('hour', MAX(tpep_pickup_datetime), TIMESTAMP '2000-06-01 00:00:00') <= 20000 AS is_fresh, true AS has_arrived
FROM fct_trips GROUP BY 1, 2""")
def q_freshness_partitions(spark, sf_dir):
    """A12 by partition: the fact written by month; events are held against a fixed
    time, the files' arrival against the query's start."""
    w, target = wh(spark, sf_dir), scratch_path(spark, "freshness") + "/fct_taxi_trips"
    fct = w.fct_trips()
    fct.hint("rebalance", "pickup_year", "pickup_month").write.partitionBy("pickup_year", "pickup_month").parquet(target)
    out = profile.partition_freshness(incremental.read_model(spark, target, fct.schema), ["pickup_year", "pickup_month"], "tpep_pickup_datetime",
                                      dt.datetime(2000, 6, 1), max_lag_hours=20000, max_arrival_hours=24)
    return out.drop("file_count", "arrived_at", "arrival_lag_hours")


@register("rollup_incremental", oracle=f"""
SELECT payment_name AS TaxiTrips_paymentMethod, pickup_borough AS TaxiTrips_pickupBorough,
       CAST(COUNT(*) AS BIGINT) AS TaxiTrips_tripCount, {r(xsum('total_amount'))} AS TaxiTrips_totalRevenueCharged,
       {r(xsum('tip_amount'))} AS TaxiTrips_totalTips, {r(xavg('tip_amount'))} AS TaxiTrips_avgTipAmount
FROM fct_trips GROUP BY 1, 2""")
def q_rollup_incremental(spark, sf_dir):
    """A rollup refreshed after each of three loads of the fact, in the
    months that the load touched; the second refresh comes twice. Equals the rebuilt rollup."""
    w = wh(spark, sf_dir)
    raw, schema = w.raw_trips(), w.fct_trips().schema
    root = scratch_path(spark, "rollup_incremental")
    source, target, log, part = f"{root}/source", f"{root}/fct_taxi_trips", f"{root}/load_log", ("pickup_year", "pickup_month")
    rollup = PartitionedRollup(spark, ALL_CUBES, "TaxiTrips", "paymentAnalysis", f"{root}/rollup", part)
    arrival = F.when(F.col("tpep_pickup_datetime") < F.lit(FCT_SPLIT).cast("timestamp_ntz"), F.second("tpep_pickup_datetime") % 2).otherwise(2)
    for i in range(3):
        raw.where(arrival == i).write.mode("append").parquet(source)
        done = load_log.load_months(spark, source, raw.schema, _fct_builder(w), target, log, "tpep_pickup_datetime", part)
        tables = {"fct_taxi_trips": incremental.read_model(spark, target, schema)}
        for _ in range(2 if i == 1 else 1):
            rollup.refresh(done.batch, tables, done.months)
    return round_doubles(finalize(rollup.table(), ALL_CUBES, "TaxiTrips", "paymentAnalysis"))


@register("stream_fct_trips", oracle="SELECT * FROM fct_trips")
def q_stream_fct_trips(spark, sf_dir):
    """Streaming incremental mart: raw trip files arrive in two drops; a file
    stream builds the fact from each new batch (stream-static broadcast joins)."""
    w = wh(spark, sf_dir)
    raw = w.raw_trips()
    root = scratch_path(spark, "stream_fct")
    landing, sink, ckpt = f"{root}/landing", f"{root}/sink", f"{root}/_checkpoint"
    early = F.col("tpep_pickup_datetime") < F.lit(FCT_SPLIT).cast("timestamp_ntz")
    part = ["pickup_year", "pickup_month"]
    raw.where(early).write.mode("append").parquet(landing)
    stream_model(spark, landing, raw.schema, _fct_builder(w), sink, ckpt, part)
    raw.where(~early | F.col("tpep_pickup_datetime").isNull()).write.mode("append").parquet(landing)
    stream_model(spark, landing, raw.schema, _fct_builder(w), sink, ckpt, part)
    return incremental.read_model(spark, sink, w.fct_trips().schema)


@register("job_report")
def q_job_report(spark, sf_dir):
    """The whole job on the projected sources; its metrics as rows."""
    res = run_job(spark, wh(spark, sf_dir), scratch_path(spark, "job"), today=JOB_TODAY,
                  pickup_date_floor=bindings.TEST_DATE_MIN)
    return metrics_frame(spark, res)


def register_oracles() -> None:
    from meterline.operators.quality import reference_suite
    from meterline.oracle_sql import with_base
    checks = reference_suite(pickup_date_floor=bindings.TEST_DATE_MIN, today=JOB_TODAY)
    suite = " UNION ALL ".join(check_sql(c) for c in checks)
    status = ("CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END")
    nulls = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"]
    parts = ["SELECT 'raw_validation' AS step, 'raw_trips' AS metric, CAST(COUNT(*) AS BIGINT) AS value FROM raw_trips",
             "SELECT 'raw_validation', 'raw_zones', CAST(COUNT(*) AS BIGINT) FROM raw_zones"]
    parts += [f"SELECT 'raw_validation', 'null_{c}', CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM raw_trips"
              for c in nulls]
    parts += [f"SELECT 'tests', 'tests_{s}', CAST(COUNT(*) FILTER (WHERE st = '{s}') AS BIGINT) "
              f"FROM (SELECT {status} AS st FROM ({suite}))" for s in ("pass", "warn", "fail")]
    parts += ["SELECT 'analytics_validation', 'fct_trips_rows', CAST(COUNT(*) AS BIGINT) FROM fct_trips",
              "SELECT 'analytics_validation', 'mart_trips_rows', CAST(COUNT(*) AS BIGINT) FROM mart_trips",
              "SELECT 'analytics_validation', 'total_mismatches', CAST(SUM(total_amount_mismatch_flag) AS BIGINT) FROM fct_trips",
              "SELECT 'analytics_validation', 'negative_durations', CAST(SUM(negative_duration_flag) AS BIGINT) FROM fct_trips",
              "SELECT 'analytics_validation', 'pickup_boroughs', CAST(COUNT(DISTINCT pickup_borough) AS BIGINT) FROM fct_trips",
              "SELECT 'analytics_validation', 'dropoff_boroughs', CAST(COUNT(DISTINCT dropoff_borough) AS BIGINT) FROM fct_trips"]
    ORACLES["job_report"] = with_base("\nUNION ALL\n".join(parts))


assert SUITE_MODELS
