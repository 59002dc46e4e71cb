"""The end-to-end job: ingest -> raw validation -> seeds, models, checks ->
analytics validation. One SparkSession, plain function calls.

Each model is materialized (written and read back) before the next step
reads it, like the reference's table models: later steps scan compact
Parquet instead of re-running joins, and the written tables cut the
lineage, so a lost executor only recomputes from the last written table.
"""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import defaults as D
from meterline.operators import profile, quality
from meterline.plans.warehouse import TripWarehouse
from meterline.sources.sinks import Layer, copy_layer, schema_name

log = logging.getLogger("meterline.job")

SOURCE_SCHEMA = "nyc_taxi_data"


@dataclass
class JobResult:
    metrics: list[tuple[str, str, int]] = field(default_factory=list)
    report: list = field(default_factory=list)
    tables: dict[str, str] = field(default_factory=dict)

    def add(self, step: str, metric: str, value) -> None:
        self.metrics.append((step, metric, None if value is None else int(value)))


def run_job(spark: SparkSession, wh: TripWarehouse, base: str, target: str = "dev",
            today: dt.date | None = None, pickup_date_floor: dt.date = D.PICKUP_DATE_FLOOR,
            distribute: str = "local", copy_raw: bool = False, threads: int = 4) -> JobResult:
    """``distribute``: how the month-partitioned marts are written ("local":
    no shuffle, for month-clustered sources; "rebalance": AQE-balanced shuffle).
    ``copy_raw``: copy the raw tables into the target layer first (the
    reference's behaviour, a full rewrite of the input); by default the models
    read the raw layer directly. Checks whose model or parent is absent (no
    zone boundaries given) appear in the report as ``skipped``."""
    res = JobResult()
    raw, tgt = Layer("raw", base), Layer(target, base)

    # 1. ingest: raw tables, then copy raw -> target layer
    raw.write(wh.raw_trips(), SOURCE_SCHEMA, "raw_taxi_trips")
    raw.write(wh.raw_zones(), SOURCE_SCHEMA, "raw_taxi_zones")
    if copy_raw:
        copied = copy_layer(spark, raw, tgt, SOURCE_SCHEMA, ["raw_taxi_trips", "raw_taxi_zones"])
        trips, zones = copied["raw_taxi_trips"], copied["raw_taxi_zones"]
    else:
        trips = raw.read(spark, SOURCE_SCHEMA, "raw_taxi_trips")
        zones = raw.read(spark, SOURCE_SCHEMA, "raw_taxi_zones")

    # checks of the suite (failures are reported, the run continues)
    checks = quality.reference_suite(pickup_date_floor=pickup_date_floor, today=today)
    mwh = TripWarehouse(spark, raw_trips_fn=lambda: trips, raw_zones_fn=lambda: zones,
                        zone_geojson_fn=wh.zone_geojson_fn, zone_shapes_fn=wh.zone_shapes_fn, date_min=wh.date_min, date_max=wh.date_max,
                        max_passengers=wh.max_passengers, tolerance=wh.tolerance)

    def row_checks(model):
        return [c for c in checks if c.model == model and c.kind in quality.ROW_KINDS]

    # 2. raw validation (load profile, NULL counts) AND every check of the
    # staged trips (row checks, relationships to seeds and zones) from ONE
    # scan of the trips. Measured on the typed staged columns (identical for
    # typed sources such as Parquet; for text sources a value that fails its
    # cast counts as NULL, which the not_null checks report anyway).
    null_cols = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"]
    stg_models = {"stg_taxi_trips": mwh.stg_trips(), "stg_taxi_zones": mwh.stg_zones(),
                  "dim_vendor": mwh.dim_vendor(), "dim_rate_code": mwh.dim_rate_code(),
                  "dim_payment_type": mwh.dim_payment_type()}
    stg_rows = [c for c in row_checks("stg_taxi_trips")]
    stg_rels = [c for c in checks if c.model == "stg_taxi_trips" and c.kind == "relationships"
                and c.args["to"] in stg_models]
    extra_nulls = [c for c in null_cols if not any(ch.kind == "not_null" and ch.column == c for ch in stg_rows)]
    stg_rows += [quality.not_null("stg_taxi_trips", c) for c in extra_nulls]
    stg_report, prof = quality.fused_model_check_values(mwh.stg_trips(), stg_rows, stg_rels, stg_models,
                                                        "tpep_pickup_datetime")
    nulls = {r["column_name"]: r["failures"] for r in stg_report if r["test_type"] == "not_null"}
    stg_report = [r for r in stg_report if not (r["test_type"] == "not_null" and r["column_name"] in extra_nulls)]
    res.add("raw_validation", "raw_trips", prof["total_rows"])
    res.add("raw_validation", "raw_zones", profile.row_count(zones).first()[0])
    for c in null_cols:
        res.add("raw_validation", f"null_{c}", nulls[c])
    log.info("raw trips %s .. %s over %s months", prof["earliest"], prof["latest"], prof["months_covered"])

    # 3. seeds + models in the target layer (stg are views; the rest tables)
    main, mart = "main", schema_name("main", "mart")
    # trips arrive as monthly files, so each input split holds (mostly) one
    # month: write partitions without a shuffle of the fact
    part = ["pickup_year", "pickup_month"]
    # plans are built here, in one thread; only the writes run concurrently
    plans = {n: (getattr(mwh, n)(), main, None) for n in ("dim_vendor", "dim_rate_code", "dim_payment_type")}
    plans["fct_taxi_trips"] = (mwh.fct_trips(), main, part)
    plans["mart_taxi_trips"] = (mwh.mart_trips(), mart, part)
    if wh.zone_geojson_fn or wh.zone_shapes_fn:
        plans["dim_taxi_zones_geospatial"] = (mwh.dim_zones_geo(), main, None)

    def write(name):
        df, schema, partition_by = plans[name]
        return tgt.write(df, schema, name, partition_by=partition_by, distribute=distribute)
    # independent models are written concurrently (Spark runs jobs from
    # several threads side by side); ``threads=1`` writes them one by one
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {name: pool.submit(write, name) for name in plans}
        built = {name: f.result() for name, f in futures.items()}
    seeds = {n: built[n] for n in ("dim_vendor", "dim_rate_code", "dim_payment_type")}
    fct, mart_t, geo = built["fct_taxi_trips"], built["mart_taxi_trips"], built.get("dim_taxi_zones_geospatial")
    res.tables = {"fct_taxi_trips": tgt.path(main, "fct_taxi_trips"),
                  "mart_taxi_trips": tgt.path(mart, "mart_taxi_trips")}
    if geo is not None:
        res.tables["dim_taxi_zones_geospatial"] = tgt.path(main, "dim_taxi_zones_geospatial")

    # 4. checks: the fact's row checks and its quality metrics share ONE scan
    #    of the written fact; everything else runs as one suite
    models = {"stg_taxi_trips": mwh.stg_trips(), "stg_taxi_zones": mwh.stg_zones(),
              "fct_taxi_trips": fct, "mart_taxi_trips": mart_t, **seeds}
    if geo is not None:
        models["dim_taxi_zones_geospatial"] = geo
    fct_report, q = quality.row_check_values(fct, row_checks("fct_taxi_trips"), profile.fact_quality_cols(True))
    rest = [c for c in checks if c.model in models and c.model != "stg_taxi_trips"
            and not (c.kind in quality.ROW_KINDS and c.model == "fct_taxi_trips")
            and (c.kind != "relationships" or c.args["to"] in models)]
    res.report = stg_report + fct_report + [r.asDict() for r in quality.run_suite(models, rest).collect()]
    done = {r["test_name"] for r in res.report}
    res.report += [{"test_name": c.name, "model": c.model, "column_name": c.column, "test_type": c.kind, "severity": c.severity,
                    "failures": None, "status": "skipped"} for c in checks if c.name not in done]
    missed = sum(1 for r in res.report if r["status"] == "skipped")
    if missed:
        res.add("tests", "tests_skipped", missed)
    for status in ("pass", "warn", "fail"):
        res.add("tests", f"tests_{status}", sum(1 for r in res.report if r["status"] == status))
    for r in res.report:
        if r["status"] == "skipped":
            log.warning("check %s skipped: its model or parent is not built", r["test_name"])
        elif r["status"] != "pass":
            log.warning("check %s: %s failures (%s)", r["test_name"], r["failures"], r["severity"])

    # 5. analytics validation (from the fused fact aggregate)
    res.add("analytics_validation", "fct_trips_rows", q["row_count"])
    res.add("analytics_validation", "mart_trips_rows", profile.row_count(mart_t).first()[0])
    for k in ("total_mismatches", "negative_durations", "pickup_boroughs", "dropoff_boroughs"):
        res.add("analytics_validation", k, q[k])
    return res


def metrics_frame(spark: SparkSession, res: JobResult) -> DataFrame:
    """The job's metrics (a few dozen numbers) as a DataFrame."""
    return spark.createDataFrame(res.metrics, "step string, metric string, value bigint")


def main(argv: list[str] | None = None) -> None:
    """Command line: run the job on files and print its metrics as JSON lines."""
    import argparse
    import json

    from meterline.session import apply_sizing, get_session

    ap = argparse.ArgumentParser(prog="python -m meterline.plans.job")
    ap.add_argument("--trips", required=True, help="glob of monthly trip Parquet files")
    ap.add_argument("--zones", required=True, help="zone lookup CSV")
    ap.add_argument("--zones-geojson", help="zone boundaries (GeoJSON FeatureCollection, line by line, or .shp)")
    ap.add_argument("--out", required=True, help="base folder of the raw / target layers")
    ap.add_argument("--target", default="dev")
    ap.add_argument("--copy-raw", action="store_true", help="copy the raw tables into the target layer first")
    ap.add_argument("--threads", type=int, default=4, help="models written concurrently (1 = serial)")
    ap.add_argument("--unify-types", action="store_true",
                    help="read trip files as the declared raw schema (monthly files with differing types)")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--today", default=None, help="YYYY-MM-DD used by date checks (default: today)")
    ap.add_argument("--date-min", default=str(D.FACT_DATE_MIN), help="first pickup date kept in the marts")
    ap.add_argument("--date-max", default=str(D.FACT_DATE_MAX), help="last pickup date kept in the marts")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    # size shuffles from the input volume (metadata listing only)
    size = spark.read.format("binaryFile").load(a.trips).agg(F.sum("length")).first()[0] or 0
    apply_sizing(spark, size)
    lo, hi = dt.date.fromisoformat(a.date_min), dt.date.fromisoformat(a.date_max)
    wh = TripWarehouse.from_files(spark, a.trips, a.zones, a.zones_geojson, date_min=lo, date_max=hi,
                                  unify_types=a.unify_types)
    today = dt.date.fromisoformat(a.today) if a.today else None
    res = run_job(spark, wh, a.out, a.target, today=today, pickup_date_floor=lo, copy_raw=a.copy_raw,
                  threads=a.threads)
    for step, metric, value in res.metrics:
        print(json.dumps({"step": step, "metric": metric, "value": value}))


if __name__ == "__main__":
    main()
