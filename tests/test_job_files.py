"""The job on files, as a user of the reference would run it."""

import json

from meterline import bindings
from meterline.plans.job import main, run_job
from meterline.plans.warehouse import TripWarehouse
from tests.conftest import SF001


def write_sources(spark, tmp_dir):
    w = TripWarehouse.from_testdata(spark, SF001, land=False)
    trips = w.raw_trips().drop("_ingested_at")
    trips.where("tpep_pickup_datetime < '1998-01-01'").write.parquet(f"{tmp_dir}/trips/2023-01.parquet")
    trips.where("tpep_pickup_datetime >= '1998-01-01'").write.parquet(f"{tmp_dir}/trips/2023-02.parquet")
    zones = w.raw_zones().drop("_ingested_at").toPandas()[["LocationID", "Borough", "Zone", "service_zone"]]
    zones.to_csv(f"{tmp_dir}/zones.csv", index=False)
    feats = [{"type": "Feature", "properties": {"LocationID": r["LocationID"]}, "geometry": json.loads(r["geojson"])}
             for r in bindings.zone_geojson(spark, SF001).collect()]
    with open(f"{tmp_dir}/zones.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)
    return w


def test_from_files_matches_projection(spark, tmp_dir):
    w = write_sources(spark, tmp_dir)
    fw = TripWarehouse.from_files(spark, f"{tmp_dir}/trips/*.parquet", f"{tmp_dir}/zones.csv",
                                  f"{tmp_dir}/zones.geojson", ingested_at=bindings.INGESTED_AT,
                                  date_min=w.date_min, date_max=w.date_max)
    assert fw.fct_trips().count() == w.fct_trips().count()
    a = sorted(tuple(r) for r in fw.dim_zones_geo().drop("_ingested_at").collect())
    b = sorted(tuple(r) for r in w.dim_zones_geo().drop("_ingested_at").collect())
    assert len(a) == 25 and [x[:6] for x in a] == [x[:6] for x in b]


def test_from_files_unified_types(spark, tmp_dir):
    w = write_sources(spark, tmp_dir)
    fw = TripWarehouse.from_files(spark, f"{tmp_dir}/trips/*.parquet", f"{tmp_dir}/zones.csv",
                                  ingested_at=bindings.INGESTED_AT, unify_types=True,
                                  date_min=w.date_min, date_max=w.date_max)
    assert fw.fct_trips().count() == w.fct_trips().count()


def test_job_cli(spark, tmp_dir, capsys):
    write_sources(spark, tmp_dir)
    main(["--trips", f"{tmp_dir}/trips/*.parquet", "--zones", f"{tmp_dir}/zones.csv",
          "--zones-geojson", f"{tmp_dir}/zones.geojson", "--out", f"{tmp_dir}/layers", "--today", "2025-06-01",
          "--date-min", "1996-01-01", "--date-max", "2000-05-31"])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    got = {m["metric"]: m["value"] for m in lines}
    assert got["raw_trips"] == 6000 and got["tests_pass"] + got["tests_warn"] + got["tests_fail"] == 36
    assert got["fct_trips_rows"] > 0


def test_job_on_empty_window(spark, tmp_dir):
    write_sources(spark, tmp_dir)
    fw = TripWarehouse.from_files(spark, f"{tmp_dir}/trips/*.parquet", f"{tmp_dir}/zones.csv")  # 2023-2025 window
    res = run_job(spark, fw, f"{tmp_dir}/l3")
    got = {m[1]: m[2] for m in res.metrics}
    assert got["fct_trips_rows"] == 0 and got["tests_fail"] >= 1   # empty fact fails its row-count check


def test_job_without_geometry(spark, tmp_dir):
    write_sources(spark, tmp_dir)
    fw = TripWarehouse.from_files(spark, f"{tmp_dir}/trips/*.parquet", f"{tmp_dir}/zones.csv")
    res = run_job(spark, fw, f"{tmp_dir}/l2", copy_raw=False)
    assert "dim_taxi_zones_geospatial" not in res.tables
    assert sum(1 for m in res.metrics if m[1].startswith("tests_")) == 4
    assert len(res.report) == 36 and sum(r["status"] == "skipped" for r in res.report) == 6  # nothing vanishes
