import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from meterline.sources import files, seeds
from meterline.sources.sinks import (
    Layer, copy_layer, create_namespaces, full_refresh, full_refresh_table, schema_name,
)
from meterline.sources.incremental import incremental_append

STAMP = dt.datetime(2025, 6, 1)


def test_parquet_glob_and_stamp(spark, tmp_dir):
    spark.range(10).write.parquet(f"{tmp_dir}/m1.parquet")
    spark.range(10, 15).write.parquet(f"{tmp_dir}/m2.parquet")
    df = files.ingest_parquet(spark, f"{tmp_dir}/m*.parquet", STAMP)
    assert df.count() == 15 and df.columns == ["id", "_ingested_at"]
    assert {r._ingested_at for r in df.select("_ingested_at").distinct().collect()} == {STAMP}


def test_missing_inputs_raise(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        files.ingest_parquet(spark, f"{tmp_dir}/nothing/*.parquet")
    with pytest.raises(FileNotFoundError):
        files.ingest_csv(spark, f"{tmp_dir}/missing.csv")
    with pytest.raises(FileNotFoundError):
        files.require_files(spark, f"{tmp_dir}/none-*.parquet")


def test_csv_inferred_and_declared(spark, tmp_dir):
    p = f"{tmp_dir}/zones.csv"
    with open(p, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n")
    inferred = files.ingest_csv(spark, p, ingested_at=STAMP)
    assert dict(inferred.dtypes)["LocationID"] == "int"
    declared = files.ingest_csv(spark, p, "LocationID long, Borough string, Zone string, service_zone string", STAMP)
    assert dict(declared.dtypes)["LocationID"] == "bigint" and declared.count() == 2


def test_json_source(spark, tmp_dir):
    p = f"{tmp_dir}/e.json"
    with open(p, "w") as f:
        for i in range(3):
            f.write(json.dumps({"id": i, "kind": "click"}) + "\n")
    df = files.ingest_json(spark, p, "id long, kind string", STAMP)
    assert df.count() == 3 and df.columns == ["id", "kind", "_ingested_at"]


def test_seed_csv_matches_literal_seed(spark, tmp_dir):
    p = f"{tmp_dir}/dim_vendor.csv"
    with open(p, "w") as f:
        f.write("vendor_id,vendor_name,vendor_description\n")
        for r in seeds.VENDOR_ROWS:
            f.write(",".join(str(x) for x in r) + "\n")
    a = seeds.load_seed_csv(spark, "dim_vendor", p)
    assert sorted(a.collect()) == sorted(seeds.dim_vendor(spark).collect())
    assert a.where(F.col("vendor_id") == 2).first().vendor_description.endswith("  ")


def test_full_refresh_replaces(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    full_refresh(spark.range(5), p)
    assert full_refresh(spark.range(3), p).count() == 3


def test_layers_and_schema_names(spark, tmp_dir):
    raw, dev = Layer("raw", tmp_dir), Layer("dev", tmp_dir)
    raw.write(spark.range(7), "src", "t1")
    out = copy_layer(spark, raw, dev, "src", ["t1"])
    assert out["t1"].count() == 7 and os.path.isdir(dev.path("src", "t1"))
    assert schema_name("main", "mart") == "main_mart" and schema_name("main", None) == "main"


def test_incremental_append_equals_full_load(spark, tmp_dir):
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(48)],
                                "id long, ts timestamp_ntz")
    target = f"{tmp_dir}/events"
    assert incremental_append(spark, src.where("id < 20"), target, "ts") is None
    hwm = incremental_append(spark, src, target, "ts")
    assert hwm == dt.datetime(2024, 1, 1, 19)
    incremental_append(spark, src, target, "ts")  # nothing new: no duplicates
    got = spark.read.parquet(target)
    assert got.count() == 48 and got.select("id").distinct().count() == 48


def test_namespaces_and_catalog_tables(spark):
    create_namespaces(spark, ["raw_ns", schema_name("main", "mart")])
    create_namespaces(spark, ["raw_ns"])  # idempotent
    dbs = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert {"raw_ns", "main_mart"} <= dbs
    t = full_refresh_table(spark.range(4).withColumn("m", F.col("id") % 2), "main_mart.t", partition_by=["m"])
    assert t.count() == 4
    assert full_refresh_table(spark.range(2).withColumn("m", F.lit(0)), "main_mart.t", partition_by=["m"]).count() == 2


def test_partitioned_refresh_prunes(spark, tmp_dir):
    df = spark.range(100).withColumn("pickup_month", (F.col("id") % 4).cast("int"))
    out = full_refresh(df, f"{tmp_dir}/p", partition_by=["pickup_month"], max_records_per_file=10)
    assert out.where("pickup_month = 1").count() == 25
    assert {"_SUCCESS", "pickup_month=1"} <= set(os.listdir(f"{tmp_dir}/p"))


def test_incremental_model_is_idempotent(spark, tmp_dir):
    from meterline.sources.incremental import incremental_model, read_model
    raw = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(60)],
                                "id long, ts timestamp_ntz")

    def build(df):
        return df.where(F.col("id") % 2 == 0).withColumn("month", F.month("ts"))
    target = f"{tmp_dir}/model"
    incremental_model(spark, raw.where("id < 25"), build, target, "ts", ["month"])
    incremental_model(spark, raw, build, target, "ts", ["month"])
    incremental_model(spark, raw, build, target, "ts", ["month"])        # nothing new
    got = read_model(spark, target, build(raw).schema)
    assert sorted(got.collect()) == sorted(build(raw).collect())


def test_monthly_files_with_differently_cased_columns(spark, tmp_dir):
    """Monthly trip files spell some columns differently (airport_fee / Airport_fee):
    columns resolve case-insensitively per file, with or without schema merging."""
    spark.createDataFrame([(1, 1.25)], "id int, airport_fee double").write.parquet(f"{tmp_dir}/2023-01.parquet")
    spark.createDataFrame([(2, 1.75)], "id int, Airport_fee double").write.parquet(f"{tmp_dir}/2023-02.parquet")
    for merge in (False, True):
        df = files.ingest_parquet(spark, f"{tmp_dir}/2023-*.parquet", STAMP, merge_schema=merge)
        assert sorted(tuple(r) for r in df.select("id", "airport_fee").collect()) == [(1, 1.25), (2, 1.75)]


def test_unified_parquet_across_physical_types(spark, tmp_dir):
    spark.createDataFrame([(1, 1.0, 1.25)], "id int, passenger_count double, airport_fee double") \
        .write.parquet(f"{tmp_dir}/2023-01.parquet")
    spark.createDataFrame([(2, 3, 1.75)], "id int, passenger_count bigint, Airport_fee double") \
        .write.parquet(f"{tmp_dir}/2023-02.parquet")
    spark.createDataFrame([(3,)], "id int").write.parquet(f"{tmp_dir}/2023-03.parquet")
    df = files.ingest_parquet(spark, f"{tmp_dir}/2023-*.parquet", STAMP,
                              schema="id INT, passenger_count DOUBLE, airport_fee DOUBLE")
    assert df.columns == ["id", "passenger_count", "airport_fee", "_ingested_at"]
    assert sorted(tuple(r)[:3] for r in df.collect()) == [(1, 1.0, 1.25), (2, 3.0, 1.75), (3, None, None)]
    with pytest.raises(FileNotFoundError):
        files.ingest_parquet(spark, f"{tmp_dir}/none-*.parquet", schema="id INT")
