"""File-stream ingest: each file once across runs and restarts; stream = batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.sources.incremental import incremental_model
from meterline.streaming.ingest import ingest_new_files, read_sink, stream_model


def test_exactly_once_across_runs(spark, tmp_dir):
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    base = spark.range(0, 30).withColumn("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    base.where("id < 10").write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, base.schema, sink, ckpt)
    assert read_sink(spark, sink).count() == 10
    ingest_new_files(spark, landing, base.schema, sink, ckpt)      # restart, nothing new
    assert read_sink(spark, sink).count() == 10
    base.where("id >= 10").write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, base.schema, sink, ckpt, max_files_per_trigger=1)
    got = read_sink(spark, sink)
    assert got.count() == 30 and got.select("id").distinct().count() == 30
    batch = spark.read.parquet(landing)
    assert sorted(got.collect()) == sorted(batch.collect())


def test_stamp_and_partitioned_sink(spark, tmp_dir):
    landing, sink, ckpt = f"{tmp_dir}/l", f"{tmp_dir}/s", f"{tmp_dir}/c"
    df = spark.range(0, 12).withColumn("day", (F.col("id") % 3).cast("int"))
    df.write.parquet(landing)
    stamp = dt.datetime(2025, 6, 1)
    ingest_new_files(spark, landing, df.schema, sink, ckpt, ingested_at=stamp, partition_by=["day"])
    got = read_sink(spark, sink)
    assert got.where("day = 2").count() == 4
    assert {r._ingested_at for r in got.select("_ingested_at").distinct().collect()} == {stamp}


def test_partitioned_writes_do_not_sort(spark, tmp_dir, monkeypatch):
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    monkeypatch.setattr(type(spark.range(0)), "sortWithinPartitions", lambda *a: pytest.fail("sorted"))
    # one task, more months than it keeps open, in mixed order, and a null month
    rows = spark.range(0, 600, 1, 1).select("id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"),
                                            F.when(F.col("id") % 50 > 0, F.col("id") % 50).cast("int").alias("month"))
    want = sorted(map(tuple, rows.select("id", "month").collect()), key=str)
    rows.coalesce(1).write.parquet(f"{tmp_dir}/src")
    source, target, sink = spark.read.parquet(f"{tmp_dir}/src"), f"{tmp_dir}/t", f"{tmp_dir}/s"
    incremental_model(spark, source.where("id < 200"), lambda raw: raw, target, "ts", ["month"])
    incremental_model(spark, source, lambda raw: raw, target, "ts", ["month"])
    stream_model(spark, f"{tmp_dir}/src", source.schema, lambda raw: raw, sink, f"{tmp_dir}/c", ["month"])
    for path in (target, sink):
        assert sorted(map(tuple, spark.read.parquet(path).select("id", "month").collect()), key=str) == want
