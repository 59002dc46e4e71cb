import os
import time

from meterline.sources import raw_layer


def test_landing_reused_and_refreshed(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    spark.range(10).write.parquet(src)
    base = f"{tmp_dir}/landings"
    a = raw_layer.landed(spark, "t", spark.read.parquet(src), "v1", base=base)
    b = raw_layer.landed(spark, "t", spark.read.parquet(src), "v1", base=base)
    assert a.inputFiles() == b.inputFiles() and a.count() == 10
    c = raw_layer.landed(spark, "t", spark.read.parquet(src), "v2", base=base)       # code change
    assert c.inputFiles() != a.inputFiles()
    time.sleep(0.01)
    spark.range(15).write.mode("overwrite").parquet(src)                            # input change
    d = raw_layer.landed(spark, "t", spark.read.parquet(src), "v1", base=base)
    assert d.count() == 15 and len(os.listdir(base)) == 3


def test_incomplete_landing_is_rewritten(spark, tmp_dir):
    src = f"{tmp_dir}/src2"
    spark.range(5).write.parquet(src)
    df = spark.read.parquet(src)
    base = f"{tmp_dir}/l2"
    key = raw_layer.fingerprint(spark, sorted(df.inputFiles()) + ["version:|cluster:None"])
    os.makedirs(f"{base}/t-{key}")
    open(f"{base}/t-{key}/part-0.txt", "w").write("junk")                             # no _SUCCESS
    raw_layer._DONE.clear()
    out = raw_layer.landed(spark, "t", df, base=base)
    assert out.count() == 5


def test_tables_fingerprint_changes_with_files(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/a.parquet")
    f1 = raw_layer.tables_fingerprint(spark, tmp_dir, ["a"])
    assert f1 == raw_layer.tables_fingerprint(spark, tmp_dir, ["a"])
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_dir}/a.parquet")
    assert f1 != raw_layer.tables_fingerprint(spark, tmp_dir, ["a"])
