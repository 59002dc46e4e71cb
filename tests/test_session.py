from meterline import session
from meterline.plans.trip_queries import wh
from meterline.session import SESSION_DEFAULTS, SHUFFLE_INPUT_BYTES, checkpoint_dir, scratch_path, size_shuffles
from meterline.sources.raw_layer import tables_bytes
from tests.conftest import SF001


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured.rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(configured.rstrip("/") + "/meterline/x/") and p1 != p2


def test_session_defaults_applied(spark):
    for k, v in SESSION_DEFAULTS.items():
        assert spark.conf.get(k) == v


def test_shuffles_start_with_partitions_for_the_input(spark, tmp_dir):
    for t in ("a", "b"):
        spark.range(1000).write.parquet(f"{tmp_dir}/{t}.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = tables_bytes(spark, tmp_dir, ["a", "b", "missing"])
    assert size > 1000 and size_shuffles(spark, size) == least
    large = size_shuffles(spark, 50 * SHUFFLE_INPUT_BYTES * least + 1)
    try:
        assert large == 50 * least + 1
        assert spark.range(10).repartitionByRange("id")._jdf.queryExecution().executedPlan().toString().count(f", {large})") >= 1
    finally:
        size_shuffles(spark, 0)


def test_a_warehouse_sizes_its_shuffles(spark, monkeypatch):
    monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", 1000)
    wh(spark, SF001)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    size_shuffles(spark, 0)
