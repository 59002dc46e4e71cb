import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from meterline.operators import profile
from meterline.operators import quality as Q
from meterline.operators.quality_store import SuiteStore, in_partitions

SCHEMA = "id int, parent int, kind string, amount double, y int, m int"
ROWS = [(1, 1, "a", 1.0, 2024, 1), (2, 2, "b", -5.0, 2024, 1), (3, None, "x", None, 2024, 1), (3, 9, "x", 2.0, 2024, 2), (4, 1, "y", 900.0, 2024, 2), (None, 8, None, 3.0, None, None)]
CHECKS = [Q.row_count_positive("t"), Q.not_null("t", "amount"), Q.unique("t", "id"), Q.relationships("t", "parent", "p", "pid", "warn"),
          Q.accepted_values("t", "kind", ["a", "b"]), Q.accepted_range("t", "amount", 0, 100), Q.expression_is_true("t", "amount", "amount < 800", label="small")]
BY = ("y", "m")
ALL = [(2024, 1), (2024, 2), (None, None)]


def reports(spark, store, rows, parents):
    models = {"t": spark.createDataFrame(rows, SCHEMA), "p": spark.createDataFrame(parents, "pid int")}
    whole = sorted(map(tuple, Q.run_suite(models, CHECKS).select(*Q.REPORT_SCHEMA.names).collect()), key=str)
    return whole, sorted(map(tuple, store.report(models["t"], models).select(*Q.REPORT_SCHEMA.names).collect()), key=str)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merged_report_is_that_of_the_whole_model(spark, tmp_dir):
    store, parents = SuiteStore(spark, CHECKS, f"{tmp_dir}/store", BY), [(1,), (2,)]
    models = lambda rows: {"t": spark.createDataFrame(rows, SCHEMA), "p": spark.createDataFrame(parents, "pid int")}
    with pytest.raises(ValueError):
        store.report(models(ROWS)["t"], models(ROWS))
    first = models(ROWS[:3])
    assert store.refresh(1, first["t"], first, ALL[:1]) == ALL[:1]
    whole, merged = reports(spark, store, ROWS[:3], parents)
    assert whole == merged
    before, second = files(f"{tmp_dir}/store"), models(ROWS)
    assert store.refresh(2, second["t"], second, ALL[1:]) == ALL[1:]
    whole, merged = reports(spark, store, ROWS, parents)
    assert whole == merged and any(r[3] == "unique" and r[5] == 1 for r in merged)  # id 3 occurs in two months
    after = files(f"{tmp_dir}/store")
    assert all(after[f] == t for f, t in before.items())  # the first month's files are as they were
    assert store.refresh(2, second["t"], second, ALL[1:]) == [] and store.refresh(1, second["t"], second, ALL) == [] and files(f"{tmp_dir}/store") == after
    # a parent that has gone shows without reading the model again
    whole, merged = reports(spark, store, ROWS, [(2,)])
    assert whole == merged
    # rows that vanish: the month is checked again and left empty
    third = models([r for r in ROWS if r[5] != 2])
    assert store.refresh(3, third["t"], third, ALL[1:2]) == ALL[1:2]
    whole, merged = reports(spark, store, [r for r in ROWS if r[5] != 2], parents)
    assert whole == merged


def test_empty_model_and_other_checks(spark, tmp_dir):
    store = SuiteStore(spark, CHECKS, f"{tmp_dir}/store", BY)
    models = {"t": spark.createDataFrame([], SCHEMA), "p": spark.createDataFrame([], "pid int")}
    assert store.refresh(1, models["t"], models, ALL) == ALL
    whole, merged = reports(spark, store, [], [])
    assert whole == merged
    with pytest.raises(ValueError):
        SuiteStore(spark, CHECKS[:2], f"{tmp_dir}/store", BY).refresh(2, models["t"], models, ALL)
    with pytest.raises(ValueError):
        SuiteStore(spark, [*CHECKS, Q.not_null("other", "x")], f"{tmp_dir}/store", BY)


def test_row_checks_and_partition_tests_do_not_multiply_rows(spark, tmp_dir):
    months = [(y, m) for y in (2023, 2024) for m in range(1, 13)] + [(2025, None), (None, None)]
    df = spark.createDataFrame([(y, m) for y in (2022, 2023, 2024, 2025, None) for m in (1, 12, None)], "y int, m int")
    got = {tuple(r) for r in df.where(in_partitions(BY, months)).collect()}
    assert got == {tuple(r) for r in df.collect()} & set(months)
    assert str(in_partitions(BY, months))[:-1].count("2023") == 1  # a year is compared once, not once a month
    # keys that no parent key can equal are orphans; a check's rows are not unfolded before they are counted
    checks = [*CHECKS[:2], Q.relationships("t", "kind", "p", "pid"), Q.relationships("t", "kind", "p", "pid", "warn")]
    models = {"t": spark.createDataFrame(ROWS, SCHEMA), "p": spark.createDataFrame([(1,)], "pid int")}
    store = SuiteStore(spark, checks, f"{tmp_dir}/store", BY)
    store.refresh(1, models["t"], models, ALL)
    names = Q.REPORT_SCHEMA.names
    assert sorted(map(tuple, store.report(models["t"], models).select(*names).collect()), key=str) == sorted(map(tuple, Q.run_suite(models, checks).select(*names).collect()), key=str)
    assert "Generate explode" not in store._keyed(models["t"], models)._jdf.queryExecution().optimizedPlan().toString()


def test_partition_freshness(spark, tmp_dir):
    target = f"{tmp_dir}/t"
    rows = [(1, dt.datetime(2024, 1, 1, 10)), (1, dt.datetime(2024, 1, 2, 9)), (2, dt.datetime(2024, 1, 5, 23)), (3, None)]
    for part in (rows[:1], rows[1:]):
        spark.createDataFrame(part, "p int, ts timestamp_ntz").coalesce(1).write.mode("append").partitionBy("p").parquet(target)
    old = dt.datetime(2024, 1, 3, 0, 30, tzinfo=dt.timezone.utc).timestamp()
    for f in glob.glob(f"{target}/p=2/*.parquet"):
        os.utime(f, (old, old))
    got = {r.p: r for r in profile.partition_freshness(spark.read.parquet(target), ["p"], "ts", dt.datetime(2024, 1, 6), 30, 24).collect()}
    assert [(p, r.row_count, r.file_count, r.latest_at, r.lag_hours, r.is_fresh, r.has_arrived) for p, r in sorted(got.items())] == [
        (1, 2, 2, dt.datetime(2024, 1, 2, 9), 87, False, True), (2, 1, 1, dt.datetime(2024, 1, 5, 23), 1, True, False), (3, 1, 1, None, None, False, True)]
    fixed = profile.partition_freshness(spark.read.parquet(target), ["p"], "ts", dt.datetime(2024, 1, 6), 30, 24, arrival_now=dt.datetime(2024, 1, 3, 2, 0)).where("p = 2").first()
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert zone in ("UTC", "Etc/UTC") and fixed.arrival_lag_hours == 2 and fixed.has_arrived
    assert profile.partition_freshness(spark.read.parquet(target).where("p > 5"), ["p"], "ts", dt.datetime(2024, 1, 6), 30, 24).count() == 0


assert F
