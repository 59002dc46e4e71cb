"""Incremental loads by a load log: late, tied, timeless, changed and vanished rows."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from meterline.sources import load_log

SCHEMA = "id long, ts timestamp_ntz, v double"
PART = ("y", "m")


def build(raw):
    """The model: rows with a positive value, their month as columns."""
    return raw.where("v > 0").withColumns({"y": F.year("ts"), "m": F.month("ts")})


def at(month, day=1, year=2024, us=0):
    return dt.datetime(year, month, day, 12, 0, 0, us)


class Table:
    def __init__(self, spark, root):
        self.spark, self.source, self.target, self.log = spark, f"{root}/source", f"{root}/model", f"{root}/log"

    def arrive(self, rows, name):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.source}/{name}")

    def load(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return load_log.load_months(self.spark, self.source, schema, build, self.target, self.log, "ts", PART)

    def rows(self):
        return sorted((tuple(r) for r in self.spark.read.schema(f"{SCHEMA}, y int, m int").parquet(self.target).select("id", "ts", "v").collect()), key=str)

    def want(self):
        raw = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.source)
        return sorted((tuple(r) for r in build(raw).select("id", "ts", "v").collect()), key=str)

    def files(self):
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{self.target}/**/*.parquet", recursive=True)}


@pytest.fixture()
def table(spark, tmp_dir):
    return Table(spark, tmp_dir)


def test_second_arrival_before_at_and_after_the_mark(table):
    table.arrive([(i, at(1 + i % 6, 1 + i), 1.0) for i in range(24)], "a")
    first = table.load()
    assert (first.batch, first.mark, first.rows, first.late, first.tied, first.null) == (1, None, 24, 0, 0, 0)
    mark = max(r[1] for r in table.rows())
    untouched = {p: t for p, t in table.files().items() if "m=2/" in p or "m=3/" in p}
    table.arrive([(100, at(1, 2), 5.0), (101, mark, 6.0), (102, at(9), 7.0), (103, None, 8.0), (104, at(5), -1.0)], "b")
    second = table.load()
    assert (second.batch, second.mark, second.rows, second.late, second.tied, second.null) == (2, mark, 5, 2, 1, 1)
    assert second.months == [(None, None), (2024, 1), (2024, 5), (2024, mark.month), (2024, 9)]
    assert table.rows() == table.want()
    assert untouched and untouched.items() <= table.files().items()
    before = table.files()
    assert table.load() == load_log.Load(None, at(9)) and table.files() == before


def test_changed_and_vanished_files(table, spark):
    table.arrive([(1, at(1), 1.0), (2, at(2), 1.0)], "a")
    table.arrive([(3, at(3), 1.0), (4, at(1, 5), 1.0)], "b")
    table.load()
    table.arrive([(1, at(1), 9.0), (5, at(4), 1.0)], "a")  # month 2 loses its only row
    again = table.load()
    assert table.rows() == table.want() == [(1, at(1), 9.0), (3, at(3), 1.0), (4, at(1, 5), 1.0), (5, at(4), 1.0)]
    assert again.months == [(2024, 1), (2024, 2), (2024, 4)] and not glob.glob(f"{table.target}/y=2024/m=2/*")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.source}/b")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gone = table.load()
    assert gone.months == [(2024, 1), (2024, 3)] and gone.files == 0 and table.rows() == table.want() == [(1, at(1), 9.0), (5, at(4), 1.0)]
    assert table.load().batch is None


def test_a_load_that_died_before_its_log_entry_is_repeated(table, monkeypatch):
    table.arrive([(1, at(1), 1.0)], "a")
    table.load()
    table.arrive([(2, at(1, 3), 1.0), (3, at(2), 1.0)], "b")

    def crash(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(load_log, "publish", crash)
        with pytest.raises(RuntimeError):
            table.load()
    redo = table.load()
    assert redo.batch == 2 and redo.rows == 2 and table.rows() == table.want()


def test_empty_files_and_rows_the_model_drops(table):
    table.arrive([], "a")
    assert table.load().months == []
    table.arrive([(1, at(1), -1.0)], "b")
    assert table.load().months == [(2024, 1)] and table.load().batch is None
    table.arrive([(2, at(1), 1.0)], "c")
    table.load()
    assert table.rows() == table.want() == [(2, at(1), 1.0)]


def test_months_are_ranges_of_the_plain_column(spark):
    rows = [(at(m, 1, y),) for y in (2023, 2024) for m in range(1, 13)] + [(None,), (dt.datetime(2024, 4, 1),), (dt.datetime(2024, 3, 31, 23, 59, 59, 999999),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    months = [(2023, 12), (2024, 1), (2024, 3), (None, None)]
    got = df.where(load_log.in_months(F.col("ts"), months)).collect()
    want = [r for r in rows if r[0] is None or (r[0].year, r[0].month) in months]
    assert sorted(map(str, got)) == sorted(str(g) for g in spark.createDataFrame(want, "ts timestamp_ntz").collect())
    assert df.where(load_log.in_months(F.col("ts"), [])).count() == 0


def test_source_rows_are_dealt_to_months_not_the_model_rows(spark, tmp_dir):
    source, target, log = (f"{tmp_dir}/{n}" for n in ("src", "model", "log"))
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5)), (3, None), (3, None)], "id int, ts timestamp_ntz")
    rows.write.parquet(source)
    seen = []

    def wide(raw):
        seen.append(raw._jdf.queryExecution().analyzed().toString())
        return raw.select("*", *[F.concat(F.lit("name"), F.col("id").cast("string")).alias(f"c{i}") for i in range(5)], F.year("ts").alias("y"), F.month("ts").alias("m"))

    load_log.load_months(spark, source, rows.schema, wide, target, log, "ts", ("y", "m"))
    assert "RebalancePartitions" in seen[0]
    got = sorted((r.id, r.c4, r.y, r.m) for r in spark.read.parquet(target).collect() if r.y) + [(r.id, r.c4) for r in spark.read.parquet(target).where("y is null").collect()]
    assert got == [(1, "name1", 2024, 1), (2, "name2", 2024, 2), (3, "name3"), (3, "name3")]
