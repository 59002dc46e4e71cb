"""Totals far from the fixtures' range, safe refresh, loads past a mark."""

import math

import pytest
from pyspark.sql import functions as F

from meterline.functions.columns import exact_avg, exact_sum, round_to
from meterline.plans.cubes import Cube, CubeQuery, CubeSet, Dimension, Filter, Join, Measure, PreAggregation, TimeDimension
from meterline.plans.rollups import RollupStore
from meterline.sources.incremental import high_water_mark, incremental_append, skipped_rows
from meterline.sources.sinks import full_refresh


def test_rounding_keeps_large_and_special_values(spark):
    xs = [1.25e14, 9.3e12, -4.4e300, float("nan"), float("inf"), 1.23456789, -0.5, 0.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(round_to("x", 6)).collect()]
    assert got[:3] == xs[:3] and math.isnan(got[3]) and got[4] == xs[4] and got[5:] == [1.234568, -0.5, 0.0]


@pytest.mark.parametrize("xs", [[1.0, float("nan")], [1.0, float("inf")], [3e13, 4e13, 0.25], [1e300, 1e300]])
def test_exact_sums_fall_back_to_plain_ones(spark, xs):
    r = spark.createDataFrame([(x,) for x in xs], "x double").agg(exact_sum("x").alias("s"), F.sum("x").alias("p"), exact_avg("x").alias("m")).first()
    assert repr(r.s) == repr(r.p) and repr(r.m) == repr(r.p / len(xs))


VENDORS = Cube("V", "v", (Dimension("id", "id", "number", primary_key=True), Dimension("name", "name")),
               (Measure("count", "count"), Measure("top", "max", "id"), Measure("weight", "sum", "id")))
TRIPS = Cube("T", "t", (Dimension("vid", "vid", "number"), Dimension("at", "at", "time"), Dimension("day", "day")),
             (Measure("n", "count"), Measure("fare", "sum", "fare", scale=6), Measure("avgFare", "avg", "fare", scale=6), Measure("ratio", "avg", "ratio"), Measure("area", "sum", "ratio")),
             (Join("V", "V", "vid", "id"),),
             (PreAggregation("byDay", ("n", "fare", "avgFare", "ratio", "area"), ("vid", "day"), "at", "day"),))
CUBES = CubeSet([TRIPS, VENDORS])


def tables(spark, rows):
    import datetime as dt
    t = spark.createDataFrame([(v, dt.datetime.fromisoformat(at), at[:10], fare, ratio) for v, at, fare, ratio in rows], "vid int, at timestamp_ntz, day string, fare double, ratio double")
    return {"t": t, "v": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")}


ROWS = [(1, "1998-12-31T08:00:00", 4.25, 4e-7), (1, "1998-12-31T12:00:00", 3e13, 4e-7), (2, "1998-12-31T20:00:00", 1.1, 7.6e-4), (2, "1999-01-01T00:00:00", 2.2, 1.0)]


def test_small_and_large_measures(spark):
    got = CUBES.query(CubeQuery(("T.area", "T.fare")), tables(spark, ROWS[:3])).first()
    assert got.T_area == pytest.approx(7.608e-4, rel=1e-12) and got.T_fare == pytest.approx(3e13 + 5.35, rel=1e-15)


def test_joined_measures_count_dimension_rows(spark):
    got = CUBES.query(CubeQuery(("T.n", "V.count", "V.top")), tables(spark, ROWS)).first()
    assert (got.T_n, got.V_count, got.V_top) == (4, 2, 2)
    by = {r.V_name: r.V_count for r in CUBES.query(CubeQuery(("V.count",), ("V.name", "T.vid")), tables(spark, ROWS)).collect()}
    assert by == {"a": 1, "b": 1}
    # sums of a joined cube are over its distinct keys
    got = CUBES.query(CubeQuery(("T.n", "V.weight")), tables(spark, ROWS))
    assert got.columns == ["T_n", "V_weight"] and [tuple(r) for r in got.collect()] == [(4, 3)]


def test_base_cube_is_the_one_that_reaches_all(spark):
    got = CUBES.query(CubeQuery((), ("V.name", "T.vid")), tables(spark, ROWS)).collect()
    assert sorted((r.V_name, r.T_vid) for r in got) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize(("hi", "n"), [("1998-12-31", 3), ("1998-12-31 12:00:00", 2), ("1999-01-01", 4)])
def test_date_range_end(spark, hi, n):
    q = CubeQuery(("T.n",), time_dimensions=(TimeDimension("T.at", None, ("1998-12-31", hi)),))
    assert CUBES.query(q, tables(spark, ROWS)).first().T_n == n


QUERIES = [CubeQuery(("T.n", "T.fare", "T.avgFare", "T.ratio", "T.area")), CubeQuery(("T.n",), ("T.vid",)), CubeQuery((), ("T.vid",)),
           CubeQuery(("T.fare", "T.avgFare"), ("T.day",), filters=(Filter("T.vid", "equals", (2,)),)),
           CubeQuery(("T.n", "T.area"), time_dimensions=(TimeDimension("T.at", "month"),))]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_served_equals_base(spark, rows, tmp_path):
    t = tables(spark, rows)
    store = RollupStore(CUBES)
    store.build(spark, "T", "byDay", t, path=str(tmp_path / "rollup"))
    for q in QUERIES:
        assert store.route(q) == ("T", "byDay")
        a, b = store.query(q, t), CUBES.query(q, t)
        assert a.dtypes == b.dtypes
        for x, y in zip(sorted(map(tuple, a.collect()), key=repr), sorted(map(tuple, b.collect()), key=repr), strict=True):
            assert [v if not isinstance(v, float) else pytest.approx(v, rel=1e-12) for v in x] == list(y)


def test_failed_refresh_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    full_refresh(spark.range(5).toDF("x"), path)
    bad = spark.range(5).select(F.raise_error(F.concat(F.lit("row "), F.col("id").cast("string"))).cast("long").alias("x"))
    with pytest.raises(Exception, match="row"):
        full_refresh(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert full_refresh(spark.range(2).toDF("x"), path).count() == 2
    assert [p.name for p in tmp_path.iterdir() if ".old" in p.name] == []


def test_mark_is_none_only_for_a_missing_target(spark, tmp_path):
    target = str(tmp_path / "target")
    assert high_water_mark(spark, target, "ts") is None
    rows = spark.sql("SELECT id, CASE WHEN id = 4 THEN NULL ELSE timestamp'2024-01-01' + make_interval(0,0,0,cast(id AS int)) END ts FROM range(7)")
    incremental_append(spark, rows.where("id < 3"), target, "ts")
    with pytest.raises(Exception, match="other"):
        incremental_append(spark, rows.withColumn("other", F.col("ts")), target, "other")
    assert spark.read.parquet(target).count() == 3
    mark = high_water_mark(spark, target, "ts")
    s = skipped_rows(rows, "ts", mark)
    assert (s.equal, s.late, s.null) == (1, 2, 1)
    incremental_append(spark, rows, target, "ts")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 5, 6]
