"""Range split, refresh by partition, distinct counts and routing of rollups."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.plans import rollups
from meterline.plans.cubes import Cube, CubeQuery, CubeSet, Dimension, Filter, Join, Measure, PreAggregation, TimeDimension
from meterline.plans.distinct_rollups import DistinctRollup, numbered_values

GRAINS = ("hour", "day", "week", "month", "quarter", "year")
PART = ("y", "m")
TRIPS = Cube("T", "trips", month_partitions=(("at", PART),), joins=(Join("Z", "Z", "zone", "zone_id"),),
             dimensions=(Dimension("at", "at", "time"), Dimension("who", "who"), Dimension("zone", "zone", "number")),
             measures=(Measure("n", "count"), Measure("fare", "sum", "fare", scale=2), Measure("mean", "avg", "fare", scale=2), Measure("low", "min", "fare"),
                       Measure("high", "max", "fare"), Measure("riders", "count_distinct", "rider"), Measure("zones", "count_distinct", "zone")),
             pre_aggregations=(*[PreAggregation(g, ("n", "fare", "mean", "low", "high"), ("who",), "at", g) for g in GRAINS],
                               PreAggregation("plain", ("n", "fare", "mean", "low", "high"), ("who", "zone")),
                               PreAggregation("small", ("n",), ("who",)),
                               PreAggregation("riders", ("riders", "zones"), ("who", "zone"), "at", "day")))
ZONES = Cube("Z", "zones", dimensions=(Dimension("id", "zone_id", "number", primary_key=True), Dimension("name", "name")),
             measures=(Measure("area", "sum", "area"), Measure("mean", "avg", "area"), Measure("count", "count")))
CUBES = CubeSet([TRIPS, ZONES])
MEASURES = ("T.n", "T.fare", "T.mean", "T.low", "T.high")


def trips(spark, n=400, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2023, 11, 20)
    rows = [(start + dt.timedelta(seconds=rng.randrange(90 * 86400), microseconds=rng.choice([0, 999_999])), rng.choice(["a", "b", None]), rng.randrange(4),
             rng.choice([None, rng.randrange(10_000) / 100]), rng.choice([None, "hot", "hot", f"r{rng.randrange(60)}"])) for _ in range(n)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, who string, zone int, fare double, rider string")
    return df.withColumns({"y": F.year("at"), "m": F.month("at")})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------ range split
times = st.datetimes(dt.datetime(2020, 1, 1), dt.datetime(2024, 12, 31))


@settings(max_examples=300, deadline=None)
@given(times, times, st.sampled_from(("second", "minute", *GRAINS)))
def test_split_covers_the_range_once(a, b, grain):
    lo, hi = min(a, b), max(a, b)
    whole, edges = rollups.split_range(lo, hi, grain)
    spans = sorted(([whole] if whole else []) + edges)
    assert all(x < y for x, y in spans)
    assert not spans and lo == hi or spans[0][0] == lo and spans[-1][1] == hi and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
    if whole:
        assert all(rollups.period_start(x, grain) == x for x in whole)
    assert all(rollups.next_period(x, grain) > x for x in (lo, hi))
    for x, y in edges:  # an edge lies in one period, or in two if no whole one lies between
        assert y <= rollups.next_period(rollups.next_period(x, grain), grain)


@pytest.mark.parametrize("grain", GRAINS)
def test_ranges_equal_the_base_query(spark, grain):
    tables = {"trips": trips(spark).cache()}
    store = rollups.RollupStore(CUBES)
    store.build(spark, "T", grain, tables)
    for span in (("2023-12-05T07:30:00", "2024-01-19T18:45:10"), ("2023-12-05", "2023-12-05"), ("2024-01-01", "2024-01-31"), ("2023-12-31 23:59:59.999999", "2024-02-02"),
                 ("2024-01-10 08:15:00", "2024-01-10 08:20:00"), ("2030-01-01", "2030-12-31")):
        q = CubeQuery(MEASURES, ("T.who",), (TimeDimension("T.at", grain, span),))
        assert store.route(q) == ("T", grain)
        assert rows(store.query(q, tables)) == rows(CUBES.query(q, tables)), span
        alone = CubeQuery(("T.n", "T.fare"), time_dimensions=(TimeDimension("T.at", None, span),), filters=(Filter("T.who", "set"),))
        assert rows(store.query(alone, tables)) == rows(CUBES.query(alone, tables)), span


def test_edges_open_their_months_only(spark, tmp_dir):
    trips(spark).write.partitionBy(*PART).parquet(f"{tmp_dir}/fact")
    fact = spark.read.parquet(f"{tmp_dir}/fact")
    ro = rollups.materialize(spark, rollups.build_rollup(CUBES, "T", "day", {"trips": fact}), f"{tmp_dir}/day")
    q = CubeQuery(MEASURES, ("T.who",), (TimeDimension("T.at", "month", ("2023-11-25T10:00:00", "2024-02-03T10:00:00")),))
    out = rollups.serve(ro, CUBES, "T", "day", q, {"trips": fact})
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/fact]" in line]
    assert scans and all("PartitionFilters: [" in s and "PushedFilters: [" in s and "GreaterThanOrEqual(at" in s for s in scans)
    edges = rollups.edge_rows(TRIPS, "at", fact, rollups.split_range(*rollups.half_open(q.time_dimensions[0].date_range), "day")[1])
    opened = {tuple(r) for r in edges.select("y", "m").distinct().collect()}
    assert opened <= {(2023, 11), (2024, 2)} and rows(out) == rows(CUBES.query(q, {"trips": fact}))


def test_whole_periods_need_no_tables(spark):
    ro = rollups.build_rollup(CUBES, "T", "day", {"trips": trips(spark)})
    whole = CubeQuery(("T.n",), time_dimensions=(TimeDimension("T.at", "month", ("2024-01-01", "2024-01-31")),))
    assert rollups.serve(ro, CUBES, "T", "day", whole).count() == 1
    with pytest.raises(ValueError, match="edges"):
        rollups.serve(ro, CUBES, "T", "day", CubeQuery(("T.n",), time_dimensions=(TimeDimension("T.at", None, ("2024-01-01 05:00:00", "2024-01-31")),)))


# ------------------------------------------------------------ refresh
@pytest.mark.parametrize("name", ["plain", "day"])
def test_refresh_by_partition(spark, tmp_dir, name):
    """Loads that add, change and remove rows; batches that come twice or late."""
    ro = rollups.PartitionedRollup(spark, CUBES, "T", name, f"{tmp_dir}/ro", PART)
    with pytest.raises(ValueError):
        ro.table()
    fact = trips(spark).cache()
    months = [tuple(r) for r in fact.select(*PART).distinct().collect()]

    def want(df):
        return rows(rollups.build_rollup(CUBES, "T", name, {"trips": df}))

    assert sorted(ro.refresh(1, {"trips": fact}, months)) == sorted(months) and rows(ro.table()) == want(fact)
    assert ro.refresh(1, {"trips": fact.limit(3)}, months) == [] and rows(ro.table()) == want(fact)
    more = fact.unionByName(trips(spark, 50, 2).where("y = 2024 and m = 1"))
    assert ro.refresh(2, {"trips": more}, [(2024, 1), (None, None)]) == [(2024, 1), (None, None)] and rows(ro.table()) == want(more)
    less = more.where("not (y = 2023 and m = 12)")
    ro.refresh(3, {"trips": less}, [(2023, 12)])
    assert rows(ro.table()) == want(less)
    assert ro.refresh(2, {"trips": fact}, [(2023, 12)]) == [] and rows(ro.table()) == want(less)
    got = rollups.serve(ro.table(), CUBES, "T", name, CubeQuery(MEASURES, ("T.who",)))
    assert rows(got) == rows(CUBES.query(CubeQuery(MEASURES, ("T.who",)), {"trips": less}))


def test_refresh_touches_no_other_partition(spark, tmp_dir):
    import glob
    import os
    ro = rollups.PartitionedRollup(spark, CUBES, "T", "plain", f"{tmp_dir}/ro", PART)
    fact = trips(spark)
    ro.refresh(1, {"trips": fact}, [tuple(r) for r in fact.select(*PART).distinct().collect()])
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp_dir}/ro/parts/**/*.parquet", recursive=True) if "y=2024/m=1/" not in p}
    ro.refresh(2, {"trips": fact}, [(2024, 1)])
    assert before and before.items() <= {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp_dir}/ro/parts/**/*.parquet", recursive=True)}.items()


# ------------------------------------------------------------ distinct counts
def test_distinct_counts_at_every_grain(spark, tmp_dir):
    tables = {"trips": trips(spark, 600).cache()}
    ro = DistinctRollup(CUBES, "T", "riders")
    ro.build(spark, tables, f"{tmp_dir}/sets")
    for grain in ("day", "week", "month", "quarter", "year", None):
        for dims in ((), ("T.who",), ("T.zone", "T.who")):
            q = CubeQuery(("T.riders", "T.zones"), dims, (TimeDimension("T.at", grain),) if grain else ())
            assert rows(ro.serve(q)) == rows(CUBES.query(q, tables)), (grain, dims)
    q = CubeQuery(("T.riders",), ("T.zone",), filters=(Filter("T.who", "equals", ("a",)),), order=(("T.riders", "desc"),), limit=2)
    assert ro.serve(q).select("T_riders").collect() == CUBES.query(q, tables).select("T_riders").collect()
    with pytest.raises(ValueError):
        ro.serve(CubeQuery(("T.riders",), time_dimensions=(TimeDimension("T.at", "hour"),)))
    with pytest.raises(ValueError):
        DistinctRollup(CUBES, "T", "plain")


def test_dictionary_is_dense(spark, tmp_dir):
    values = spark.range(0, 200_000, 1, 7).selectExpr("cast(id % 70000 as string) value").unionByName(spark.sql("select cast(null as string) value"))
    ids = numbered_values(values, f"{tmp_dir}/ids")
    got = ids.agg(F.min("id"), F.max("id"), F.countDistinct("id"), F.countDistinct("value")).first()
    assert tuple(got) == (1, 70_000, 70_000, 70_000)  # several bitmaps


# ------------------------------------------------------------ joins and routing
def test_sums_over_distinct_keys_of_a_joined_cube(spark):
    zones = spark.createDataFrame([(0, "x", 1.5), (1, "x", 2.0), (2, None, 4.0), (9, "far", 100.0)], "zone_id int, name string, area double")
    tables = {"trips": trips(spark), "zones": zones}
    fact = [(r.who, r.zone) for r in tables["trips"].select("who", "zone").collect()]
    area = {0: 1.5, 1: 2.0, 2: 4.0}
    q = CubeQuery(("Z.area", "T.n", "Z.mean", "Z.count"), ("T.who",))
    got = CUBES.query(q, tables)
    assert got.columns == ["T_who", "Z_area", "T_n", "Z_mean", "Z_count"]
    for r in got.collect():
        seen = {z for w, z in fact if w == r.T_who and z in area}
        assert (r.Z_area, r.T_n, r.Z_count) == (sum(area[z] for z in seen), sum(w == r.T_who for w, _ in fact), len(seen))
        assert r.Z_mean == pytest.approx(r.Z_area / len(seen))
    assert CUBES.query(CubeQuery(("Z.area",), ()), tables).count() == 1
    total = CUBES.query(CubeQuery(("T.n", "Z.area")), tables).first()
    assert (total.T_n, total.Z_area) == (len(fact), 7.5)
    by_name = {r.Z_name: r.Z_area for r in CUBES.query(CubeQuery(("T.n", "Z.area"), ("Z.name",)), tables).collect()}
    assert by_name == {"x": 3.5, None: 4.0}


def test_the_smallest_rollup_answers(spark, tmp_dir):
    store, tables = rollups.RollupStore(CUBES), {"trips": trips(spark)}
    q = CubeQuery(("T.n",), ("T.who",))
    for name, best in (("day", "day"), ("plain", "plain"), ("quarter", "quarter"), ("small", "small")):
        store.build(spark, "T", name, tables, path=f"{tmp_dir}/{name}")
        assert store.route(q) == ("T", best) and rows(store.query(q, tables)) == rows(CUBES.query(q, tables))
    assert store.route(CubeQuery(("T.n",), ("T.zone",))) == ("T", "plain")
