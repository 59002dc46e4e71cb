"""Plan shape: dimensions broadcast behind checks, filters reach the scan,
no estimate-based broadcast of a fact, one shuffle per group-by."""

import re
import contextlib
import io

import pytest

from meterline.operators import topk
from meterline.plans.warehouse import TripWarehouse
from meterline.sources.sinks import full_refresh
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def parquet_wh(spark, tmp_path_factory):
    """Warehouse whose raw trips are a Parquet table (as in production)."""
    w = TripWarehouse.from_testdata(spark, SF001)
    base = str(tmp_path_factory.mktemp("raw"))
    trips = full_refresh(w.raw_trips(), f"{base}/trips")
    zones = full_refresh(w.raw_zones(), f"{base}/zones")
    return TripWarehouse(spark, raw_trips_fn=lambda: trips, raw_zones_fn=lambda: zones,
                         zone_geojson_fn=w.zone_geojson_fn, date_min=w.date_min, date_max=w.date_max)


def test_fact_joins_are_broadcast_and_filter_is_pushed(parquet_wh):
    p = plan(parquet_wh.fct_trips())
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert p.count("BroadcastHashJoin LeftOuter") == 5
    assert "hashpartitioning" not in p  # nothing is shuffled, the proven dimensions neither
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1996-01-01T00:00)" in p
    assert "LessThan(tpep_pickup_datetime,2000-06-01T00:00)" in p


def test_top_boroughs_single_shuffle_and_take_ordered(parquet_wh):
    p = plan(topk.top_boroughs(parquet_wh.fct_trips()))
    tree = p.split("\n\n")[0]
    assert "TakeOrderedAndProject" in tree
    assert re.findall(r"hashpartitioning\((\w+)#", p) == ["pickup_borough"]  # the groups only
    assert "partial_count" in p                         # map-side combine before the shuffle


def test_column_pruning_reaches_scan(parquet_wh):
    p = plan(parquet_wh.stg_trips().select("pickup_hour"))
    assert "ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz>" in p


def test_no_estimate_based_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_large_dimension_is_not_broadcast(spark):
    from meterline.functions.joins import dimension
    big = spark.range(0, 50)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    hinted = dimension(big, max_rows=10)
    assert "broadcast" not in hinted._jdf.queryExecution().analyzed().toString().lower()
    small = dimension(spark.range(0, 5), max_rows=10)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    wide = spark.range(0, 5).selectExpr("repeat('x', 1000) AS s")
    assert "broadcast" not in dimension(wide, max_rows=10, max_bytes=2000)._jdf.queryExecution().analyzed().toString().lower()


def test_sizing_scales_with_input():
    from meterline.session import sizing
    small = sizing(10 * 1024 ** 3, total_cores=64)
    huge = sizing(100 * 1024 ** 4, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64
    assert int(huge["spark.sql.shuffle.partitions"]) == 50 * 8000      # clamped: 50 waves
    mid = sizing(2 * 1024 ** 4, total_cores=1000)                       # 2 TB -> ~24.6k partitions
    assert 3000 < int(mid["spark.sql.shuffle.partitions"]) < 50_000
    assert huge["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)


def test_shuffle_join_fallback_matches_broadcast(spark, parquet_wh):
    """Dimensions over the bound are joined by shuffle (AQE handles hot keys);
    results are the same as with the broadcast plans."""
    from meterline.operators import models as M
    from meterline.operators import quality as Q
    stg, zones = parquet_wh.stg_trips(), parquet_wh.stg_zones()
    b = M.zone_role_join(stg, zones)
    s = M.zone_role_join(stg, zones, max_rows=1)
    p = plan(s)
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert sorted(map(repr, b.collect())) == sorted(map(repr, s.collect()))
    models_ = {"c": stg, "z": zones}
    ch = [Q.relationships("c", "PULocationID", "z", "LocationID"), Q.relationships("c", "DOLocationID", "z", "LocationID")]
    fb = Q.relationship_failures_fused(stg, ch, models_).collect()
    fs = Q.relationship_failures_fused(stg, ch, models_, broadcast_rows=1).collect()
    assert fb == fs


def test_unused_lookups_leave_the_plan(spark, parquet_wh):
    """A lookup has one row per key, so a left join that gives no column goes."""
    fct = parquet_wh.fct_trips()
    assert "Join" not in plan(fct.select("trip_distance", "fare_per_mile"))
    assert "Join" not in plan(fct.agg({"*": "count"}))
    assert "Join" not in plan(fct.agg({"total_amount_mismatch_flag": "sum"}))
    assert plan(fct.groupBy("pickup_borough").count()).count("BroadcastHashJoin LeftOuter") == 1


def test_repeated_lookup_keys_do_not_multiply_the_fact(spark):
    from meterline.functions.joins import one_per_key
    dim = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1)], "k int, name string, x int")
    assert sorted(map(tuple, one_per_key(dim, "k").collect())) == [(1, "a", 9), (2, None, 1)]


def test_month_predicate_prunes_the_written_fact(spark, parquet_wh, tmp_dir):
    from meterline.plans.cube_defs import ALL_CUBES
    from meterline.plans.cubes import CubeQuery, TimeDimension
    from meterline.sources.sinks import full_refresh
    fct = full_refresh(parquet_wh.fct_trips(), f"{tmp_dir}/fct", ["pickup_year", "pickup_month"])
    q = CubeQuery(("TaxiTrips.tripCount",), time_dimensions=(TimeDimension("TaxiTrips.pickupDatetime", None, ("1998-03-01", "1998-03-31")),))
    df = ALL_CUBES.query(q, {"fct_taxi_trips": fct})
    filters = re.search(r"PartitionFilters: \[(.*?)\]\n", plan(df))
    assert filters and "pickup_month" in filters[1]
    want = parquet_wh.fct_trips().where("pickup_year = 1998 and pickup_month = 3").count()
    assert df.first()[0] == want
