"""Property tests: many generated cases per Spark job, checked against Python."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions import geometry as G
from meterline.functions.columns import exact_total, minute_boundaries, month_boundaries, round_to

EPOCH = dt.datetime(1970, 1, 1)
times = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31))
SETTINGS = settings(max_examples=4, deadline=None)


@SETTINGS
@given(st.lists(st.tuples(times, times), min_size=1, max_size=300))
def test_minute_boundaries_property(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r.v for r in df.select(minute_boundaries("a", "b").alias("v")).collect()]

    def minutes(t):
        return (t - EPOCH) // dt.timedelta(minutes=1)
    assert got == [minutes(b) - minutes(a) for a, b in pairs]


@SETTINGS
@given(st.lists(st.tuples(st.dates(), st.dates()), min_size=1, max_size=300))
def test_month_boundaries_property(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r.v for r in df.select(month_boundaries("a", "b").alias("v")).collect()]
    assert got == [(b.year - a.year) * 12 + b.month - a.month for a, b in pairs]


money = st.decimals(min_value=Decimal("-100000"), max_value=Decimal("100000"), places=6,
                    allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(money, min_size=1, max_size=400), st.integers(1, 9))
def test_exact_total_property(spark, values, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts)
    got = df.agg(exact_total("x").alias("s")).first().s
    want = sum((Decimal(repr(float(v))).quantize(Decimal("0.000001")) for v in values), Decimal(0))
    assert got == want


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=300))
def test_round_to_property(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.v for r in df.select(round_to("x", 4).alias("v")).collect()]
    want = [math.copysign(1.0, x) * math.floor(abs(x) * 10000.0 + 0.5) / 10000.0 if x != 0 else 0.0 for x in xs]
    assert got == want


rect = st.tuples(st.integers(-50, 50), st.integers(-50, 50), st.integers(1, 30), st.integers(1, 30), st.booleans())


@SETTINGS
@given(st.lists(rect, min_size=1, max_size=100))
def test_rectangle_area_and_centroid_property(spark, rects):
    rows = []
    for x, y, w, h, cw in rects:
        ring = [[float(a), float(b)] for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]
        rows.append((ring[::-1] if cw else ring,))
    df = spark.createDataFrame(rows, "ring array<array<double>>")
    polys = F.array(F.array(F.col("ring")))
    got = df.select(G.area(polys).alias("a"), G.centroid(polys).alias("c")).collect()
    for (x, y, w, h, _), r in zip(rects, got):
        assert r.a == w * h
        assert abs(r.c.x - (x + w / 2)) < 1e-9 and abs(r.c.y - (y + h / 2)) < 1e-9


# ---------------------------------------------------------------- cube compiler vs pandas
from meterline.plans.cubes import Cube, CubeQuery, CubeSet, Dimension, Filter, Measure, TimeDimension  # noqa: E402

CUBE = Cube("T", "t",
            dimensions=(Dimension("a", "a"), Dimension("b", "b"), Dimension("ts", "ts", "time")),
            measures=(Measure("n", "count"), Measure("s", "sum", "x"), Measure("m", "avg", "x"),
                      Measure("lo", "min", "x"), Measure("hi", "max", "x")))
rows_st = st.lists(st.tuples(st.sampled_from(["p", "q", "r", None]), st.integers(0, 3),
                             st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 6, 30)),
                             st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=2,
                                                              allow_nan=False, allow_infinity=False))),
                   min_size=1, max_size=200)


def _plain(v):
    """pandas group key -> the Python value Spark returns."""
    import pandas as pd
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v.item() if hasattr(v, "item") else v


@settings(max_examples=8, deadline=None)
@given(rows_st, st.sets(st.sampled_from(["a", "b"])), st.sampled_from([None, "month", "day"]),
       st.sampled_from([None, ("a", "notEquals", ("p",)), ("b", "gte", (2,)), ("a", "set", ())]))
def test_cube_query_matches_pandas(spark, rows, dims, grain, flt):
    import pandas as pd
    data = [(a, b, t, float(x) if x is not None else None) for a, b, t, x in rows]
    df = spark.createDataFrame(data, "a string, b int, ts timestamp_ntz, x double")
    q = CubeQuery(measures=("T.n", "T.s", "T.m", "T.lo", "T.hi"), dimensions=tuple(f"T.{d}" for d in sorted(dims)),
                  time_dimensions=((TimeDimension("T.ts", grain),) if grain else ()),
                  filters=((Filter(f"T.{flt[0]}", flt[1], flt[2]),) if flt else ()))
    got = CubeSet([CUBE], exact_scale=6).query(q, {"t": df}).collect()

    p = pd.DataFrame(data, columns=["a", "b", "ts", "x"])
    if flt:
        col, op, vals = flt
        p = p[{"notEquals": lambda: ~p[col].isin(vals) | p[col].isna(), "gte": lambda: p[col] >= vals[0],
               "set": lambda: p[col].notna()}[op]()]
    keys = sorted(dims)
    if grain:
        p = p.assign(g=p["ts"].dt.to_period("M" if grain == "month" else "D").dt.start_time)
        keys = keys + ["g"]
    want = {}
    groups = p.groupby(keys, dropna=False) if keys else [((), p)]
    for k, g in groups:
        k = k if isinstance(k, tuple) else (k,)
        xs = [v for v in g["x"] if v == v and v is not None]
        total = sum(Decimal(repr(v)) for v in xs) if xs else None
        key = tuple(_plain(v) for v in k)
        want[key] = (len(g), None if total is None else float(total),
                     None if total is None else float(total) / len(xs),
                     min(xs) if xs else None, max(xs) if xs else None)
    have = {tuple(r)[:len(keys)]: tuple(r)[len(keys):] for r in got}
    assert set(have) == set(want)
    for k, (n, s, m, lo, hi) in want.items():
        hn, hs, hm, hlo, hhi = have[k]
        assert hn == n and hlo == lo and hhi == hi
        assert (hs is None and s is None) or abs(hs - s) < 1e-9
        assert (hm is None and m is None) or abs(hm - m) < 1e-9


# ---------------------------------------------------------------- quality suite vs brute force
from meterline.operators import quality as Q  # noqa: E402

child_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)),
                              st.one_of(st.none(), st.sampled_from(["1", "2.0", "3", "x", "13"])),
                              st.one_of(st.none(), st.floats(-5, 25, allow_nan=False))), max_size=120)


@settings(max_examples=8, deadline=None)
@given(child_st, st.sets(st.integers(0, 14), max_size=10))
def test_quality_suite_matches_brute_force(spark, rows, parent_keys):
    child = spark.createDataFrame(rows, "k int, t string, v double")
    parent = spark.createDataFrame([(p,) for p in sorted(parent_keys)] or [(None,)], "pk int")
    checks = [Q.not_null("c", "k"), Q.unique("c", "k"), Q.accepted_values("c", "k", [1, 2, 3]),
              Q.accepted_range("c", "v", 0, 20), Q.row_count_positive("c"),
              Q.relationships("c", "k", "p", "pk"), Q.relationships("c", "t", "p", "pk", "warn")]
    got = {r.test_name: (r.failures, r.status) for r in Q.run_suite({"c": child, "p": parent}, checks).collect()}

    ks = [k for k, _, _ in rows]
    nn = [k for k in ks if k is not None]
    parents = {float(p) for p in parent_keys}

    def num(t):
        try:
            return float(t)
        except ValueError:
            return None
    want = {
        "not_null__c__k": sum(k is None for k in ks),
        "unique__c__k": sum(1 for k in set(nn) if nn.count(k) > 1),
        "accepted_values__c__k": len({k for k in nn if k not in (1, 2, 3)}),
        "accepted_range__c__v": sum(1 for _, _, v in rows if v is not None and not (0 <= v <= 20)),
        "row_count__c": int(len(rows) == 0),
        "relationships__c__k__p": sum(1 for k in nn if float(k) not in parents),
        "relationships__c__t__p": sum(1 for _, t, _ in rows if t is not None and num(t) not in parents),
    }
    assert {k: v[0] for k, v in got.items()} == want
    assert got["relationships__c__t__p"][1] == ("pass" if want["relationships__c__t__p"] == 0 else "warn")
    # without a distinct-count check the model's row and relationship checks share one scan
    fused = [c for c in checks if c.kind != "accepted_values"]
    got2 = {r.test_name: r.failures for r in Q.run_suite({"c": child, "p": parent}, fused).collect()}
    assert got2 == {k: v for k, v in want.items() if k != "accepted_values__c__k"}
