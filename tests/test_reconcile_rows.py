"""Keys that differ between two versions of a table, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from meterline.operators import reconcile

SCHEMA = "a long, b string, v double, w string"


def want(left, right):
    def by_key(rows):
        out = defaultdict(Counter)
        for r in rows:
            out[r[:2]][r[2:]] += 1
        return out
    x, y = by_key(left), by_key(right)
    return sorted(((*k, "missing" if k not in y else "extra" if k not in x else "changed", sum(x[k].values()), sum(y[k].values()))
                   for k in {*x, *y} if x.get(k) != y.get(k)), key=str)


@pytest.mark.parametrize(("buckets", "levels"), [(1, 1), (4, 1), (3, 3), (4096, 2)])
def test_exactly_the_differing_keys(spark, buckets, levels):
    rng = random.Random(buckets)
    left = [(rng.choice([None, *range(60)]), rng.choice([None, "", "x"]), rng.choice([None, 0.5, 1.0]), rng.choice([None, "p", "q"])) for _ in range(500)]
    left += [(7, "hot", 1.0, "p")] * 300
    right = [r for r in left if rng.random() > 0.02] + [(1000 + i, "new", None, None) for i in range(5)]
    right = [(a, b, v, "changed") if rng.random() < 0.02 else (a, b, v, w) for a, b, v, w in right]
    right += [(500, None, None, "p"), (501, None, 0.5, None)]
    left += [(500, None, None, "p"), (501, None, None, None)]
    left += [(600, "s", None, "p")]
    right += [(600, "s", None, "p"), (600, "s", None, "p")]  # one more of an equal row
    rng.shuffle(right)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).select("w", "v", "b", "a")
    got = reconcile.differing_keys(a, b, ["a", "b"], buckets, levels)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want(left, right)


def test_nulls_in_other_columns_are_told_apart(spark):
    a, b = spark.createDataFrame([(1, None, None, "p")], SCHEMA), spark.createDataFrame([(1, None, None, None), (2, None, 1.0, None)], SCHEMA)
    b2 = spark.createDataFrame([(1, "p", None, None)], SCHEMA)
    assert {tuple(r)[:3] for r in reconcile.differing_keys(a, b, ["a", "b"]).collect()} == {(1, None, "changed"), (2, None, "extra")}
    assert {r.status for r in reconcile.differing_keys(a, b2, ["a", "b"]).collect()} == {"missing", "extra"}


def test_equal_and_empty(spark):
    a = spark.createDataFrame([(1, "x", 1.0, None)] * 3, SCHEMA)
    assert reconcile.differing_keys(a, a, ["a"]).count() == 0
    assert [tuple(r) for r in reconcile.differing_keys(a, a.limit(0), ["a"]).collect()] == [(1, "missing", 3, 0)]
    assert reconcile.differing_keys(a.limit(0), a.limit(0), ["a"]).count() == 0
