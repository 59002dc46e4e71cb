from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from meterline.llm import sharding


def test_exact_sizes_and_gapless_slots(spark):
    df = spark.range(1003).repartition(7).withColumn("text", F.when(F.col("id") % 3 == 0, None).otherwise("same")).withColumn("shard", F.lit("old"))
    got = sharding.shuffle_into_shards(df, 10).collect()
    assert sorted(r.id for r in got) == list(range(1003))
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(10)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(10):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_more_shards_than_rows_repeats_and_empty(spark):
    few = spark.createDataFrame([(1, None), (1, None), (1, None)], "id long, text string")
    assert sorted((r.shard, r.slot) for r in sharding.shuffle_into_shards(few, 5).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shuffle_into_shards(few.limit(0), 5).count() == 0


def test_order_is_uniform(spark):
    """Where one input row lands, over many seeds: every shard equally often, and
    neighbours are separated as by a uniform shuffle."""
    df = spark.range(40).coalesce(1).repartition(4)
    hits, together = Counter(), 0
    for seed in range(8):
        at = {r.id: r.shard for r in sharding.shuffle_into_shards(df, 4, seed).collect()}
        hits.update(at.values())
        together += sum(at[i] == at[i + 1] for i in range(39))
    assert hits == Counter(dict.fromkeys(range(4), 80))
    assert abs(together / (8 * 39) - 9 / 39) < 0.09


def test_hypergeometric_law(spark):
    n = 20000
    draws = spark.range(n).select(sharding.hypergeometric(F.lit(30).cast("long"), F.lit(50).cast("long"), F.lit(20).cast("long"), (F.col("id") + 0.5) / n).alias("k"))
    got = Counter(r.k for r in draws.collect())
    from math import comb
    for k in range(21):
        assert abs(got[k] / n - comb(30, k) * comb(50, 20 - k) / comb(80, 20)) < 2e-4


def test_hypergeometric_edges_and_large_numbers(spark):
    rows = [(0, 5, 3), (5, 0, 3), (5, 5, 0), (5, 5, 10), (0, 0, 0), (1, 0, 1), (10**9, 39 * 10**9, 20 * 10**9)]
    df = spark.createDataFrame(rows, "g long, b long, n long").crossJoin(spark.createDataFrame([(0.0,), (0.37,), (0.999999999,)], "u double"))
    for r in df.withColumn("k", sharding.hypergeometric(F.col("g"), F.col("b"), F.col("n"), F.col("u"))).collect():
        assert max(0, r.n - r.b) <= r.k <= min(r.g, r.n)
        if r.g == 10**9:
            assert abs(r.k - 5 * 10**8) < 12 * 15700


def test_matrix_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FANOUT", 3)
    n = [int(x) for x in np.random.default_rng(1).integers(0, 50, 20)]
    sizes = spark.createDataFrame(list(enumerate(n)), "node long, n long")
    got = {r.node: r.take for r in sharding.communication_matrix(sizes, 20, sum(n), 6, 1).collect()}
    assert {i: sum(t) for i, t in got.items()} == dict(enumerate(n))
    columns = [sum(t[j] for t in got.values()) for j in range(6)]
    assert max(columns) - min(columns) <= 1 and sum(columns) == sum(n)


def test_no_python_in_the_plan(spark):
    df = sharding.shuffle_into_shards(spark.range(50), 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
