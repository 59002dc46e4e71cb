"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix, in DataFrame operations only.

1. Every input partition permutes its rows (a local sort by a hash) and is
   written once, so partition sizes and local ranks are fixed for good.
2. The matrix "rows of partition i that go to shard j" is drawn exactly: row
   after row it is a multivariate hypergeometric sample of what the shards
   still have to receive. Partitions are drawn in groups of ``FANOUT``, level
   by level, so no step handles more than ``FANOUT`` children.
3. A row goes to the shard whose interval of the matrix row holds its local
   rank: one exchange, whose targets have exactly the wanted sizes.
4. Each shard permutes what it received; ``slot`` is the place.

All randomness comes from hashes of (seed, place), so recomputed tasks draw
the same numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import maybe_broadcast, unit_hash, written

FANOUT = 64
PART_ROWS = 1 << 14
MATRIX_MB = 32


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9 (error below 1e-12)."""
    z = n.cast("double") + 9.0
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    shift = F.ln((z - 1) * (z - 2)) + F.ln((z - 3) * (z - 4)) + F.ln((z - 5) * (z - 6)) + F.ln((z - 7) * (z - 8))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """The number of good ones among ``draws`` draws without replacement, from
    one uniform ``u``: inversion from the mode outward, over 12 standard
    deviations either way (what lies beyond is below the resolution of ``u``).
    The result always lies in the distribution's support."""
    g, b, n = good.cast("double"), bad.cast("double"), draws.cast("double")
    total = g + b
    low, high = F.greatest(F.lit(0.0), n - b), F.least(g, n)
    mode = F.least(high, F.greatest(low, F.floor((n + 1) * (g + 1) / (total + 2)).cast("double")))
    p = F.exp(_log_choose(g, mode) + _log_choose(b, n - mode) - _log_choose(total, n))
    deviation = F.sqrt(n * g * b * (total - n)) / F.greatest(total, F.lit(1.0))
    steps = F.least(F.greatest(high - mode, mode - low), F.ceil(12 * deviation / F.sqrt(F.greatest(total - 1, F.lit(1.0))) + 24)).cast("int")
    start = F.struct(mode.alias("up"), p.alias("p_up"), mode.alias("down"), p.alias("p_down"), (u - p).alias("left"), mode.alias("k"), (u < p).alias("done"))

    def outward(s: Column, _: Column) -> Column:
        up, down = s["up"], s["down"]
        p_up = s["p_up"] * (g - up) * (n - up) / ((up + 1) * (b - n + up + 1))
        p_up = F.when(up < high, p_up).otherwise(F.lit(0.0))
        p_down = s["p_down"] * down * (b - n + down) / ((g - down + 1) * (n - down + 1))
        p_down = F.when(down > low, p_down).otherwise(F.lit(0.0))
        after_up, after = s["left"] - p_up, s["left"] - p_up - p_down
        hit_up, hit_down = (p_up > 0) & (after_up < 0), (p_down > 0) & (after < 0)
        return F.when(s["done"], s).otherwise(F.struct(
            F.least(high, up + 1).alias("up"), p_up.alias("p_up"), F.greatest(low, down - 1).alias("down"), p_down.alias("p_down"), after.alias("left"),
            F.when(hit_up, up + 1).when(hit_down, down - 1).otherwise(s["k"]).alias("k"), (hit_up | hit_down).alias("done")))

    walk = F.aggregate(F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), start, outward)
    return walk["k"].cast("long")


def _draw_children(children: Column, wanted: Column, total: Column, seed: int, level: int) -> Column:
    """Split ``wanted`` (rows per shard) over ``children`` (structs node, n):
    an array of (node, n, take), where take sums to n per child and to
    ``wanted`` per shard."""
    row0 = F.struct(wanted.alias("left"), total.alias("rows"),
                    F.array().cast("array<struct<node:bigint,n:bigint,take:array<bigint>>>").alias("out"))

    def child(s: Column, c: Column) -> Column:
        cell0 = F.struct(c["n"].alias("draws"), s["rows"].alias("rows"), F.array().cast("array<bigint>").alias("take"))

        def cell(t: Column, good: Column) -> Column:
            rest = t["rows"] - good
            k = hypergeometric(good, rest, t["draws"], unit_hash(F.lit(seed), F.lit(level), c["node"], F.size(t["take"])))
            return F.aggregate(F.array(k), t, lambda t0, k0: F.struct(
                (t0["draws"] - k0).alias("draws"), (t0["rows"] - good).alias("rows"), F.concat(t0["take"], F.array(k0)).alias("take")))

        take = F.aggregate(s["left"], cell0, cell)["take"]
        return F.aggregate(F.array(take), s, lambda s0, t0: F.struct(
            F.zip_with(s0["left"], t0, lambda a, b: a - b).alias("left"), (s0["rows"] - c["n"]).alias("rows"),
            F.concat(s0["out"], F.array(F.struct(c["node"].alias("node"), c["n"].alias("n"), t0.alias("take")))).alias("out")))

    return F.aggregate(children, row0, child)["out"]


def communication_matrix(sizes: DataFrame, partitions: int, rows: int, shards: int, seed: int) -> DataFrame:
    """From (node, n) of every partition: (node, take), the rows that it sends
    to each shard. Shard sizes differ by one at most."""
    depth = 1
    while FANOUT ** depth < partitions:
        depth += 1
    levels = [sizes.select(F.col("node").cast("long").alias("node"), "n")]
    for _ in range(depth - 1):
        below = levels[-1]
        levels.append(below.groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(F.sum("n").alias("n")))
    wanted = [rows // shards + (j < rows % shards) for j in range(shards)]
    above = None
    for level in range(depth - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.struct("node", "n")))  # at most FANOUT of them
        parent = F.floor(F.col("node") / FANOUT) if level < depth - 1 else F.lit(0).cast("long")
        groups = levels[level].groupBy(parent.alias("parent")).agg(children.alias("children"), F.sum("n").alias("rows"))
        if above is None:
            groups = groups.withColumn("wanted", F.array(*[F.lit(w).cast("long") for w in wanted]))
        else:
            groups = groups.join(above.select(F.col("node").alias("parent"), F.col("take").alias("wanted")), "parent")
        drawn = groups.select(F.explode(_draw_children(F.col("children"), F.col("wanted"), F.col("rows"), seed, level)).alias("c"))
        above = drawn.select("c.node", "c.take")
    return above


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """``df`` in uniformly random order over ``shards`` shards whose row counts
    differ by one at most: all its columns plus ``shard`` (from 0) and ``slot``
    (gapless from 0 in each shard).

    Values play no part, so nulls, repeated rows, ties and hot keys are rows
    like any others. Old columns ``shard`` and ``slot`` are replaced. An empty
    table gives an empty result; with fewer rows than shards some shards stay
    empty."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    place = F.monotonically_increasing_id()
    local = (df.select(*columns, F.xxhash64(F.lit(seed), place).alias("__key")).sortWithinPartitions("__key").drop("__key")
             .withColumn("__at", F.monotonically_increasing_id()))  # partition << 33 | local rank
    fixed = written(local, "shard_input")
    node = F.shiftright("__at", 33)
    sizes = fixed.groupBy(node.alias("__source")).agg(F.count(F.lit(1)).alias("n"))
    dense = written(sizes, "shard_sizes")
    total = dense.agg(F.count(F.lit(1)), F.sum("n"), F.max("__source")).first()
    sources, rows, top = total[0], total[1] or 0, total[2] or 0
    matrix = communication_matrix(dense.withColumnRenamed("__source", "node"), top + 1, rows, shards, seed)
    ends = F.aggregate("take", F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))
    cuts = written(matrix.select(F.col("node").alias("__source"), ends.alias("__ends")), "shard_matrix")
    rank = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    to = F.size(F.filter("__ends", lambda e: e <= F.col("__rank")))
    parts = max(1, -(-rows // (shards * PART_ROWS)))  # a shard is permuted in parts of about PART_ROWS rows
    u = unit_hash(F.lit(seed + 1), F.col("__at"))
    sent = (fixed.withColumn("__source", node).withColumn("__rank", rank)
            .join(maybe_broadcast(cuts, sources, 8 * shards + 16), "__source")
            .select(*columns, "__at", to.cast("int").alias("shard"), u.alias("__u"))
            .withColumn("__part", F.floor(F.col("__u") * parts).cast("int")))
    lean = (fixed.select("__at").withColumn("__source", node).withColumn("__rank", rank)
            .join(maybe_broadcast(cuts, sources, 8 * shards + 16), "__source")
            .select(to.cast("int").alias("shard"), F.floor(u * parts).cast("int").alias("__part")))
    sums = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (lean.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
              .select("shard", "__part", F.coalesce(F.sum("__n").over(sums), F.lit(0)).alias("__start")))
    inside = Window.partitionBy("shard", "__part").orderBy("__u", "__at")
    return (sent.withColumn("__in", F.row_number().over(inside) - 1).join(starts, ["shard", "__part"])
            .select(*columns, "shard", (F.col("__start") + F.col("__in")).cast("long").alias("slot")))
