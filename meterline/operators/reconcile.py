"""Row-level reconciliation of two versions of a table: which keys differ.

Both sides are reduced to one digest per bucket of the key's hash: the row count
and the sums of two 64-bit row hashes, which need no order and aggregate
partially, so the shuffle carries one row per task and bucket. Only buckets whose
digests differ are looked at again, with finer buckets; only rows of the
last differing buckets are reduced to digests per key. Rows of the two sides are
never joined: both go through one aggregation, side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.defaults import BROADCAST_MAX_ROWS
from meterline.session import scratch_path

SIDE = "__right"
#: Buckets of the first level, and parts into which each level splits them.
BUCKETS = 4096
LEVELS = 2

def _row_hash(columns: list[str], salt: int) -> Column:
    """A hash that tells null from absent: a null alone leaves xxhash64 unchanged."""
    parts: list[Column] = [F.lit(salt)]
    for c in columns:
        parts += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def _bucket(keys: list[str], level: int, buckets: int) -> Column:
    return F.pmod(_row_hash(keys, 100 + level).cast("bigint"), F.lit(buckets)).cast("int")


def _differing(both: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The values of ``by`` whose digests differ between the sides of ``both``, with
    both sides' row counts: one aggregation serves both sides."""
    mine = {"left": ~F.col(SIDE), "right": F.col(SIDE)}
    aggs = [F.count_if(c).alias(f"{s}_rows") for s, c in mine.items()]
    for s, c in mine.items():
        aggs += [F.coalesce(F.sum(F.when(c, _row_hash(columns, salt))), F.lit(0)).alias(f"{s}_sum{salt}") for salt in (1, 2)]
    same = (F.col("left_rows") == F.col("right_rows")) & (F.col("left_sum1") == F.col("right_sum1")) & (F.col("left_sum2") == F.col("right_sum2"))
    return both.groupBy(*by).agg(*aggs).where(~same).select(*by, "left_rows", "right_rows")


def differing_keys(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS, levels: int = LEVELS) -> DataFrame:
    """One row per key whose rows differ: the key, ``status`` (``missing``: only in
    ``left``; ``extra``: only in ``right``; ``changed``), and both sides' number of
    rows. Null keys are keys; rows that share a key are compared as a
    multiset. All columns of ``left`` take part, which ``right`` must have too.

    The buckets that differ at the first level (at most ``buckets``) are broadcast;
    a level further splits each of them ``buckets``-fold, and its list is written
    and counted before it is broadcast or, beyond the bound, joined by shuffle."""
    columns, spark = list(left.columns), left.sparkSession
    names = [f"__bucket{i}" for i in range(levels)]
    places = [_bucket(keys, i, buckets).alias(n) for i, n in enumerate(names)]
    both = left.select(*columns, F.lit(False).alias(SIDE), *places).unionByName(right.select(*columns, F.lit(True).alias(SIDE), *places))
    for i in range(levels):
        by = names[:i + 1]
        hot = _differing(both, by, columns).select(*by)
        if i:
            path = scratch_path(spark, "reconcile")
            hot.write.parquet(path)
            hot = spark.read.schema(hot.schema).parquet(path)
        both = both.join(F.broadcast(hot) if i == 0 or hot.count() <= BROADCAST_MAX_ROWS else hot, by, "left_semi")
    found = _differing(both, keys, columns)
    status = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "extra").otherwise("changed")
    return found.select(*keys, status.alias("status"), "left_rows", "right_rows")
