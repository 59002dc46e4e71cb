"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_path

#: Rows per Arrow batch handed to Python: documents are long (some of them
#: 100 kB and more), so batches stay small and memory stays bounded.
ARROW_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch for the plans built next. A smaller
    value that the caller has set is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: a lost executor re-reads the files instead of repeating the
    work, and later steps see one fixed set of rows."""
    path = scratch_path(df.sparkSession, "llm", label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(rows: int, bytes_per_row: int, limit: int = 32 << 20) -> bool:
    """Whether a table of known row count may be broadcast."""
    return rows * bytes_per_row <= limit


def maybe_broadcast(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows it; beyond the
    bound the join shuffles instead."""
    return F.broadcast(df) if fits_broadcast(rows, bytes_per_row) else df


def unit_hash(*cols: Column) -> Column:
    """A uniform double in [0, 1) from the hash of the columns (repeatable, so
    a recomputed task draws the same numbers)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def spread_of(rows: int) -> int:
    """Salt buckets per key so that even one key with every row splits into
    parts of about sqrt(rows) rows."""
    return max(1, math.isqrt(max(0, rows - 1)) + 1)


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], rank: str, rows: int,
                 salt: Column | None = None) -> DataFrame:
    """0-based gapless rank of the rows within each key, without collecting a
    key into one task: rows are ranked inside (key, salt) parts, and each part
    starts where the parts before it end. Keys must not be null."""
    from pyspark.sql import Window

    parts = spread_of(rows)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(parts)) if salt is None else salt
    df = df.withColumn("__salt", salt.cast("int"))
    part = [*keys, "__salt"]
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*part).orderBy(*order)
    ranked = df.withColumn("__in", F.row_number().over(inside) - 1)
    out = [c for c in df.columns if c != "__salt"]
    return ranked.join(starts, part).select(*out, (F.col("__start") + F.col("__in")).cast("long").alias(rank))
