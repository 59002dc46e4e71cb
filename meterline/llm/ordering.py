"""Gapless positions and running sums over a total order, without ever holding
a key in one task: rows are range-partitioned by the whole order, and a short
table says where each (key, partition) run starts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import maybe_broadcast, written

AT = "__at"
PART = "__part"
LOCAL_BITS = 33  # monotonically_increasing_id: partition << 33 | place in it
#: Narrow rows of one partition and file, where the table's size is known.
PART_ROWS = 20_000


def ordered(df: DataFrame, order: list[Column], label: str, rows: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once, plus
    ``__at``: ascending in that order, gapless inside each partition. With
    ``rows``, the counted size of a table of narrow rows, it has no more
    partitions, and so files, than these rows need."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None:
        parts = max(1, min(parts, -(-rows // PART_ROWS)))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(ranged.withColumn(AT, F.monotonically_increasing_id()), label)


def part_of() -> Column:
    return F.shiftright(AT, LOCAL_BITS)


def runs(df: DataFrame, keys: list[str], value: Column | None = None) -> DataFrame:
    """One row for each key and partition of an ``ordered`` table: the keys,
    ``__part``, ``__first`` (the run's least ``__at``), ``__n`` (its rows, or its
    sum of ``value``) and ``__start`` (the same over the key's earlier runs)."""
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    found = df.groupBy(*keys, part_of().alias(PART)).agg(total.cast("long").alias("__n"), F.min(AT).alias("__first"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("long"))


def with_runs(df: DataFrame, starts: DataFrame, keys: list[str], rows: int, bytes_per_row: int = 256) -> DataFrame:
    """An ``ordered`` table with the columns that ``starts`` has beside the keys
    (null keys meet null keys). ``rows`` is the counted size of ``starts``."""
    names = {k: f"__run_{k}" for k in keys}
    right = starts.withColumnsRenamed({**names, PART: "__run_part"})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], part_of() == F.col("__run_part"))
    return df.join(maybe_broadcast(right, rows, bytes_per_row), same).drop("__run_part", *names.values())


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with ``name``: the 0-based gapless place of a row among those of
    its key. ``order`` must begin with the keys and tell all rows apart that
    are not interchangeable."""
    rows = ordered(df, order, label)
    starts = written(runs(rows, keys).select(*keys, PART, "__first", "__start"), f"{label}_runs")
    placed = with_runs(rows, starts, keys, starts.count())
    return placed.withColumn(name, F.col("__start") + F.col(AT) - F.col("__first")).drop(AT, "__first", "__start")


def running_sum(rows: DataFrame, starts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """An ``ordered`` table with ``name``, the sum of ``value`` over the earlier
    rows of the key, and the other columns of ``starts``: its ``runs`` of that
    value, written, with more columns if wanted."""
    placed = with_runs(rows, starts.drop("__n", "__first"), keys, starts.count()).withColumn(PART, part_of())
    before = Window.partitionBy(PART, *keys).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(before), F.lit(0))  # a part holds a bounded share of any key
    return placed.withColumn(name, (F.col("__start") + local).cast("long")).drop("__start", PART)
