"""Join helpers: broadcast a dimension only behind a size check."""

from __future__ import annotations

import threading
import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.defaults import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

# Size proofs already made in this process: (plan hash, input files, bound) -> bool.
# A proof holds for the same plan over the same files, so repeated model
# builds do not re-run the bounded count.
_PROOFS: dict[tuple, bool] = {}
_LOCK = threading.Lock()


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Bounded check of rows AND approximate bytes (length of each row as
    JSON text, which over-counts numbers and matches strings), reading at
    most ``max_rows + 1`` rows, never the whole table."""
    try:
        key = (df.semanticHash(), tuple(sorted(df.inputFiles())), max_rows, max_bytes)
    except Exception:  # plans without a stable hash: always count
        key = None
    if key is not None:
        with _LOCK:
            if key in _PROOFS:
                return _PROOFS[key]
    head = df.limit(max_rows + 1)
    row = head.select(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns]))).alias("b")) \
              .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    ok = row["n"] <= max_rows and (row["b"] or 0) <= max_bytes
    if key is not None and key[1]:  # only memoize file-backed plans
        with _LOCK:
            _PROOFS[key] = ok
    return ok


def dimension(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
              max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for a broadcast join when it is proven small.

    Beyond the bound the join stays a shuffle join, where AQE's skew-join
    split handles hot keys on the large side."""
    return F.broadcast(df) if has_at_most(df, max_rows, max_bytes) else df


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per join key, the smallest if there are several. Of a table whose
    keys are proven unique the same rows; but Catalyst then knows it, and drops
    the left join of a lookup none of whose columns is used."""
    rest = [c for c in dim.columns if c != key]
    row = F.min(F.struct(*rest)).alias("_row")
    return dim.groupBy(key).agg(row).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def key_is_unique(df: DataFrame, key: str, literal: DataFrame | None = None) -> bool:
    """Whether no non-null key of a small table occurs twice: counted, or known
    from the rows if the table was made from the literal rows of ``literal``."""
    if literal is not None and literal in _LITERALS:
        return key in _LITERALS[literal]
    try:
        known = ("unique", df.semanticHash(), key, tuple(sorted(df.inputFiles())))
    except Exception:  # plans without a stable hash: always count
        known = None
    if known is not None:
        with _LOCK:
            if known in _PROOFS:
                return _PROOFS[known]
    ok = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if known is not None and known[3]:
        with _LOCK:
            _PROOFS[known] = ok
    return ok


def lookup(df: DataFrame, key: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The right side of a left join on ``key``, proven on the table itself, once:
    small tables are broadcast, and if their keys are unique the plan says so. A
    repeated key multiplies the left rows, as any left join does."""
    if not has_at_most(df, max_rows):
        return df
    return F.broadcast(one_per_key(df.coalesce(1), key) if key_is_unique(df, key) else df)  # small, so one task groups it


def literal_dimension(df: DataFrame) -> DataFrame:
    """Broadcast a dimension built from literal rows (its size is fixed in code)."""
    return F.broadcast(df)


# tables made from rows in code -> their columns without repeated values
_LITERALS: "weakref.WeakKeyDictionary[DataFrame, frozenset[str]]" = weakref.WeakKeyDictionary()


def literal_frame(spark, rows: list, schema) -> DataFrame:
    """A DataFrame of rows given in code; marked so size checks skip counting."""
    df = spark.createDataFrame(rows, schema)
    _LITERALS[df] = frozenset(c for i, c in enumerate(df.columns) if len({row[i] for row in rows}) == len(rows))
    return df


def is_literal(df: DataFrame) -> bool:
    return df in _LITERALS
