"""Incremental load past a high-water mark (batch form; see
``meterline.streaming.ingest`` for the file-stream form)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def high_water_mark(spark: SparkSession, target_path: str, ts_col: str, schema: StructType | None = None):
    """Largest ``ts_col`` already loaded, or None for a missing or empty target.
    Anything else (say, a time column that the target does not have) raises:
    taken for an empty target it would load everything again. One aggregate
    row reaches the driver; only the one column is read."""
    try:
        r = spark.read.schema(schema) if schema is not None else spark.read
        target = r.parquet(target_path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return target.agg(F.max(ts_col)).first()[0]


@dataclass(frozen=True)
class Skipped:
    """Source rows that a load past a mark leaves out: at or below the mark
    (among them rows loaded before), and rows without a time."""
    mark: object
    equal: int
    late: int
    null: int


def skipped_rows(source: DataFrame, ts_col: str, mark) -> Skipped:
    """Count what a load past ``mark`` does not pick up, in one pass."""
    ts = F.col(ts_col)
    if mark is None:
        return Skipped(None, 0, 0, 0)
    n = source.agg(F.count(F.when(ts == F.lit(mark), 1)), F.count(F.when(ts < F.lit(mark), 1)), F.count(F.when(ts.isNull(), 1))).first()
    return Skipped(mark, n[0], n[1], n[2])


def incremental_append(spark: SparkSession, source: DataFrame, target_path: str, ts_col: str,
                       partition_by: list[str] | None = None) -> int | None:
    """Append the rows of ``source`` newer than the target's high-water mark.
    The comparison is pushed into the source scan. Rows with a time at or below
    the mark, or without one, are not picked up after the first load (the
    documented pattern's rule): ``skipped_rows`` counts them. The streaming
    form tracks files instead."""
    hwm = high_water_mark(spark, target_path, ts_col)
    new = source if hwm is None else source.where(F.col(ts_col) > F.lit(hwm))
    w = new.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target_path)
    return hwm


def incremental_model(spark: SparkSession, raw: DataFrame, build: Callable[[DataFrame], DataFrame],
                      target_path: str, ts_col: str, partition_by: list[str] | None = None):
    """Incremental materialization of a model (the mart strategy for large
    facts): build the model only from raw rows past the target's high-water
    mark and append them. The raw filter is a plain timestamp comparison,
    so it reaches the Parquet scan and skips old files / row groups; the
    appended partitions are written without touching existing ones.
    Assumes the model keeps ``ts_col`` unchanged from the raw rows."""
    schema = build(raw.limit(0)).schema
    hwm = high_water_mark(spark, target_path, ts_col, schema)
    new = raw if hwm is None else raw.where(F.col(ts_col) > F.lit(hwm))
    w = build(new).write.mode("append")  # not sorted: a task of a time-clustered source has few months open
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target_path)
    return hwm


def read_model(spark: SparkSession, target_path: str, schema: StructType) -> DataFrame:
    """A (partitioned) model table with its declared schema and column order."""
    return spark.read.schema(schema).parquet(target_path).select(*schema.fieldNames())
