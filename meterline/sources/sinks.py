"""Sinks and layers: full-refresh tables, raw/dev/prod layers, namespaces.

A layer is a base folder (or catalog database) holding ``schema/table``
Parquet datasets. Writing a model and reading it back is how a "table"
materialization cuts the lineage of the plan that built it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def _writer(df: DataFrame, partition_by: list[str] | None, fmt: str,
            max_records_per_file: int | None, distribute: str = "rebalance"):
    if partition_by:
        if distribute == "rebalance":
            # Unclustered input: without a shuffle every task writes a file
            # per partition value (tasks x months small files), and a plain
            # repartition by the partition columns would put a hot month
            # into one task. The rebalance hint lets AQE split skewed and
            # merge small partitions.
            df = df.hint("rebalance", *partition_by)
        elif distribute == "local":
            # Input already clustered by the partition columns (e.g. one
            # source file per month): no shuffle, one open writer per task.
            df = df.sortWithinPartitions(*partition_by)
        elif distribute != "none":
            raise ValueError(f"distribute must be rebalance, local or none: {distribute}")
    w = df.write.mode("overwrite").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.partitionBy(*partition_by) if partition_by else w


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 fmt: str = "parquet", max_records_per_file: int | None = None,
                 distribute: str = "rebalance") -> DataFrame:
    """Replace the whole dataset at ``path`` and return a scan of it.

    The new dataset is written beside the old one and takes its place by
    renaming once the write has succeeded; a failed write leaves the old rows
    where they are. Between the two renames the path is absent for a moment,
    and on object stores a rename copies. A lost executor only re-runs its
    tasks."""
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    _writer(df, partition_by, fmt, max_records_per_file, distribute).save(fresh)
    _swap(df.sparkSession, fresh, path.rstrip("/"))
    # declared schema: an empty result has no files to infer one from, and
    # partition columns come back in the original column order
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path).select(*df.columns)


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put ``fresh`` in the place of ``path`` through Hadoop's file system API."""
    jvm = spark._jvm
    new, at, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path, f"{fresh}.old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = fs.exists(at)
    if replaced and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        if replaced:
            fs.rename(old, at)
        raise OSError(f"cannot move {fresh} to {path}")
    if replaced:
        fs.delete(old, True)


def full_refresh_table(df: DataFrame, table: str, partition_by: list[str] | None = None,
                       max_records_per_file: int | None = None) -> DataFrame:
    """Replace a catalog table (``schema.table``) and return it."""
    _writer(df, partition_by, "parquet", max_records_per_file).saveAsTable(table)
    return df.sparkSession.table(table)


def schema_name(target: str, custom: str | None) -> str:
    """A model's custom schema is appended to the target's: ``main`` + ``mart`` -> ``main_mart``."""
    return f"{target}_{custom}" if custom else target


def create_namespaces(spark: SparkSession, names: list[str]) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`")


@dataclass(frozen=True)
class Layer:
    """One database layer (raw, dev, prod) under a base folder."""
    name: str
    base: str

    def path(self, schema: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{self.name}/{schema}/{table}"

    def write(self, df: DataFrame, schema: str, table: str,
              partition_by: list[str] | None = None, distribute: str = "rebalance") -> DataFrame:
        return full_refresh(df, self.path(schema, table), partition_by, distribute=distribute)

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.parquet(self.path(schema, table))


def copy_layer(spark: SparkSession, src: Layer, dst: Layer, schema: str, tables: list[str]) -> dict[str, DataFrame]:
    """Copy named tables from one layer to another (full refresh each).
    A distributed read/write per table: data never passes the driver."""
    return {t: dst.write(src.read(spark, schema, t), schema, t) for t in tables}
