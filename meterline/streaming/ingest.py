"""Incremental ingest of newly arrived files with Structured Streaming.

The file source remembers which files it has processed in the checkpoint,
and the Parquet sink commits each batch atomically through its own log,
so re-running after new files land (or after a lost executor / driver
restart) processes every file exactly once. ``availableNow`` drains what
is there in rate-limited batches and stops: a scheduled incremental job.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest_new_files(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                     checkpoint: str, fmt: str = "parquet", ingested_at: dt.datetime | None = None,
                     max_files_per_trigger: int | None = None, partition_by: list[str] | None = None) -> None:
    """Process every file in ``source_dir`` not yet seen, then stop."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if ingested_at is not None:
        stream = stream.withColumn("_ingested_at", F.lit(ingested_at).cast("timestamp_ntz"))
    writer = (stream.writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_model(spark: SparkSession, source_dir: str, schema: StructType,
                 transform: Callable[[DataFrame], DataFrame], sink_dir: str, checkpoint: str,
                 partition_by: list[str] | None = None, max_files_per_trigger: int | None = None) -> None:
    """Incremental model build on a file stream: each batch of new raw files
    goes through ``transform`` (stateless per row: casts, filters and
    stream-static joins to broadcast dimensions) and is appended to the
    model's Parquet sink, exactly once; then the query stops."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = transform(reader.load(source_dir))
    writer = (out.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Committed rows of the sink (files listed in its log only)."""
    return spark.read.parquet(sink_dir)
