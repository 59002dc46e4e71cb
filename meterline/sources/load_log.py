"""Incremental loads with a stored load state, and repair of late data.

The mark of a plain high-water load (``sources.incremental``) loses rows that
arrive late, tie with the mark or have no time. Here a load log beside the
target says, for every source file that was loaded, in which month partitions
its rows fell. A load

1. lists the source files and compares them with the log (path, length, time of
   change): new, changed and vanished ones are found without reading any rows;
2. reads the time column of the new files only, and learns the months they touch,
   whatever their rows' times are: late, tied, null;
3. rebuilds these months, and those that changed or vanished files touched
   before, from the source (a plain condition on the time column, pushed into the
   scan) and puts them into the target by dynamic partition overwrite;
   files of other months stay as they are;
4. publishes its entry in the log, last and by a rename.

A load that dies between 3 and 4 is repeated by the next one with the same
result. Only file names and months reach the driver, which lists files anyway."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.sources.raw_layer import publish

Month = tuple[int | None, int | None]

LOG_SCHEMA = ("batch BIGINT, file STRING, length BIGINT, modified TIMESTAMP, year INT, month INT, "
              "rows BIGINT, late BIGINT, tied BIGINT, latest TIMESTAMP_NTZ, present BOOLEAN")


@dataclass(frozen=True)
class Load:
    """What a load did: its number (None if there was nothing to do), the mark
    before it, the files it read, the months it rebuilt, and the rows that
    arrived: all, before the mark, at the mark, and without a time."""
    batch: int | None
    mark: object = None
    files: int = 0
    months: list[Month] = field(default_factory=list)
    rows: int = 0
    late: int = 0
    tied: int = 0
    null: int = 0


def in_months(ts: Column, months: list[Month]) -> Column:
    """Whether a time lies in one of the months: ranges of the plain column, so
    that the scan can skip files and row groups. Adjacent months are one range."""
    known = sorted(12 * y + m - 1 for y, m in months if y is not None and m is not None)
    out = F.lit(False)
    at = 0
    while at < len(known):
        end = at
        while end + 1 < len(known) and known[end + 1] == known[end] + 1:
            end += 1
        lo, hi = known[at], known[end] + 1
        bounds = [F.lit(f"{k // 12:04d}-{k % 12 + 1:02d}-01 00:00:00").cast("timestamp_ntz") for k in (lo, hi)]
        out = out | ((ts >= bounds[0]) & (ts < bounds[1]))
        at = end + 1
    return out | ts.isNull() if (None, None) in months else out


def source_files(spark: SparkSession, source: str) -> DataFrame:
    """(file, path, length, modified) of the Parquet files under ``source``, in
    sub-folders too: metadata only, nothing of their contents. ``file`` is the
    name that ``_metadata`` gives a row's file (escaped), ``path`` the one to read by."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(source)
            .select(F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified")))


def _read(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Every entry of every published batch."""
    try:
        return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def loaded_files(entries: DataFrame) -> DataFrame:
    """The log's newest word on each file that is still part of the target."""
    newest = Window.partitionBy("file")
    return entries.withColumn("last", F.max("batch").over(newest)).where("batch = last and present").drop("last")


def _arrived(spark: SparkSession, schema: StructType, paths: list[str], ts_col: str, mark, batch: int, listing: DataFrame) -> DataFrame:
    """The log entries of new files: rows by file and month."""
    ts = F.col(ts_col)
    late, tied = (F.lit(0).cast("bigint"),) * 2 if mark is None else (F.count_if(ts < F.lit(mark)), F.count_if(ts == F.lit(mark)))
    rows = _read(spark, schema, *paths)
    per = (rows.groupBy(F.col("_metadata.file_path").alias("file"), F.year(ts).alias("year"), F.month(ts).alias("month"))
           .agg(F.count(F.lit(1)).alias("rows"), late.alias("late"), tied.alias("tied"), F.max(ts).cast("timestamp_ntz").alias("latest")))
    # a file without rows is loaded too
    return (listing.where(F.col("path").isin(paths)).join(per, "file", "left")
            .select(F.lit(batch).cast("bigint").alias("batch"), "file", "length", "modified", "year", "month",
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows", "late", "tied")], "latest", F.lit(True).alias("present")))


def load_months(spark: SparkSession, source: str, schema: StructType, build: Callable[[DataFrame], DataFrame], target: str, log: str,
                ts_col: str, partition_by: tuple[str, str]) -> Load:
    """Bring the model at ``target`` up to date with the Parquet files under
    ``source`` and return what was done; see the module text for how.

    ``build`` makes the model's rows from source rows; it must keep a row's month,
    in the columns ``partition_by`` (year, month). Null times are a month of
    their own, whose rows a model may drop."""
    listing = source_files(spark, source)
    entries = read_log(spark, log)
    state = entries.agg(F.max("batch"), F.max("latest")).first()
    batch, mark = (state[0] or 0) + 1, state[1]
    known = loaded_files(entries)
    old = known.select("file", F.col("length").alias("l"), F.col("modified").alias("m")).distinct()
    both = listing.join(old, "file", "full").select("file", "path", F.col("length").isNotNull().alias("present"),
                                                    ((F.col("length") == F.col("l")) & (F.col("modified") == F.col("m"))).alias("same"))
    changes = both.where("same is null or not same").collect()
    fresh, gone = sorted(r.path for r in changes if r.present), sorted(r.file for r in changes if not r.present)
    if not changes:
        return Load(None, mark)

    before = known.where(F.col("file").isin([r.file for r in changes]))
    lost = {(r.year, r.month) for r in before.where("rows > 0").select("year", "month").distinct().collect()}
    parts = [_arrived(spark, schema, fresh, ts_col, mark, batch, listing)] if fresh else []
    if gone:
        parts.append(before.where(F.col("file").isin(gone)).select("file").distinct().select(
            F.lit(batch).cast("bigint").alias("batch"), "file", *[F.lit(0).cast("bigint").alias(c) if c != "modified" else F.lit(None).cast("timestamp").alias(c)
                                                                   for c in ("length", "modified")],
            *[F.lit(None).cast("int").alias(c) for c in ("year", "month")], *[F.lit(0).cast("bigint").alias(c) for c in ("rows", "late", "tied")],
            F.lit(None).cast("timestamp_ntz").alias("latest"), F.lit(False).alias("present")))
    entry = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    staged = f"{log.rstrip('/')}.staged/batch-{batch:09d}"
    entry.coalesce(1).write.mode("overwrite").parquet(staged)  # one row per new file and month: kept as it is, published at the end
    entry = spark.read.schema(LOG_SCHEMA).parquet(staged)
    touched = {(r.year, r.month) for r in entry.where("rows > 0").select("year", "month").distinct().collect()} | lost
    months = sorted(touched, key=lambda m: (m[0] is not None, m))

    if months:
        raw = _read(spark, schema, source)
        # the source's rows go to their months, not the model's wider ones
        ts = F.col(ts_col)
        rows = raw.where(in_months(ts, months)).withColumns({"__year": F.year(ts), "__month": F.month(ts)})
        out = build(rows.hint("rebalance", "__year", "__month").drop("__year", "__month"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by).parquet(target))
        if lost:  # a month that changed or vanished files held may have no rows left
            _drop_empty(spark, out, target, lost, partition_by)
    n = entry.agg(F.sum("rows"), F.sum("late"), F.sum("tied"), F.sum(F.when(F.col("year").isNull(), F.col("rows")).otherwise(0))).first()
    publish(entry, f"{log.rstrip('/')}/batch-{batch:09d}")
    return Load(batch, mark, len(fresh), months, n[0] or 0, n[1] or 0, n[2] or 0, n[3] or 0)


def _drop_empty(spark: SparkSession, out: DataFrame, target: str, months: set[Month], partition_by: tuple[str, str]) -> None:
    year, month = partition_by
    mine = F.lit(False)
    for y, m in months:
        mine = mine | (F.col(year).eqNullSafe(F.lit(y)) & F.col(month).eqNullSafe(F.lit(m)))
    left = {(r[0], r[1]) for r in out.where(mine).select(year, month).distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for y, m in months - left:
        name = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in ((year, y), (month, m)))
        fs.delete(path(f"{target.rstrip('/')}/{name}"), True)
