"""File sources: multi-file Parquet, CSV and JSON scans with an ingest stamp.

Missing inputs raise ``FileNotFoundError`` before any job runs: Spark lists
the files of a read when the DataFrame is created, so an empty glob or a
missing path fails right there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _stamp(df: DataFrame, ingested_at: dt.datetime | None) -> DataFrame:
    """Add ``_ingested_at``: the given time, or the query's start time."""
    ts = F.lit(ingested_at) if ingested_at is not None else F.current_timestamp()
    return df.withColumn("_ingested_at", ts.cast("timestamp_ntz"))


def _guarded(read, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise FileNotFoundError(f"no input files at {path}") from e
        raise


def require_files(spark: SparkSession, path: str) -> None:
    """Raise FileNotFoundError when ``path`` (a file, folder or glob) has no files."""
    _guarded(lambda: spark.read.format("binaryFile").load(path).select("path").limit(0), path)


def ingest_parquet(spark: SparkSession, path: str, ingested_at: dt.datetime | None = None,
                   merge_schema: bool = False, schema: StructType | str | None = None) -> DataFrame:
    """All columns of every Parquet file matching ``path`` plus ``_ingested_at``.

    ``merge_schema`` unions differing monthly schemas by column name.
    ``schema`` declares the wanted types when files disagree on a column's
    physical type (e.g. ``passenger_count`` as BIGINT in some months and
    DOUBLE in others, which Spark's reader cannot widen): see ``unified_parquet``."""
    if schema is not None:
        return _stamp(unified_parquet(spark, path, schema), ingested_at)
    return _stamp(_guarded(lambda: spark.read.option("mergeSchema", merge_schema).parquet(path), path), ingested_at)


def unified_parquet(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files matching ``path`` read as ``schema`` whatever their physical types.

    Files are grouped by their footer schema (a metadata listing, then one
    footer read per file on the driver: fine for monthly files, slow for
    many thousands); each group is one scan whose columns are cast to the
    declared types, matched by case-insensitive name (missing ones are
    NULL); the groups are unioned. Only file paths reach the driver."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    listing = _guarded(lambda: spark.read.format("binaryFile").load(path).select("path"), path)
    files = sorted(r.path for r in listing.collect())
    if not files:
        raise FileNotFoundError(f"no input files at {path}")
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(spark.read.parquet(f).schema.simpleString().lower(), []).append(f)
    parts = []
    for group in groups.values():
        df = spark.read.parquet(*group)
        names = {c.lower(): c for c in df.columns}
        parts.append(df.select(*[
            (F.col(f"`{names[fl.name.lower()]}`") if fl.name.lower() in names else F.lit(None))
            .cast(fl.dataType).alias(fl.name) for fl in schema.fields]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingest_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
               ingested_at: dt.datetime | None = None, header: bool = True) -> DataFrame:
    """CSV with a header; the declared schema when given, else type detection
    (an extra pass over the data: declare schemas in production)."""
    def read():
        r = spark.read.option("header", header)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    return _stamp(_guarded(read, path), ingested_at)


def ingest_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
                ingested_at: dt.datetime | None = None, multi_line: bool = False,
                timestamp_ntz_format: str | None = None) -> DataFrame:
    """JSON lines (or multi-line documents) with a declared schema when given."""
    def read():
        r = spark.read.option("multiLine", multi_line)
        if timestamp_ntz_format:
            r = r.option("timestampNTZFormat", timestamp_ntz_format)
        if schema is not None:
            r = r.schema(schema)
        return r.json(path)
    return _stamp(_guarded(read, path), ingested_at)
