"""Raw layer: land a source projection once as Parquet, reuse it afterwards.

The reference ingests raw files into a raw database once and builds every
model from there. ``landed`` does the same for any DataFrame: it writes it
under the shared checkpoint folder, keyed by a fingerprint of the input
files (path, size, modification time), and returns a scan of the written
table. Changed inputs give a new fingerprint and a new landing; a
half-written landing (no ``_SUCCESS``) is rewritten. The written table also
cuts the lineage of whatever built it.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import checkpoint_dir

_LOCK = threading.Lock()


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) in Hadoop's API: a path without a scheme is one of
    the cluster's default file system, not of this machine."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _stats(spark: SparkSession, path: str) -> list[str]:
    """path, length and modification time of every file under ``path``
    (metadata only; nothing for a path that does not exist)."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    out, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return sorted(out)


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Hash of (path, length, modification time) of every input file and of
    the ``version:`` tags among ``paths``; missing paths count by name."""
    h = hashlib.sha256()
    for p in paths:
        for line in [p] if p.startswith("version:") else [p, *_stats(spark, p)]:
            h.update(f"{line}\n".encode())
    return h.hexdigest()[:24]


_DONE: set[str] = set()


def tables_fingerprint(spark: SparkSession, base: str, tables: list[str]) -> str:
    """Fingerprint of the ``<base>/<table>.parquet`` files or folders."""
    return fingerprint(spark, [f"{base.rstrip('/')}/{t}.parquet" for t in tables])


def tables_bytes(spark: SparkSession, base: str, tables: list[str]) -> int:
    """Length of all ``<base>/<table>.parquet`` files (metadata only)."""
    return sum(int(line.rsplit("|", 2)[1]) for t in tables for line in _stats(spark, f"{base.rstrip('/')}/{t}.parquet"))


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a landing finished (its ``_SUCCESS`` marker exists)."""
    if path in _DONE:
        return True
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").select("path").limit(1).count()
    except AnalysisException:
        return False
    _DONE.add(path)
    return True


def landed(spark: SparkSession, name: str, df: DataFrame, version: str = "",
           base: str | None = None, cluster_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as ``<base>/<name>-<fingerprint>`` and read back.
    ``version`` names the code deriving ``df`` (a change re-lands)."""
    files = df.inputFiles()
    if not files:
        return df
    # inputs + the version of the code that derives the landing
    key = fingerprint(spark, sorted(files) + [f"version:{version}|cluster:{cluster_by}"])
    root = base or f"{checkpoint_dir(spark)}/meterline/raw_layer"
    path = f"{root}/{name}-{key}"
    with _LOCK:
        if not _complete(spark, path):
            out = df
            if cluster_by:
                # time-clustered files, like monthly source files: row-group
                # min/max make time filters selective, and month-partitioned
                # writes downstream need no shuffle. Range bounds come from a
                # sample, so a hot month is split over several tasks.
                out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
            publish(out, path)
            _DONE.add(path)
    return spark.read.parquet(path)


def publish(df: DataFrame, path: str) -> None:
    """Write ``df`` to a private folder and rename it into place, so readers
    never see a half-written landing; if another process published first, its
    identical copy is used."""
    spark = df.sparkSession
    fresh = f"{path}.tmp-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    fs, at = _hadoop(spark, path)
    if fs.exists(_hadoop(spark, f"{path}/_SUCCESS")[1]):
        fs.delete(_hadoop(spark, fresh)[1], True)
        return
    fs.delete(at, True)  # what an interrupted landing may have left
    if not fs.rename(_hadoop(spark, fresh)[1], at) and not fs.exists(_hadoop(spark, f"{path}/_SUCCESS")[1]):
        raise OSError(f"cannot publish {path}")
