"""Profiles, counts, reconciliation and freshness (single-pass aggregates)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import exact_avg, round_to, unit_boundaries


def _profile_cols(ts_col: str) -> list:
    ts = F.col(ts_col)
    return [F.count(F.lit(1)).alias("total_trips"), F.min(ts).alias("earliest_trip"),
            F.max(ts).alias("latest_trip"),
            F.count_distinct(F.date_trunc("month", ts)).alias("months_covered")]


def _null_cols(cols: list[str]) -> list:
    return [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"null_{c}") for c in cols]


def load_profile(trips: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Row count, first/last pickup and number of distinct months (exact)."""
    return trips.agg(*_profile_cols(ts_col))


def raw_validation(trips: DataFrame, null_cols: list[str], ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Load profile and NULL counts in one aggregate (one scan)."""
    return trips.agg(*_profile_cols(ts_col), *_null_cols(null_cols))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL count per column, all in one aggregate (one scan)."""
    return df.agg(*_null_cols(cols))


def range_stats(trips: DataFrame, ts_col: str = "tpep_pickup_datetime",
                avg_cols: tuple[str, ...] = ("trip_distance", "fare_amount"), digits: int = 4) -> DataFrame:
    """Range of the timestamp and averages over rows where it is not NULL."""
    ts = F.col(ts_col)
    return trips.where(ts.isNotNull()).agg(
        F.min(ts).alias("earliest_trip"), F.max(ts).alias("latest_trip"),
        *[round_to(exact_avg(c), digits).alias(f"avg_{c}") for c in avg_cols])


def model_counts(models: dict[str, DataFrame]) -> DataFrame:
    """Row count per model, one row each (aggregates unioned, no join)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
             for name, df in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fact_quality_cols(with_count: bool = False) -> list:
    extra = [F.count(F.lit(1)).alias("row_count")] if with_count else []
    return extra + [
        F.sum("total_amount_mismatch_flag").cast("bigint").alias("total_mismatches"),
        F.sum("negative_duration_flag").cast("bigint").alias("negative_durations"),
        F.count_distinct("pickup_borough").alias("pickup_boroughs"),
        F.count_distinct("dropoff_borough").alias("dropoff_boroughs")]


def fact_quality(fct: DataFrame, with_count: bool = False) -> DataFrame:
    """Flag totals and distinct borough counts of the fact (and its row count)."""
    return fct.agg(*fact_quality_cols(with_count))


def raw_validation_cols(null_cols: list[str], ts_col: str = "tpep_pickup_datetime") -> list:
    return _profile_cols(ts_col) + _null_cols(null_cols)


def table_profile(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """Generic ingestion profile: rows, distinct keys, date range."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_distinct(key).alias("unique_keys"),
                  F.min(date_col).alias("min_date"),
                  F.max(date_col).alias("max_date"))


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]], key_field: str,
              key_type: str = "decimal(38,2)") -> DataFrame:
    """Dev-vs-prod reconciliation per table: row counts, key-field sums and
    their variances (dev - prod). Both layers are tagged and aggregated in a
    single conditional aggregate per table; no join."""
    parts = []
    for name, (dev, prod) in pairs.items():
        both = (dev.select(F.lit("dev").alias("layer"), F.col(key_field).cast(key_type).alias("k"))
                   .unionByName(prod.select(F.lit("prod").alias("layer"), F.col(key_field).cast(key_type).alias("k"))))
        is_dev, is_prod = F.col("layer") == "dev", F.col("layer") == "prod"
        agg = both.agg(
            F.count(F.when(is_dev, 1)).alias("dev_rows"),
            F.count(F.when(is_prod, 1)).alias("prod_rows"),
            F.sum(F.when(is_dev, F.col("k"))).cast(key_type).alias("dev_key_sum"),
            F.sum(F.when(is_prod, F.col("k"))).cast(key_type).alias("prod_key_sum"))
        parts.append(agg.select(
            F.lit(name).alias("table_name"), "dev_rows", "prod_rows",
            (F.col("dev_rows") - F.col("prod_rows")).alias("row_variance"),
            "dev_key_sum", "prod_key_sum",
            (F.coalesce("dev_key_sum", F.lit(0)) - F.coalesce("prod_key_sum", F.lit(0))).cast(key_type).alias("key_sum_variance")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def partition_freshness(df: DataFrame, by: list[str], ts_col: str, now: dt.datetime, max_lag_hours: int, max_arrival_hours: int,
                        arrival_now: dt.datetime | None = None) -> DataFrame:
    """Freshness of every partition of a file table: rows, files, the latest event
    and when the newest file arrived, both with their lag in hour boundaries crossed
    and pass/fail. Only the partition columns and ``ts_col`` are read; arrival comes
    from the files' times of change. Arrivals are held against ``arrival_now``, the
    query's start by default. A partition without any event time is not fresh."""
    latest, now_c = F.max(F.col(ts_col).cast("timestamp_ntz")), F.lit(now).cast("timestamp_ntz")
    arrival_c = (F.current_timestamp() if arrival_now is None else F.lit(arrival_now)).cast("timestamp_ntz")
    per_file = df.groupBy(*by, F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("n"), latest.alias("latest_at"), F.max("_metadata.file_modification_time").cast("timestamp_ntz").alias("arrived_at"))
    per = per_file.groupBy(*by).agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("file_count"), F.max("latest_at").alias("latest_at"),
                                    F.max("arrived_at").alias("arrived_at"))
    lag, since = unit_boundaries(F.col("latest_at"), now_c, "hour"), unit_boundaries(F.col("arrived_at"), arrival_c, "hour")
    return per.select(*by, "row_count", "file_count", "latest_at", lag.alias("lag_hours"), "arrived_at", since.alias("arrival_lag_hours"),
                      F.coalesce(lag <= max_lag_hours, F.lit(False)).alias("is_fresh"), (since <= max_arrival_hours).alias("has_arrived"))


def freshness(df: DataFrame, ts_col: str, now: dt.datetime, max_lag_hours: int) -> DataFrame:
    """Latest timestamp, lag to ``now`` in hour boundaries crossed, pass/fail."""
    latest = F.max(F.col(ts_col).cast("timestamp_ntz"))
    now_c = F.lit(now).cast("timestamp_ntz")
    lag = unit_boundaries(F.col("latest_at"), now_c, "hour")
    return df.agg(latest.alias("latest_at")).select(
        "latest_at", lag.alias("lag_hours"), (lag <= max_lag_hours).alias("is_fresh"))
