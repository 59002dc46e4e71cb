"""Top-k and distinct-sorted reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import exact_avg, round_to


def top_boroughs(fct: DataFrame, k: int = 5, borough_col: str = "pickup_borough") -> DataFrame:
    """Top-k pickup boroughs by trips: count, average distance, average total
    and trips with a known rate code. Ties break on the borough name.

    groupBy with partial aggregation, then orderBy+limit, which Spark plans
    as a single TakeOrderedAndProject (no global sort)."""
    return (fct.groupBy(borough_col)
               .agg(F.count(F.lit(1)).alias("trip_count"),
                    round_to(exact_avg("trip_distance"), 4).alias("avg_distance"),
                    round_to(exact_avg("total_amount"), 4).alias("avg_fare"),
                    F.count("rate_code_name").alias("rated_trips"))
               .orderBy(F.desc("trip_count"), F.asc_nulls_last(borough_col))
               .limit(k))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column, sorted (NULLs last)."""
    return df.select(col).distinct().orderBy(F.asc_nulls_last(col))
