"""Registered SQL over the named models, the way dashboards query them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.functions.columns import round_to
from meterline.oracle_sql import r, xavg
from meterline.plans.registry import register
from meterline.plans.trip_queries import wh


def over_models(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    wh(spark, sf_dir).register_views()
    return spark.sql(sql)


@register("sql_trip_count", oracle="SELECT CAST(COUNT(*) AS BIGINT) AS trips FROM mart_trips")
def q_sql_trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_models(spark, sf_dir, "SELECT count(*) AS trips FROM mart_taxi_trips")


@register("sql_top_boroughs", oracle=f"""
SELECT pickup_borough, CAST(COUNT(*) AS BIGINT) AS trips, {r(xavg('fare_amount'))} AS mean_fare
FROM fct_trips GROUP BY pickup_borough ORDER BY trips DESC, pickup_borough LIMIT 5""")
def q_sql_top_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = over_models(spark, sf_dir, """
        SELECT pickup_borough, count(*) AS trips, avg(fare_amount) AS mean_fare
        FROM fct_taxi_trips GROUP BY pickup_borough ORDER BY trips DESC, pickup_borough LIMIT 5""")
    return top.withColumn("mean_fare", round_to("mean_fare", 4))
