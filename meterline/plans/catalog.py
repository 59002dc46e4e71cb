"""Import every module that registers queries."""

from meterline.plans import cube_queries, load_queries, quality_queries, sql_queries, trip_queries  # noqa: F401

# Oracles derived from check lists (no Spark session needed).
quality_queries.register_oracles()
load_queries.register_oracles()
