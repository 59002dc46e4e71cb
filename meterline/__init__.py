"""meterline: layered trip analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    file sources, seeds, zone geometry, incremental loads, sinks and layers
functions  column builders (typed casts, duration, ratios, geometry) and join helpers
operators  staging / fact / mart models, profiles, time series, quality checks, top-k
plans      semantic cubes, rollups and the end-to-end job
streaming  incremental file ingest with Structured Streaming
"""

__version__ = "0.1.0"

# Public API (imported lazily so `import meterline` needs no Spark session).
_EXPORTS = {
    "get_session": "meterline.session", "checkpoint_dir": "meterline.session", "sizing": "meterline.session",
    "TripWarehouse": "meterline.plans.warehouse",
    "run_job": "meterline.plans.job",
    "run_suite": "meterline.operators.quality", "reference_suite": "meterline.operators.quality",
    "warehouse_models": "meterline.operators.quality",
    "CubeQuery": "meterline.plans.cubes", "CubeSet": "meterline.plans.cubes", "infer_cube": "meterline.plans.cubes",
    "ALL_CUBES": "meterline.plans.cube_defs", "warehouse_tables": "meterline.plans.cube_defs",
    "RollupStore": "meterline.plans.rollups",
    "ingest_parquet": "meterline.sources.files", "ingest_csv": "meterline.sources.files",
    "ingest_json": "meterline.sources.files",
    "incremental_append": "meterline.sources.incremental", "incremental_model": "meterline.sources.incremental",
    "ingest_new_files": "meterline.streaming.ingest", "stream_model": "meterline.streaming.ingest",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
