"""Quickstart: the trip warehouse, its quality suite and a cube query.

python examples/quickstart.py [sf_dir]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import meterline as ml  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.001") -> dict:
    spark = ml.get_session("local[4]", shuffle_partitions=4)
    wh = ml.TripWarehouse.from_testdata(spark, sf_dir)

    # models are lazy DataFrames
    fct = wh.fct_trips()

    # the declared checks, one row each
    report = ml.run_suite(ml.warehouse_models(wh), ml.reference_suite()).collect()

    # a semantic-layer query, answered from a rollup when one can serve it
    tables = ml.warehouse_tables(wh)
    store = ml.RollupStore(ml.ALL_CUBES)
    store.build(spark, "TaxiTrips", "dailyOperations", tables)
    q = ml.CubeQuery.from_dict({
        "measures": ["TaxiTrips.tripCount", "TaxiTrips.avgFareAmount"],
        "dimensions": ["TaxiTrips.pickupBorough"],
        "timeDimensions": [{"dimension": "TaxiTrips.pickupDatetime", "granularity": "year"}],
        "order": {"TaxiTrips.tripCount": "desc"}})
    rows = store.query(q, tables).collect()
    return {"fct_rows": fct.count(), "checks": len(report), "cube_rows": len(rows),
            "routed": store.route(q) is not None}


if __name__ == "__main__":
    print(main(*sys.argv[1:]))
