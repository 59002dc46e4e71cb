"""Registered data-quality queries (Q1-Q9) and orphan-key anti-joins.
Oracles are generated from the same check lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from meterline import bindings
from meterline.operators import quality as Q
from meterline.operators.quality_store import SuiteStore
from meterline.oracle_sql import suite_sql, with_base
from meterline.plans.registry import ORACLES, register
from meterline.plans.trip_queries import wh
from meterline.session import apply_defaults, scratch_path

# Fixed "today" of registered runs, so reports are reproducible.
TODAY = dt.date(2025, 6, 1)
SUITE_KINDS = {
    "dq_not_null": "not_null", "dq_unique": "unique", "dq_relationships": "relationships",
    "dq_accepted_values": "accepted_values", "dq_accepted_range": "accepted_range",
    "dq_row_count": "row_count", "dq_expression": "expression",
}


def suite(kind: str | None = None) -> list[Q.Check]:
    checks = Q.reference_suite(pickup_date_floor=bindings.TEST_DATE_MIN, today=TODAY)
    return [c for c in checks if kind is None or c.kind == kind]


def date_past_checks() -> list[Q.Check]:
    return [Q.date_in_past("fct_taxi_trips", "pickup_date", TODAY),
            Q.date_in_past("fct_taxi_trips", "pickup_date", dt.date(1998, 1, 1))]


def orders_checks() -> list[Q.Check]:
    """The documented checks of an orders table."""
    return [Q.unique("orders", "o_orderkey"), Q.not_null("orders", "o_orderkey"),
            Q.accepted_range("orders", "o_totalprice", 0, 1_000_000), Q.date_in_past("orders", "o_orderdate", TODAY)]


@register("dq_orders")
def q_dq_orders(spark: SparkSession, sf_dir: str):
    return Q.run_suite({"orders": apply_defaults(spark).read.parquet(f"{sf_dir}/orders.parquet")}, orders_checks())


@register("dq_incremental")
def q_dq_incremental(spark: SparkSession, sf_dir: str):
    """Q9 by partition: the fact and the staged trips arrive in two loads, the
    second one reported twice; each load checks only the months it touches, and the
    merged report equals that of the whole models."""
    w, by = wh(spark, sf_dir), ("pickup_year", "pickup_month")
    models = Q.warehouse_models(w)
    stored = {name: [c for c in suite() if c.model == name] for name in ("stg_taxi_trips", "fct_taxi_trips")}
    out = Q.run_suite(models, [c for c in suite() if c.model not in stored])
    for name, checks in stored.items():
        store = SuiteStore(spark, checks, f"{scratch_path(spark, 'dq_store')}/{name}", by)
        whole = models[name]
        first = whole.where((F.col("pickup_year") < 1998) | (F.dayofmonth("pickup_date") % 2 == 0) & (F.col("pickup_year") == 1998))
        for batch, rows, months, times in ((1, first, "pickup_year <= 1998", 1), (2, whole, "pickup_year >= 1998 or pickup_year is null", 2)):
            touched = [tuple(r) for r in rows.where(months).select(*by).distinct().collect()]  # a calendar of months
            for _ in range(times):
                store.refresh(batch, rows, models, touched)
        out = out.unionByName(store.report(whole, models))
    return out


def _suite_query(checks_fn):
    def run(spark: SparkSession, sf_dir: str):
        return Q.run_suite(Q.warehouse_models(wh(spark, sf_dir)), checks_fn())
    return run


for _key, _kind in SUITE_KINDS.items():
    register(_key)(_suite_query(lambda k=_kind: suite(k)))
register("dq_date_past")(_suite_query(date_past_checks))
register("dq_report")(_suite_query(lambda: suite()))


@register("orphan_vendor", oracle="""
SELECT t.VendorID, CAST(COUNT(*) AS BIGINT) AS orphan_rows
FROM stg_trips t LEFT JOIN dim_vendor v ON t.VendorID = v.vendor_id
WHERE t.VendorID IS NOT NULL AND v.vendor_id IS NULL GROUP BY t.VendorID""")
def q_orphan_vendor(spark, sf_dir):
    w = wh(spark, sf_dir)
    return Q.orphans(w.stg_trips(), "VendorID", w.dim_vendor(), "vendor_id")


@register("orphan_zone", oracle="""
SELECT t.PULocationID, CAST(COUNT(*) AS BIGINT) AS orphan_rows
FROM stg_trips t LEFT JOIN stg_zones z ON t.PULocationID = z.LocationID
WHERE t.PULocationID IS NOT NULL AND z.LocationID IS NULL GROUP BY t.PULocationID""")
def q_orphan_zone(spark, sf_dir):
    w = wh(spark, sf_dir)
    return Q.orphans(w.stg_trips(), "PULocationID", w.stg_zones(), "LocationID")


def register_oracles() -> None:
    """Fill the suite oracles from the check lists."""
    for key, kind in SUITE_KINDS.items():
        ORACLES[key] = with_base(suite_sql(suite(kind)))
    ORACLES["dq_date_past"] = with_base(suite_sql(date_past_checks()))
    ORACLES["dq_orders"] = with_base(suite_sql(orders_checks()))
    ORACLES["dq_report"] = ORACLES["dq_incremental"] = with_base(suite_sql(suite()))
