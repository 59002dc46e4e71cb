"""Declarative data-quality checks and the suite runner.

A check is data (kind, model, column, arguments, severity). The runner
turns a model's row-level checks (not_null, accepted_range, expression,
date_past, row_count, accepted_values) into ONE aggregate over that model,
so N checks cost one scan; a model's relationship checks join that same
scan (one group-by, one anti-join). ``unique`` is one group-by per check. Keys are
pre-aggregated map-side before any shuffle, so a hot key (even a third of
all rows) is a single row per partition. Results: one row per check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StringType, StructField, StructType

from meterline import defaults as D
from meterline.functions.columns import NUMERIC_KEY
from meterline.functions.joins import dimension, is_literal

ROW_KINDS = ("not_null", "accepted_range", "expression", "date_past", "row_count", "accepted_values")

REPORT_SCHEMA = StructType([
    StructField("test_name", StringType(), False),
    StructField("model", StringType(), False),
    StructField("column_name", StringType(), True),
    StructField("test_type", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("failures", LongType(), True),
    StructField("status", StringType(), False),
])


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | None = None
    severity: str = "error"
    args: dict[str, Any] = field(default_factory=dict, hash=False, compare=False)

    @property
    def name(self) -> str:
        parts = [self.kind, self.model] + ([self.column] if self.column else [])
        if self.kind == "relationships":
            parts.append(self.args["to"])
        if self.kind == "expression" and not self.column:
            parts.append(self.args.get("label", "expr"))
        return "__".join(parts)


# ---------------------------------------------------------------- check constructors
def not_null(model, column, severity="error"):
    return Check("not_null", model, column, severity)


def unique(model, column, severity="error"):
    return Check("unique", model, column, severity)


def relationships(model, column, to, field_, severity="error"):
    return Check("relationships", model, column, severity, {"to": to, "field": field_})


def accepted_values(model, column, values, severity="error"):
    return Check("accepted_values", model, column, severity, {"values": list(values)})


def accepted_range(model, column, min_value=None, max_value=None, severity="error"):
    return Check("accepted_range", model, column, severity, {"min": min_value, "max": max_value})


def row_count_positive(model, severity="error"):
    return Check("row_count", model, None, severity)


def expression_is_true(model, column, sql: str, severity="error", label="expr"):
    """``sql``: a boolean SQL expression over the model's columns; rows where
    it is false fail (NULL does not fail)."""
    return Check("expression", model, column, severity, {"sql": sql, "label": label})


def date_in_past(model, column, today: dt.date, severity="error"):
    return Check("date_past", model, column, severity, {"today": today})


# ---------------------------------------------------------------- row-level failure counts
def _row_indicator(check: Check) -> Column | None:
    """1 when the row fails ``check``, else 0; None for checks that are not a
    per-row sum (row_count, accepted_values)."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        bad = c.isNull()
    elif check.kind == "accepted_range":
        lo, hi = check.args["min"], check.args["max"]
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < F.lit(lo))
        if hi is not None:
            bad = bad | (c > F.lit(hi))
    elif check.kind == "expression":
        bad = ~F.expr(check.args["sql"])
    elif check.kind == "date_past":
        bad = c >= F.lit(check.args["today"])
    else:
        return None
    return F.when(bad, F.lit(1)).otherwise(F.lit(0))   # NULL predicate: not a failure


def _row_failures(check: Check) -> Column:
    if check.kind == "row_count":
        return F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    if check.kind == "accepted_values":
        # failures = distinct values outside the list (NULL is not a failure)
        c = F.col(check.column)
        return F.count_distinct(F.when(~c.isin(check.args["values"]), c)).cast("bigint")
    failing = _row_indicator(check)
    if failing is None:
        raise ValueError(check.kind)
    return F.coalesce(F.sum(failing), F.lit(0)).cast("bigint")


def _status(failures: Column, severity: Column) -> Column:
    return (F.when(failures == 0, F.lit("pass"))
             .when(severity == "warn", F.lit("warn"))
             .otherwise(F.lit("fail")))


def _sql_text(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rows_from_counts(agg: DataFrame, checks: list[Check]) -> DataFrame:
    """One aggregate row with a count per check -> one report row per check
    (a single generator expression over the one-row aggregate)."""
    structs = ", ".join(
        f"named_struct('test_name', {_sql_text(ch.name)}, 'model', {_sql_text(ch.model)}, "
        f"'column_name', {_sql_text(ch.column)}, 'test_type', {_sql_text(ch.kind)}, "
        f"'severity', {_sql_text(ch.severity)}, 'failures', CAST(f{i} AS BIGINT))"
        for i, ch in enumerate(checks))
    return agg.selectExpr(f"inline(array({structs}))")


def run_row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of one model in a single aggregate."""
    agg = df.agg(*[_row_failures(ch).alias(f"f{i}") for i, ch in enumerate(checks)])
    return _rows_from_counts(agg, checks)


def row_check_values(df: DataFrame, checks: list[Check], extra: list[Column] = ()):
    """Row-level checks of one model plus ``extra`` aggregate columns in ONE
    aggregate; the single result row comes back to the driver. Returns
    (report rows as dicts, the aggregate row with the extra values)."""
    agg = df.agg(*[_row_failures(ch).alias(f"f{i}") for i, ch in enumerate(checks)], *extra).first()
    rows = []
    for i, ch in enumerate(checks):
        n = agg[f"f{i}"]
        status = "pass" if n == 0 else ("warn" if ch.severity == "warn" else "fail")
        rows.append({"test_name": ch.name, "model": ch.model, "column_name": ch.column, "test_type": ch.kind,
                     "severity": ch.severity, "failures": n, "status": status})
    return rows, agg


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("f0"))


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null keys with their row counts (partial aggregation before the shuffle)."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field_: str,
            broadcast_rows: int = D.BROADCAST_MAX_ROWS) -> DataFrame:
    """Child keys with no parent row, and how many child rows carry each."""
    keys = key_counts(child, column)
    cf, pf = _norm_keys(child.schema[column].dataType, parent.schema[field_].dataType)
    p = parent.select(pf(F.col(field_)).alias("_parent_key")).distinct()
    p = F.broadcast(p) if is_literal(parent) else dimension(p, broadcast_rows)
    return keys.join(p, cf(keys[column]) == p["_parent_key"], "left_anti").withColumnRenamed("rows", "orphan_rows")


def _norm_keys(child_type, parent_type) -> tuple:
    """Join-key normal forms (child, parent) so one equi-join serves checks of
    any key types, and relationship checks and orphan lists agree: if either
    side is numeric both compare as exact decimals (text ids such as '1.0'
    match 1; ids beyond 2^53 stay distinct), otherwise as text."""
    if isinstance(parent_type, NumericType) or isinstance(child_type, NumericType):
        return (lambda c: c.try_cast(NUMERIC_KEY).cast("string")), (lambda p: p.try_cast(NUMERIC_KEY).cast("string"))
    return (lambda c: c.cast("string")), (lambda p: p.cast("string"))


def relationship_failures_fused(child: DataFrame, checks: list[Check],
                                models: Mapping[str, DataFrame],
                                broadcast_rows: int = D.BROADCAST_MAX_ROWS) -> DataFrame:
    """All relationship checks of one child model in ONE scan of the child:
    (check id, normalized key) pairs are stacked, counted with map-side
    partial aggregation (a hot key is one row per partition), anti-joined
    once against the union of the parents' keys, and summed per check."""
    pairs, parents = [], None
    for i, ch in enumerate(checks):
        parent = models[ch.args["to"]]
        cf, pf = _norm_keys(child.schema[ch.column].dataType, parent.schema[ch.args["field"]].dataType)
        c = F.col(ch.column)
        pairs.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("cid"), cf(c).alias("k"))))
        p = parent.select(F.lit(i).alias("cid"), pf(F.col(ch.args["field"])).alias("k"))
        parents = p if parents is None else parents.unionByName(p)
    keys = (child.select(F.explode(F.array(*pairs)).alias("p")).where(F.col("p").isNotNull())
                 .select("p.cid", "p.k").groupBy("cid", "k").agg(F.count(F.lit(1)).alias("n")))
    parents = parents.distinct()
    literal = all(is_literal(models[ch.args["to"]]) for ch in checks)
    parents = F.broadcast(parents) if literal else dimension(parents, broadcast_rows)
    orphan = keys.join(parents, ["cid", "k"], "left_anti")
    agg = orphan.agg(*[F.coalesce(F.sum(F.when(F.col("cid") == i, F.col("n"))), F.lit(0)).alias(f"f{i}")
                       for i in range(len(checks))])
    return _rows_from_counts(agg, checks)


def _fused_aggregate(child: DataFrame, row_checks: list[Check], rel_checks: list[Check],
                     models: Mapping[str, DataFrame], broadcast_rows: int, profile_ts: str | None):
    inds = [_row_indicator(ch) for ch in row_checks if ch.kind != "row_count"]
    sum_checks = [ch for ch in row_checks if ch.kind != "row_count"]
    zero = [F.lit(0).alias(f"i{j}") for j in range(len(inds))]
    ts_type = child.schema[profile_ts].dataType if profile_ts else None
    no_ts = [F.lit(None).cast(ts_type).alias("ts")] if profile_ts else []
    entries = [F.struct(F.lit(-1).alias("cid"), F.lit(None).cast("string").alias("k"),
                        *[ind.alias(f"i{j}") for j, ind in enumerate(inds)],
                        *([F.col(profile_ts).alias("ts")] if profile_ts else []))]
    if profile_ts:
        # one entry per (row, month): the number of month groups is the distinct-month count
        ts = F.col(profile_ts)
        entries.append(F.when(ts.isNotNull(), F.struct(
            F.lit(-2).alias("cid"), F.date_format(F.date_trunc("month", ts), "yyyy-MM").alias("k"), *zero, *no_ts)))
    parents = None
    for i, ch in enumerate(rel_checks):
        parent = models[ch.args["to"]]
        cf, pf = _norm_keys(child.schema[ch.column].dataType, parent.schema[ch.args["field"]].dataType)
        c = F.col(ch.column)
        entries.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("cid"), cf(c).alias("k"), *zero, *no_ts)))
        p = parent.select(F.lit(i).alias("cid"), pf(F.col(ch.args["field"])).alias("k"))
        parents = p if parents is None else parents.unionByName(p)
    extra_aggs = [F.min("ts").alias("tmin"), F.max("ts").alias("tmax")] if profile_ts else []
    grouped = (child.select(F.explode(F.array(*entries)).alias("e")).where(F.col("e").isNotNull())
                    .select("e.*").groupBy("cid", "k")
                    .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"i{j}").alias(f"i{j}") for j in range(len(inds))],
                         *extra_aggs))
    # ONE branch: the marker group (NULL key) and the month groups pass the
    # anti-join untouched, key groups survive only without a parent; one
    # aggregate reads everything
    out = grouped
    if rel_checks:
        parents = parents.distinct()
        literal = all(is_literal(models[ch.args["to"]]) for ch in rel_checks)
        parents = F.broadcast(parents) if literal else dimension(parents, broadcast_rows)
        out = grouped.join(parents, ["cid", "k"], "left_anti")
    marker = F.col("cid") == -1
    aggs = [F.coalesce(F.sum(F.when(marker, F.col(f"i{j}"))), F.lit(0)).cast("bigint").alias(f"f{j}")
            for j in range(len(inds))]
    ordered = list(sum_checks)
    for ch in row_checks:
        if ch.kind == "row_count":
            aggs.append(F.when(F.coalesce(F.sum(F.when(marker, F.col("n"))), F.lit(0)) == 0, F.lit(1))
                        .otherwise(F.lit(0)).cast("bigint").alias(f"f{len(ordered)}"))
            ordered.append(ch)
    for i, ch in enumerate(rel_checks):
        aggs.append(F.coalesce(F.sum(F.when(F.col("cid") == i, F.col("n"))), F.lit(0)).cast("bigint")
                    .alias(f"f{len(ordered)}"))
        ordered.append(ch)
    if profile_ts:
        aggs += [F.coalesce(F.sum(F.when(marker, F.col("n"))), F.lit(0)).cast("bigint").alias("total_rows"),
                 F.min(F.when(marker, F.col("tmin"))).alias("earliest"),
                 F.max(F.when(marker, F.col("tmax"))).alias("latest"),
                 F.count(F.when(F.col("cid") == -2, F.lit(1))).alias("months_covered")]
    return out.agg(*aggs), ordered


def fused_model_checks(child: DataFrame, row_checks: list[Check], rel_checks: list[Check],
                       models: Mapping[str, DataFrame],
                       broadcast_rows: int = D.BROADCAST_MAX_ROWS) -> DataFrame:
    """Row checks (per-row sums and row count) AND relationship checks of one
    model from ONE scan: every row contributes a marker entry (cid -1)
    carrying its row-check indicators, plus one (cid, key) entry per
    relationship; a single partially aggregated group-by and one anti-join
    serve both."""
    agg, ordered = _fused_aggregate(child, row_checks, rel_checks, models, broadcast_rows, None)
    return _rows_from_counts(agg, ordered)


def fused_model_check_values(child: DataFrame, row_checks: list[Check], rel_checks: list[Check],
                             models: Mapping[str, DataFrame], profile_ts: str,
                             broadcast_rows: int = D.BROADCAST_MAX_ROWS):
    """``fused_model_checks`` plus a load profile of ``profile_ts`` (row count,
    first/last value, distinct months) from the same scan; the one result
    row comes back to the driver. Returns (report rows as dicts, profile dict)."""
    agg, ordered = _fused_aggregate(child, row_checks, rel_checks, models, broadcast_rows, profile_ts)
    row = agg.first()
    rows = []
    for i, ch in enumerate(ordered):
        n = row[f"f{i}"]
        status = "pass" if n == 0 else ("warn" if ch.severity == "warn" else "fail")
        rows.append({"test_name": ch.name, "model": ch.model, "column_name": ch.column, "test_type": ch.kind,
                     "severity": ch.severity, "failures": n, "status": status})
    prof = {k: row[k] for k in ("total_rows", "earliest", "latest", "months_covered")}
    return rows, prof


def run_suite(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Run checks against named models; one report row per check.

    Warn-level failures never raise; nothing raises here at all: the caller
    decides what a failed error-level check means (the reference logs and
    continues)."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    rel_by_model: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_KINDS:
            by_model.setdefault(ch.model, []).append(ch)
        elif ch.kind == "relationships":
            rel_by_model.setdefault(ch.model, []).append(ch)
        elif ch.kind == "unique":
            parts.append(_rows_from_counts(unique_failures(models[ch.model], ch.column), [ch]))
        else:
            raise ValueError(f"unknown check kind {ch.kind}")
    for model in list(by_model):
        chs = by_model[model]
        if model in rel_by_model and all(ch.kind != "accepted_values" for ch in chs):
            # one scan for the model's row checks and relationship checks
            parts.append(fused_model_checks(models[model], chs, rel_by_model.pop(model), models))
        else:
            parts.append(run_row_checks(models[model], chs))
    for model, chs in rel_by_model.items():
        parts.append(relationship_failures_fused(models[model], chs, models))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures"), F.col("severity")))


def failed(report_rows, severity: str = "error") -> list:
    """Collected report rows that failed at the given severity."""
    return [r for r in report_rows if r["status"] == ("fail" if severity == "error" else "warn")]


# ---------------------------------------------------------------- the reference's suite
def reference_suite(pickup_date_floor: dt.date = D.PICKUP_DATE_FLOOR,
                    today: dt.date | None = None) -> list[Check]:
    """The 36 declared checks on staged trips, the fact, the zone dimension and the seeds.
    ``today`` stands in for the current date (fixed, for reproducible runs)."""
    today = today or dt.date.today()
    stg, fct, geo = "stg_taxi_trips", "fct_taxi_trips", "dim_taxi_zones_geospatial"
    return [
        row_count_positive(stg),
        not_null(stg, "VendorID"),
        relationships(stg, "VendorID", "dim_vendor", "vendor_id", "warn"),
        not_null(stg, "RatecodeID"),
        relationships(stg, "RatecodeID", "dim_rate_code", "rate_code_id", "warn"),
        relationships(stg, "payment_type", "dim_payment_type", "payment_type", "warn"),
        not_null(stg, "PULocationID"),
        relationships(stg, "PULocationID", "stg_taxi_zones", "LocationID"),
        not_null(stg, "DOLocationID"),
        relationships(stg, "DOLocationID", "stg_taxi_zones", "LocationID"),
        not_null(stg, "tpep_pickup_datetime"),
        not_null(stg, "tpep_dropoff_datetime"),
        not_null(stg, "trip_distance"),
        accepted_range(stg, "trip_distance", *D.TRIP_DISTANCE_RANGE),
        not_null(stg, "fare_amount"),
        accepted_range(stg, "fare_amount", *D.FARE_AMOUNT_RANGE),
        row_count_positive(fct),
        not_null(fct, "pickup_date"),
        expression_is_true(fct, "pickup_date",
                           f"pickup_date BETWEEN DATE '{pickup_date_floor}' AND DATE '{today}'",
                           label="between"),
        accepted_values(fct, "total_amount_mismatch_flag", [0, 1]),
        accepted_values(fct, "negative_duration_flag", [0, 1]),
        row_count_positive(geo),
        unique(geo, "LocationID"),
        not_null(geo, "LocationID"),
        not_null(geo, "Zone"),
        not_null(geo, "Borough"),
        accepted_values(geo, "Borough", D.ACCEPTED_BOROUGHS),
        unique("dim_vendor", "vendor_id"),
        not_null("dim_vendor", "vendor_id"),
        not_null("dim_vendor", "vendor_name"),
        unique("dim_rate_code", "rate_code_id"),
        not_null("dim_rate_code", "rate_code_id"),
        not_null("dim_rate_code", "rate_code_name"),
        unique("dim_payment_type", "payment_type"),
        not_null("dim_payment_type", "payment_type"),
        not_null("dim_payment_type", "payment_name"),
    ]


def warehouse_models(wh):
    """Model names of the suite bound to a ``TripWarehouse`` (built on first use)."""
    from meterline.plans.cubes import LazyTables
    return LazyTables({
        "stg_taxi_trips": wh.stg_trips, "stg_taxi_zones": wh.stg_zones,
        "fct_taxi_trips": wh.fct_trips, "mart_taxi_trips": wh.mart_trips,
        "dim_taxi_zones_geospatial": wh.dim_zones_geo,
        "dim_vendor": wh.dim_vendor, "dim_rate_code": wh.dim_rate_code,
        "dim_payment_type": wh.dim_payment_type,
    })
