"""DuckDB twins of the test projections and models, for the correctness gate.

Each query's oracle is ``WITH <base CTEs> <body>``; DuckDB skips CTEs the
body does not reference. The base CTEs restate the projections of
``meterline.bindings`` and of the models in DuckDB's dialect; column lists and
lookup rows come from the models' constants, expressions are their own.
"""

from __future__ import annotations

from collections.abc import Iterable

from meterline.defaults import MAX_PASSENGERS, TOTAL_MISMATCH_TOLERANCE
from meterline.operators.models import FARE_COMPONENTS, ID_COLUMNS, MART_COLUMNS, MART_RENAMES, PASSTHROUGH, STG_FACT_COLUMNS
from meterline.sources.seeds import SEEDS

DATE_MIN = "DATE '1996-01-01'"
DATE_MAX = "DATE '2000-05-31'"

_PICKUP = "o_orderdate + to_seconds((l_orderkey * 37 + l_linenumber * 5003) % 86400)"

LOOKUPS = (("dim_vendor", "vendor_id", "vendor_name", "VendorID"), ("dim_rate_code", "rate_code_id", "rate_code_name", "RatecodeID"),
           ("dim_payment_type", "payment_type", "payment_name", "payment_type"))
ROLES = {"pickup": "PULocationID", "dropoff": "DOLocationID"}
# A comparison with NULL keeps no row, on either side of the OR.
VALID = f"pickup_date BETWEEN {DATE_MIN} AND {DATE_MAX} AND NOT (trip_distance < 0 OR fare_amount < 0) AND passenger_count > 0"


def _list(items: Iterable[str]) -> str:
    return ", ".join(items)


def _values(seed: str) -> str:
    schema, rows = SEEDS[seed]
    return f"SELECT * FROM (VALUES {_list(str(row) for row in rows)}) AS seed({_list(schema.fieldNames())})"


def _minute(ts: str) -> str:
    """The number of the minute since 1970."""
    return f"epoch_us(date_trunc('minute', {ts})) // 60000000"


def _flag(condition: str, name: str) -> str:
    return f"CAST(ifnull({condition}, false) AS INTEGER) AS {name}_flag"


RATIOS = _list(f"ifnull(fare_amount / nullif(greatest({by}, 0), 0), 0) AS fare_per_{unit}" for by, unit in (("trip_distance", "mile"), ("trip_duration_minutes", "minute")))
MISMATCH = _flag(f"abs(total_amount - calculated_total_amount) > {TOTAL_MISMATCH_TOLERANCE}", "total_amount_mismatch")

BASE_CTES: dict[str, str] = {
    "raw_trips": f"""
  SELECT
    CAST(l_suppkey % 8 AS INT) AS VendorID,
    {_PICKUP} AS tpep_pickup_datetime,
    {_PICKUP} + to_seconds((l_partkey % 120) * 60 - 180 + l_suppkey % 60) AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_quantity AS INT) % 8 AS DOUBLE) END AS passenger_count,
    l_quantity - 2 AS trip_distance,
    CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS RatecodeID,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    s_nationkey AS PULocationID,
    c_nationkey AS DOLocationID,
    CAST(l_partkey % 8 AS BIGINT) AS payment_type,
    l_extendedprice / 1000 - 2 AS fare_amount,
    l_discount * 10 AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    l_tax * 100 AS tip_amount,
    l_tax * 50 AS tolls_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    ROUND((l_extendedprice / 1000 - 2 + l_discount * 10 + 0.8 + l_tax * 50
           + CASE WHEN l_linenumber % 2 = 1 THEN 2.5 ELSE 0 END
           + CASE WHEN s_nationkey < 3 THEN 1.25 ELSE 0 END
           + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100, 0) / 100 AS total_amount,
    CASE WHEN l_linenumber % 2 = 1 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN s_nationkey < 3 THEN CAST(1.25 AS DOUBLE) END AS airport_fee,
    TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey""",
    "raw_zones": """
  SELECT n_nationkey AS LocationID,
         '  ' || n_name || ' ' AS Zone,
         r_name || ' ' AS Borough,
         CONCAT('Zone ', n_regionkey % 2) AS service_zone,
         TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "zone_geojson": """
  SELECT CAST(k AS VARCHAR) AS LocationID,
         CASE WHEN k % 10 = 0 THEN '{"type":"MultiPolygon","coordinates":[' ELSE '{"type":"Polygon","coordinates":' END
         || '[' || printf('[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]', k, k, k + 4, k, k + 4, k + 3 + k % 5, k, k + 3 + k % 5, k, k)
         || CASE WHEN k % 2 = 1
                 THEN printf(',[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]', k + 1, k + 1, k + 1, k + 2, k + 2, k + 2, k + 2, k + 1, k + 1, k + 1)
                 ELSE '' END
         || ']'
         || CASE WHEN k % 10 = 0
                 THEN printf(',[[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]]]}', k + 10, k + 10, k + 11, k + 10, k + 11, k + 11, k + 10, k + 11, k + 10, k + 10)
                 ELSE '}' END AS geojson
  FROM (SELECT n_nationkey AS k FROM nation) WHERE k <> 24""",
    **{name: _values(name) for name in SEEDS},
    "stg_trips": f"""
  SELECT {_list(f"CAST({c} AS VARCHAR) AS {c}" for c in ID_COLUMNS)}, tpep_pickup_datetime, tpep_dropoff_datetime,
         {_list(PASSTHROUGH)}, CAST({" + ".join(f"ifnull({c}, 0)" for c in FARE_COMPONENTS)} AS DECIMAL(10,2)) AS calculated_total_amount,
         CAST(({_minute("tpep_dropoff_datetime")}) - ({_minute("tpep_pickup_datetime")}) AS BIGINT) AS trip_duration_minutes,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
         {_list(f"{fn}(tpep_pickup_datetime) AS pickup_{name}" for fn, name in (("year", "year"), ("month", "month"), ("dayofweek", "day_of_week"), ("hour", "hour")))},
         _ingested_at
  FROM raw_trips""",
    "stg_zones": """
  SELECT CAST(LocationID AS VARCHAR) AS LocationID, TRIM(Zone) AS Zone, TRIM(Borough) AS Borough,
         CAST(service_zone AS VARCHAR) AS service_zone, _ingested_at
  FROM raw_zones""",
    "fct_trips": f"""
  SELECT {_list(STG_FACT_COLUMNS)},
         {_list(f"(SELECT {name} FROM {dim} AS d WHERE d.{key} = t.{col}) AS {name}" for dim, key, name, col in LOOKUPS)},
         {_list(f"{role}.{c} AS {role}_{c.lower()}" for role in ROLES for c in ("Zone", "Borough", "service_zone"))},
         {RATIOS}, {_flag("VendorID IS NULL", "missing_vendor")}, {_flag("trip_duration_minutes <= 0", "negative_duration")}, {MISMATCH}, _ingested_at
  FROM (SELECT * FROM stg_trips WHERE {VALID} AND passenger_count <= {MAX_PASSENGERS}) AS t
  {" ".join(f"LEFT JOIN (SELECT LocationID AS {role}_id, Zone, Borough, service_zone FROM stg_zones) AS {role} ON {role}_id = {col}" for role, col in ROLES.items())}""",
    "mart_trips": f"""
  SELECT {_list(f"{c} AS {MART_RENAMES.get(c, c)}" for c in MART_COLUMNS)}, {RATIOS}, {_flag("trip_duration_minutes < 0", "negative_duration")}, {MISMATCH}, _ingested_at
  FROM stg_trips WHERE {VALID}""",
    "dim_zones_geo": """
  SELECT b.LocationID, b.Zone, b.Borough, b.service_zone, w.geometry_wkt, w.geometry_geojson,
         m.area AS zone_area_sq_meters, m.mx / m.area AS zone_centroid_longitude,
         m.my / m.area AS zone_centroid_latitude, b._ingested_at
  FROM stg_zones b
  LEFT JOIN zone_measures m ON b.LocationID = m.LocationID
  LEFT JOIN zone_wkt w ON b.LocationID = w.LocationID""",
    "orders_fact": """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_totalprice AS DECIMAL(12,2)) AS revenue
  FROM orders""",
    "raw_orders": """
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         o_orderdate AS order_date, o_totalprice AS order_amount
  FROM orders""",
    "zone_polys": """
  SELECT LocationID, json_extract_string(geojson, '$.type') AS gtype,
         CASE WHEN json_extract_string(geojson, '$.type') = 'Polygon'
              THEN [CAST(json_extract(geojson, '$.coordinates') AS DOUBLE[][][])]
              ELSE CAST(json_extract(geojson, '$.coordinates') AS DOUBLE[][][][]) END AS polys
  FROM zone_geojson""",
    "zone_rings": """
  SELECT LocationID, ri, ring,
         list_sum([ring[i][1] * ring[i % len(ring) + 1][2] - ring[i % len(ring) + 1][1] * ring[i][2]
                   FOR i IN range(1, len(ring) + 1)]) AS c,
         list_sum([(ring[i][1] + ring[i % len(ring) + 1][1])
                   * (ring[i][1] * ring[i % len(ring) + 1][2] - ring[i % len(ring) + 1][1] * ring[i][2])
                   FOR i IN range(1, len(ring) + 1)]) AS x,
         list_sum([(ring[i][2] + ring[i % len(ring) + 1][2])
                   * (ring[i][1] * ring[i % len(ring) + 1][2] - ring[i % len(ring) + 1][1] * ring[i][2])
                   FOR i IN range(1, len(ring) + 1)]) AS y
  FROM (SELECT LocationID, UNNEST(poly) AS ring, generate_subscripts(poly, 1) AS ri
        FROM (SELECT LocationID, UNNEST(polys) AS poly FROM zone_polys))""",
    "zone_measures": """
  SELECT LocationID,
         SUM(c * sign(c) * CASE WHEN ri = 1 THEN 1 ELSE -1 END / 2) AS area,
         SUM(x * sign(c) * CASE WHEN ri = 1 THEN 1 ELSE -1 END / 6) AS mx,
         SUM(y * sign(c) * CASE WHEN ri = 1 THEN 1 ELSE -1 END / 6) AS my
  FROM zone_rings GROUP BY LocationID""",
    "zone_wkt": """
  SELECT LocationID,
         CASE WHEN gtype = 'Polygon'
              THEN 'POLYGON ' || '(' || array_to_string(['(' || array_to_string([(CASE WHEN pt[1] = floor(pt[1]) THEN CAST(CAST(floor(pt[1]) AS BIGINT) AS VARCHAR) ELSE CAST(pt[1] AS VARCHAR) END) || ' ' || (CASE WHEN pt[2] = floor(pt[2]) THEN CAST(CAST(floor(pt[2]) AS BIGINT) AS VARCHAR) ELSE CAST(pt[2] AS VARCHAR) END) FOR pt IN ring], ', ') || ')' FOR ring IN polys[1]], ', ') || ')'
              ELSE 'MULTIPOLYGON (' || array_to_string(['(' || array_to_string(['(' || array_to_string([(CASE WHEN pt[1] = floor(pt[1]) THEN CAST(CAST(floor(pt[1]) AS BIGINT) AS VARCHAR) ELSE CAST(pt[1] AS VARCHAR) END) || ' ' || (CASE WHEN pt[2] = floor(pt[2]) THEN CAST(CAST(floor(pt[2]) AS BIGINT) AS VARCHAR) ELSE CAST(pt[2] AS VARCHAR) END) FOR pt IN ring], ', ') || ')' FOR ring IN poly], ', ') || ')' FOR poly IN polys], ', ') || ')'
         END AS geometry_wkt,
         CAST(CASE WHEN gtype = 'Polygon' THEN to_json({'type': gtype, 'coordinates': polys[1]})
                   ELSE to_json({'type': gtype, 'coordinates': polys}) END AS VARCHAR) AS geometry_geojson
  FROM zone_polys""",
    "customers_dim": """
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_segment, r_name AS customer_region
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey""",
}

# CTEs may only reference earlier ones: move the zone dimension after its inputs.
BASE_CTES["dim_zones_geo"] = BASE_CTES.pop("dim_zones_geo")


def with_base(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in BASE_CTES.items())
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def r(expr: str, digits: int = 4) -> str:
    """Half-away-from-zero rounding on the binary value, the twin of
    ``functions.columns.round_to`` (same IEEE operations)."""
    scale = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    return (f"(CASE WHEN abs({expr}) * {scale} >= 4503599627370496 THEN {expr} ELSE "
            f"CAST(sign({expr}) AS DOUBLE) * CAST(floor(abs({expr}) * {scale} + CAST(0.5 AS DOUBLE)) AS DOUBLE)"
            f" / {scale} END)")


# Model names of the check suite -> base CTE names above.
SUITE_MODELS = {
    "stg_taxi_trips": "stg_trips", "stg_taxi_zones": "stg_zones", "fct_taxi_trips": "fct_trips",
    "mart_taxi_trips": "mart_trips", "dim_taxi_zones_geospatial": "dim_zones_geo",
    "orders": "orders", "dim_vendor": "dim_vendor", "dim_rate_code": "dim_rate_code", "dim_payment_type": "dim_payment_type",
}


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"DATE '{v}'" if hasattr(v, "isoformat") else repr(v)


def _failures_sql(check) -> str:
    t, c = SUITE_MODELS[check.model], check.column
    k = check.kind
    if k == "not_null":
        return f"SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM {t}"
    if k == "accepted_range":
        conds = []
        if check.args["min"] is not None:
            conds.append(f"{c} >= {_lit(check.args['min'])}")
        if check.args["max"] is not None:
            conds.append(f"{c} <= {_lit(check.args['max'])}")
        return f"SELECT COUNT(*) FROM {t} WHERE NOT ({' AND '.join(conds)})"
    if k == "expression":
        return f"SELECT COUNT(*) FROM {t} WHERE NOT ({check.args['sql']})"
    if k == "date_past":
        return f"SELECT COUNT(*) FROM {t} WHERE {c} >= {_lit(check.args['today'])}"
    if k == "row_count":
        return f"SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {t}"
    if k == "accepted_values":
        vals = ", ".join(_lit(v) for v in check.args["values"])
        return (f"SELECT COUNT(*) FROM (SELECT {c} AS v FROM {t} GROUP BY {c}) "
                f"WHERE v NOT IN ({vals})")
    if k == "unique":
        return (f"SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING COUNT(*) > 1)")
    if k == "relationships":
        p, f = SUITE_MODELS[check.args["to"]], check.args["field"]
        return (f"SELECT COUNT(*) FROM (SELECT {c} AS k FROM {t} WHERE {c} IS NOT NULL) ch "
                f"LEFT JOIN (SELECT {f} AS pk FROM {p}) pa ON ch.k = pa.pk WHERE pa.pk IS NULL")
    raise ValueError(k)


def check_sql(check) -> str:
    col = _lit(check.column) if check.column else "CAST(NULL AS VARCHAR)"
    failures = f"CAST(({_failures_sql(check)}) AS BIGINT)"
    return (f"SELECT {_lit(check.name)} AS test_name, {_lit(check.model)} AS model, {col} AS column_name, "
            f"{_lit(check.kind)} AS test_type, {_lit(check.severity)} AS severity, {failures} AS failures")


def suite_sql(checks) -> str:
    body = "\nUNION ALL\n".join(check_sql(ch) for ch in checks)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'fail' END AS status FROM (\n{body}\n)")


def xsum(expr: str) -> str:
    """Plain double sum; callers compare at a stated number of digits."""
    return f"SUM(CAST({expr} AS DOUBLE))"


def xavg(expr: str) -> str:
    return f"AVG(CAST({expr} AS DOUBLE))"
