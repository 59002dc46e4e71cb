"""Semantic cubes: dimensions, measures and many-to-one joins compiled to
DataFrame plans (join -> filter -> groupBy -> agg -> orderBy/limit).

A cube names a source table (a key of the ``tables`` mapping given at query
time). A query picks members as ``"Cube.member"``; members of a joined cube
are addressed by the join's name (``"PickupZone.borough"``). Only the joins
a query needs are added, each a left join to a dimension broadcast behind
a size check. Output columns are ``Cube_member`` (``Cube_member_granularity``
for time dimensions), so names stay valid unquoted Spark identifiers.

A measure's ``scale`` (money columns) makes its sums and averages exact decimal
sums: deterministic across partitionings, and rollups re-aggregate exactly.
Without it they are plain double aggregates.

Measures of a joined cube are taken over its distinct primary keys, so a
dimension row counts once however many base rows point at it. Sums and averages
are built key first: the base rows are reduced to the distinct keys of each group
(partial aggregation before the shuffle), and the measure is taken over these.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from meterline.functions.columns import exact_avg, exact_sum, text_key_equals
from meterline.defaults import BROADCAST_MAX_ROWS
from meterline.functions.joins import dimension, is_literal

class LazyTables(Mapping):
    """Table name -> DataFrame, each built on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


GRANULARITIES = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
MEASURE_TYPES = ("count", "count_distinct", "sum", "avg", "min", "max")


@dataclass(frozen=True)
class Dimension:
    name: str
    sql: str
    type: str = "string"          # string | number | time | boolean
    primary_key: bool = False
    title: str | None = None
    format: str | None = None     # display only


@dataclass(frozen=True)
class Measure:
    name: str
    type: str                     # one of MEASURE_TYPES
    sql: str | None = None        # column; None for count(*)
    title: str | None = None
    format: str | None = None     # display only
    scale: int | None = None      # decimals of a money column: summed exactly


@dataclass(frozen=True)
class Join:
    name: str                     # how queries address the joined cube
    cube: str                     # the cube it joins to
    left: str                     # column of this cube
    right: str                    # column of the joined cube
    relationship: str = "many_to_one"


@dataclass(frozen=True)
class PreAggregation:
    name: str
    measures: tuple[str, ...]
    dimensions: tuple[str, ...]
    time_dimension: str | None = None
    granularity: str | None = None
    refresh_every: str | None = None   # metadata: scheduling is external


@dataclass(frozen=True)
class Cube:
    name: str
    table: str
    dimensions: tuple[Dimension, ...] = ()
    measures: tuple[Measure, ...] = ()
    joins: tuple[Join, ...] = ()
    pre_aggregations: tuple[PreAggregation, ...] = ()
    title: str | None = None
    # time column -> (year column, month column) that the written table is partitioned by
    month_partitions: tuple[tuple[str, tuple[str, str]], ...] = ()

    def dimension(self, name: str) -> Dimension:
        for d in self.dimensions:
            if d.name == name:
                return d
        raise KeyError(f"{self.name} has no dimension {name}")

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"{self.name} has no measure {name}")

    def join(self, name: str) -> Join:
        for j in self.joins:
            if j.name == name:
                return j
        raise KeyError(f"{self.name} has no join {name}")


@dataclass(frozen=True)
class TimeDimension:
    member: str
    granularity: str | None = None
    date_range: tuple[str, str] | None = None   # inclusive bounds, ISO text


@dataclass(frozen=True)
class Filter:
    member: str
    operator: str                 # equals | notEquals | in | gt | gte | lt | lte | set | notSet
    values: tuple = ()


@dataclass(frozen=True)
class CubeQuery:
    measures: tuple[str, ...] = ()
    dimensions: tuple[str, ...] = ()
    time_dimensions: tuple[TimeDimension, ...] = ()
    filters: tuple[Filter, ...] = ()
    order: tuple[tuple[str, str], ...] = ()
    limit: int | None = None

    @classmethod
    def from_dict(cls, q: dict) -> "CubeQuery":
        """The semantic layer's JSON query shape: ``measures``, ``dimensions``,
        ``timeDimensions`` [{dimension, granularity, dateRange}], ``filters``
        [{member, operator, values}], ``order`` ({member: dir} or [[member, dir]]),
        ``limit``."""
        order = q.get("order") or ()
        order = tuple(order.items()) if isinstance(order, dict) else tuple(tuple(o) for o in order)
        tds = []
        for t in q.get("timeDimensions", ()):
            rng = t.get("dateRange")
            if isinstance(rng, str):
                raise ValueError("relative date ranges are not supported; give [from, to]")
            tds.append(TimeDimension(t["dimension"], t.get("granularity"), tuple(rng) if rng else None))
        filters = tuple(Filter(f["member"], f["operator"], tuple(f.get("values", ()))) for f in q.get("filters", ()))
        return cls(tuple(q.get("measures", ())), tuple(q.get("dimensions", ())), tuple(tds), filters,
                   order, q.get("limit"))


def out_name(member: str, granularity: str | None = None) -> str:
    base = member.replace(".", "_")
    return f"{base}_{granularity}" if granularity else base


DATE_ONLY = re.compile(r"\d{4}-\d{2}-\d{2}")


def filter_expr(c: Column, f: Filter) -> Column:
    """The condition of a filter on its member's column."""
    v = list(f.values)
    ops = {"equals": lambda: c.isin(v), "in": lambda: c.isin(v), "notEquals": lambda: ~c.isin(v) | c.isNull(),
           "gt": lambda: c > v[0], "gte": lambda: c >= v[0], "lt": lambda: c < v[0], "lte": lambda: c <= v[0],
           "set": lambda: c.isNotNull(), "notSet": lambda: c.isNull()}
    if f.operator not in ops:
        raise ValueError(f"unsupported filter operator {f.operator}")
    return ops[f.operator]()


def joined_measure(cube: Cube, m: Measure, col: Column | None, via: str) -> Column | None:
    """A measure of a joined cube over its distinct primary keys, as an aggregate
    of the base rows; None if these would weigh it (sums, averages)."""
    keys = [F.col(f"{via}__{d.sql}") for d in cube.dimensions if d.primary_key]
    if m.type == "count" and keys:
        return F.count_distinct(*(keys if col is None else [F.when(col.isNotNull(), k) for k in keys]))
    if m.type in ("min", "max", "count_distinct"):
        return measure_expr(m, col)
    if m.type in ("sum", "avg") and keys:
        return None
    raise ValueError(f"{cube.name}.{m.name}: a {m.type} of a joined cube without a primary key needs a query of that cube itself")


def _split(member: str) -> tuple[str, str]:
    owner, _, name = member.partition(".")
    if not name:
        raise ValueError(f"member must be 'Cube.name': {member}")
    return owner, name


def measure_expr(m: Measure, col: Column | None, exact_scale: int | None = None) -> Column:
    """Aggregate of a measure; its own ``scale`` (or ``exact_scale`` for the
    measures without one) makes sums and averages exact (see ``exact_sum``)."""
    exact_scale = exact_scale if m.scale is None else m.scale
    if m.type == "count":
        return F.count(F.lit(1)) if col is None else F.count(col)
    if m.type == "count_distinct":
        return F.count_distinct(col)
    if exact_scale is not None and m.type == "sum":
        return exact_sum(col, exact_scale)
    if exact_scale is not None and m.type == "avg":
        return exact_avg(col, exact_scale)
    return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[m.type](col)


class CubeSet:
    """A set of cubes that can reference each other through joins."""

    def __init__(self, cubes: list[Cube] | tuple[Cube, ...], exact_scale: int | None = None):
        self.cubes = {c.name: c for c in cubes}
        self.exact_scale = exact_scale

    def __getitem__(self, name: str) -> Cube:
        return self.cubes[name]

    # ------------------------------------------------------------ resolution
    def _base_cube(self, q: CubeQuery) -> Cube:
        """The cube from which all members can be reached; of several, the one
        named first."""
        members = list(q.measures) + list(q.dimensions) + [t.member for t in q.time_dimensions]
        owners = list(dict.fromkeys(_split(m)[0] for m in members + [f.member for f in q.filters]))
        named = [self.cubes[o] for o in owners if o in self.cubes]
        for cube in named:
            if all(o == cube.name or any(j.name == o for j in cube.joins) for o in owners):
                return cube
        raise ValueError("no cube of the query reaches all its members" if named else "query names no cube")

    def _resolve(self, base: Cube, member: str) -> tuple[Cube, str | None]:
        """(cube owning the member, join name or None for the base cube)."""
        owner, _ = _split(member)
        if owner == base.name:
            return base, None
        j = base.join(owner)
        return self.cubes[j.cube], j.name

    def _dim_col(self, base: Cube, member: str) -> tuple[Column, Dimension, str | None]:
        cube, via = self._resolve(base, member)
        d = cube.dimension(_split(member)[1])
        return F.col(d.sql if via is None else f"{via}__{d.sql}"), d, via

    # ------------------------------------------------------------ compilation
    def source(self, q: CubeQuery, tables: Mapping[str, DataFrame],
               broadcast_rows: int = BROADCAST_MAX_ROWS) -> tuple[Cube, DataFrame]:
        """The base table plus only the joins the query uses."""
        base = self._base_cube(q)
        df = tables[base.table]
        members = list(q.measures) + list(q.dimensions) + [t.member for t in q.time_dimensions] \
            + [f.member for f in q.filters] + [o[0] for o in q.order if o[0] not in q.measures]
        used: dict[str, set[str]] = {}
        for m in members:
            cube, via = self._resolve(base, m)
            if via is None:
                continue
            name = _split(m)[1]
            col = cube.dimension(name).sql if any(d.name == name for d in cube.dimensions) \
                else cube.measure(name).sql
            used.setdefault(via, set()).add(col)
            used[via].update(d.sql for d in cube.dimensions if d.primary_key and m in q.measures)
        for via, cols in used.items():
            j = base.join(via)
            target = self.cubes[j.cube]
            right = tables[target.table]
            keep = sorted(c for c in cols | {j.right} if c)
            proj = right.select(*[F.col(c).alias(f"{via}__{c}") for c in keep])
            right = F.broadcast(proj) if is_literal(right) else dimension(proj, broadcast_rows)
            lk, rk = df[j.left], right[f"{via}__{j.right}"]
            lt, rt = df.schema[j.left].dataType, right.schema[f"{via}__{j.right}"].dataType
            if isinstance(lt, StringType):
                cond = text_key_equals(lk, rk, rt)
            elif isinstance(rt, StringType):
                cond = text_key_equals(rk, lk, lt)
            else:
                cond = lk == rk
            df = df.join(right, cond, "left")
        return base, df

    def _month_predicate(self, base: Cube, td: TimeDimension, df: DataFrame) -> DataFrame:
        """The date range on the partition columns as well, so that only the
        months it touches are listed and opened."""
        _, d, via = self._dim_col(base, td.member)
        parts = dict(base.month_partitions).get(d.sql) if via is None else None
        if parts and set(parts) <= set(df.columns):
            month = F.col(parts[0]) * 12 + F.col(parts[1])
            lo, hi = (int(str(x)[:4]) * 12 + int(str(x)[5:7]) for x in td.date_range)
            df = df.where((month >= lo) & (month <= hi))
        return df

    def _filter_expr(self, base: Cube, f: Filter) -> Column:
        return filter_expr(self._dim_col(base, f.member)[0], f)

    def _with_key_first(self, out: DataFrame, df: DataFrame, group: list[Column], q: CubeQuery, via: str, found: list) -> DataFrame:
        """``out`` plus sums and averages over the distinct keys of the cube
        joined as ``via``: no base row is counted twice, and only one row per group
        and key is shuffled a second time."""
        cube = found[0][0]
        names = [out_name(d) for d in q.dimensions] + [out_name(t.member, t.granularity) for t in q.time_dimensions if t.granularity] or ["__all"]
        keys = [f"{via}__{d.sql}" for d in cube.dimensions if d.primary_key]
        columns = sorted({f"{via}__{m.sql}" for _, m, _ in found})
        rows = df.where(F.col(keys[0]).isNotNull()).groupBy(*group, *keys).agg(*[F.max(c).alias(f"{c}__value") for c in columns])
        sums = rows.groupBy(*names).agg(*[measure_expr(m, F.col(f"{via}__{m.sql}__value"), self.exact_scale).alias(out_name(member)) for _, m, member in found])
        # a group has one row here and one there: laid on top of each other, without a join
        both = out.unionByName(sums, allowMissingColumns=True)
        return both.groupBy(*names).agg(*[F.max(c).alias(c) for c in both.columns if c not in names])

    def query(self, q: CubeQuery, tables: Mapping[str, DataFrame]) -> DataFrame:
        base, df = self.source(q, tables)
        for f in q.filters:
            df = df.where(self._filter_expr(base, f))
        group: list[Column] = []
        for member in q.dimensions:
            c, _, _ = self._dim_col(base, member)
            group.append(c.alias(out_name(member)))
        for td in q.time_dimensions:
            c, d, _ = self._dim_col(base, td.member)
            ts = c.cast("timestamp_ntz")
            if td.date_range:
                lo, hi = td.date_range
                df = df.where(ts >= F.lit(lo).cast("timestamp_ntz"))
                if DATE_ONLY.fullmatch(str(hi)):  # a whole day; a bound with a time of day is meant as written
                    df = df.where(ts < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp_ntz"))
                else:
                    df = df.where(ts <= F.lit(hi).cast("timestamp_ntz"))
                df = self._month_predicate(base, td, df)
            if td.granularity:
                if td.granularity not in GRANULARITIES:
                    raise ValueError(td.granularity)
                group.append(F.date_trunc(td.granularity, ts).cast("timestamp_ntz")
                             .alias(out_name(td.member, td.granularity)))
        aggs, key_first = [], {}
        for member in q.measures:
            cube, via = self._resolve(base, member)
            m = cube.measure(_split(member)[1])
            col = None if m.sql is None else F.col(m.sql if via is None else f"{via}__{m.sql}")
            expr = measure_expr(m, col, self.exact_scale) if via is None else joined_measure(cube, m, col, via)
            if expr is None:
                key_first.setdefault(via, []).append((cube, m, member))
            else:
                aggs.append(expr.alias(out_name(member)))
        if key_first and not group:  # one row: a constant group to join its parts on
            group = [F.lit(0).alias("__all")]
        out = df.groupBy(*group).agg(*aggs) if aggs else df.select(*group).distinct()
        for via, found in key_first.items():
            out = self._with_key_first(out, df, group, q, via, found)
        if key_first:
            measures = [out_name(m) for m in q.measures]
            out = out.select(*[c for c in out.columns if c not in (*measures, "__all")], *measures)
        if q.order:
            keys = [F.col(out_name(m)).desc_nulls_last() if d == "desc" else F.col(out_name(m)).asc_nulls_last()
                    for m, d in q.order]
            out = out.orderBy(*keys)
        if q.limit is not None:
            out = out.limit(q.limit)
        return out


def infer_cube(name: str, table: str, df: DataFrame,
               sum_suffixes: tuple[str, ...] = ("_amount", "_count")) -> Cube:
    """Cube from a table schema: text -> dimension, timestamp/date -> time
    dimension, numeric named *_amount / *_count -> sum, plus ``count``.
    Columns starting with ``_`` are skipped."""
    dims, measures = [], [Measure("count", "count")]
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        t = f.dataType.typeName()
        if t == "string":
            dims.append(Dimension(f.name, f.name, "string"))
        elif t in ("timestamp", "timestamp_ntz", "date"):
            dims.append(Dimension(f.name, f.name, "time"))
        elif t in ("integer", "long", "short", "byte", "float", "double", "decimal") \
                and f.name.lower().endswith(sum_suffixes):
            measures.append(Measure(f.name, "sum", f.name))
    return Cube(name, table, tuple(dims), tuple(measures))
